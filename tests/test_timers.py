"""Chunks closed by size and by time, against a loop over sorted messages."""

import datetime as dt
import random

import pytest

from logintake.streaming.timers import closed_chunks, rocksdb_state

EPOCH = dt.datetime(1970, 1, 1)
SCHEMA = "k string, ts timestamp_ntz"


def by_hand(rows, idle_us: int, cap: int, seen_us: int) -> set[tuple]:
    out, senders = set(), {}
    for k, us in sorted((k, us) for k, us in rows):
        senders.setdefault(k, []).append(us)
    for k, times in senders.items():
        sessions = [[times[0]]]
        for us in times[1:]:
            if us - sessions[-1][-1] > idle_us:
                sessions.append([])
            sessions[-1].append(us)
        for n, session in enumerate(sessions):
            over = n + 1 < len(sessions) or (session[-1] + idle_us) // 1000 + 1 <= seen_us // 1000
            for part in range(0, len(session), cap):
                chunk = session[part : part + cap]
                if len(chunk) == cap or over:
                    out.add((k, session[0], part // cap, len(chunk), chunk[0], chunk[-1], "size" if len(chunk) == cap else "time"))
    return out


def run(spark, tmp_path, batches, idle_us: int, cap: int) -> list[tuple]:
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for rows in batches:
        made = [(k, None if us is None else EPOCH + dt.timedelta(microseconds=us)) for k, us in rows]
        spark.createDataFrame(made, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        chunks = closed_chunks(spark.readStream.schema(SCHEMA).parquet(source), "k", "ts", dt.timedelta(microseconds=idle_us), cap)
        with rocksdb_state(spark):
            chunks.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(
                availableNow=True).start(out).awaitTermination()
    us = lambda t: (t.replace(tzinfo=None) - EPOCH) // dt.timedelta(microseconds=1)
    return [(r.k, us(r.session_start), r.part, r.logs, us(r.first_ts), us(r.last_ts), r.closed_by) for r in spark.read.parquet(out).collect()]


def test_a_silent_sender_is_closed(spark, tmp_path):
    """Its last chunk is closed by the time of the others."""
    batches = [[("a", 1_000_000), ("a", 1_500_000), ("b", 1_000_000)], [("b", 9_000_000), (None, 1), ("c", None)]]
    got = run(spark, tmp_path, batches, 2_000_000, 10)
    assert sorted(got) == [("a", 1_000_000, 0, 2, 1_000_000, 1_500_000, "time"), ("b", 1_000_000, 0, 1, 1_000_000, 1_000_000, "time")]


def test_against_a_loop(spark, tmp_path):
    draw, rows = random.Random(3), []
    for k in "abcdefgh":
        at = draw.randint(0, 3_000_000)
        for _ in range(draw.randint(1, 60)):
            at += draw.choice([0, 1, 999, 1000, 400_000, 2_000_000, 2_000_001, 9_000_000])
            rows.append((k, at))
    bounds = [0, 20_000_000, 21_000_000, 60_000_000, 1 << 50]
    batches = [[r for r in rows if lo <= r[1] < hi] for lo, hi in zip(bounds, bounds[1:])]
    for b in batches:
        draw.shuffle(b)
    got = run(spark, tmp_path, [b for b in batches if b], 2_000_000, 4)
    assert len(got) == len(set(got)) and set(got) == by_hand(rows, 2_000_000, 4, max(us for _, us in rows))


def test_bounds(spark):
    with pytest.raises(ValueError):
        closed_chunks(spark.createDataFrame([], SCHEMA), "k", "ts", max_logs=0)
