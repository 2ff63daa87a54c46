"""Sketches of days, merged over batches, against exact counts."""

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from logintake.operators.report import day_sketches, merge_sketches, read_sketches
from workload.queries import _mixed

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def parsed(spark):
    return _mixed(spark, SF_DIR).persist()


def exact(parsed):
    out = defaultdict(lambda: [0, 0, set(), Counter()])
    for r in parsed.collect():
        day = out[None if r.error_code is not None else r.date.date()]
        day[0] += 1
        if r.error_code is None:
            day[2].add(r.hostname)
        else:
            day[1] += 1
            day[3][r.error_reason] += 1
    return out


def test_merged_over_batches(spark, parsed, tmp_path):
    """Kept batch by batch, merged in one go, and once more over months."""
    for n in range(4):
        some = parsed.filter(F.pmod(F.xxhash64("event_id"), F.lit(4)) == n)
        day_sketches(some).write.mode("append").parquet(str(tmp_path))
    stored = spark.read.parquet(str(tmp_path))
    got = {r.day: r for r in read_sketches(merge_sketches(stored), 20).collect()}
    want = exact(parsed)
    assert set(got) == set(want)
    for day, (lines, errors, senders, texts) in want.items():
        r = got[day]
        assert (r.lines, r.errors, r.senders) == (lines, errors, len(senders))
        assert {t.item: t["count"] for t in r.texts or []} == texts
    months = read_sketches(merge_sketches(merge_sketches(stored), F.trunc("day", "month"))).collect()
    whole = next(r for r in months if r.day is not None)
    assert whole.senders == len(set().union(*(w[2] for w in want.values())))


def test_error_bounds(spark, parsed):
    """Few registers and few tracked texts: estimates within what is said."""
    many = spark.range(200_000).select(
        F.lit(None).cast("int").alias("error_code"), F.lit(None).cast("string").alias("error_reason"),
        F.lit("2024-01-01").cast("timestamp").alias("date"), F.concat(F.lit("h"), F.col("id") % 50_000).alias("hostname"),
    )
    senders = read_sketches(day_sketches(many, registers=12)).first().senders
    assert abs(senders / 50_000 - 1) < 4 * 1.04 / 2**6
    skewed = spark.range(50_000).select(
        F.lit(1).alias("error_code"), F.concat(F.lit("t"), F.floor(F.sqrt(F.col("id") % 9000))).alias("error_reason"),
        F.lit(None).cast("timestamp").alias("date"), F.lit(None).cast("string").alias("hostname"),
    ).repartition(5)
    true = {r.error_reason: r["count"] for r in skewed.groupBy("error_reason").count().collect()}
    found = read_sketches(day_sketches(skewed, tracked=50), 5).first().texts
    assert found and all(abs(t["count"] - true[t.item]) <= 50_000 / 50 * 2 for t in found)


def test_no_lines(parsed):
    assert read_sketches(merge_sketches(day_sketches(parsed.limit(0)))).collect() == []
