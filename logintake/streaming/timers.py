"""Chunks of a stream that are closed when their time is over.

``chunk_stream`` learns of a silence from the next messages of the same sender. Here each
sender has its own state and a timer in event time: once the stream has got so far that no
message of the session can still come, its open chunk is closed, whether the sender ever
writes again or not.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from logintake.operators.clock import micros

STATE = "start_us bigint, first_us bigint, last_us bigint, total bigint, timer_ms bigint"
CLOSED = ["start_us", "part", "logs", "first_us", "last_us", "closed_by"]
FULL, SILENT = "size", "time"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class ChunkTimers(StatefulProcessor):
    """The open session of a sender: its start, the first message of its open chunk, the
    last one, how many there are, and when the timer is."""

    def __init__(self, idle_us: int, max_logs: int) -> None:
        self.idle, self.cap = idle_us, max_logs

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.open = handle, handle.getValueState("open", STATE)

    def _closed(self, key, found: list[tuple]) -> Iterator[pd.DataFrame]:
        if found:
            out = pd.DataFrame(found, columns=CLOSED)
            out.insert(0, "sender", key[0])
            yield out

    def _silent(self, start: int, first: int, last: int, total: int) -> list[tuple]:
        """The open chunk of a session that is over, if it holds a message."""
        held = total % self.cap
        return [(start, total // self.cap, held, first, last, SILENT)] if held else []

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        known = self.open.get()
        start = first = last = timer = None
        total = 0
        if known is not None:
            start, first, last, total, timer = known
        found: list[tuple] = []
        # What a micro-batch has of one sender; it comes in any order.
        for us in sorted(us for part in rows for us in part["us"].tolist()):
            if last is not None and us - last > self.idle:
                found += self._silent(start, first, last, total)
                start = None
            if start is None:
                start, total = us, 0
            if total % self.cap == 0:
                first = us
            last = us if last is None else max(last, us)
            total += 1
            if total % self.cap == 0:
                found.append((start, total // self.cap - 1, self.cap, first, last, FULL))
        if timer is not None:
            self.handle.deleteTimer(timer)
        timer = (last + self.idle) // 1000 + 1
        self.handle.registerTimer(timer)
        self.open.update((start, first, last, total, timer))
        yield from self._closed(key, found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        known = self.open.get()
        if known is not None:
            self.open.clear()
            yield from self._closed(key, self._silent(*known[:4]))

    def close(self) -> None:
        pass


def closed_chunks(
    messages: DataFrame,
    key: str,
    ts: str,
    max_idle: dt.timedelta = dt.timedelta(seconds=1),
    max_logs: int = 10_000,
    lateness: dt.timedelta = dt.timedelta(0),
) -> DataFrame:
    """The chunks of a stream of messages as they are closed: ``key, session_start, part,
    logs, first_ts, last_ts, closed_by`` (size or time), to be written in append mode.

    A chunk is closed when it holds ``max_logs`` messages, or once the latest time seen, less
    ``lateness``, is more than ``max_idle`` behind its last one. A message that comes later
    than that begins a new session. Messages without a time or a sender are left out, as no
    timer can close them. What a micro-batch has of a sender is one task's; ``chunk_stream``
    is for senders too large for that. The store of the state must be RocksDB: start the
    query inside ``rocksdb_state``.
    """
    if max_logs < 1:
        raise ValueError("max_logs must be at least 1")
    kind = next(f.dataType.simpleString() for f in messages.schema.fields if f.name == key)
    rows = messages.filter(F.col(key).isNotNull() & F.col(ts).isNotNull()).select(
        F.col(key).alias("sender"), F.col(ts).cast("timestamp").alias("at"), micros(F.col(ts)).alias("us")
    )
    rows = rows.withWatermark("at", f"{lateness // dt.timedelta(milliseconds=1)} milliseconds")
    found = rows.groupBy("sender").transformWithStateInPandas(
        ChunkTimers(max_idle // dt.timedelta(microseconds=1), max_logs),
        f"sender {kind}, start_us long, part long, logs long, first_us long, last_us long, closed_by string",
        "Append", "EventTime",
    )
    return found.select(
        F.col("sender").alias(key), F.timestamp_micros("start_us").alias("session_start"), "part", "logs",
        F.timestamp_micros("first_us").alias("first_ts"), F.timestamp_micros("last_us").alias("last_ts"), "closed_by",
    )


class rocksdb_state:  # noqa: N801
    """While this lasts, queries that are started keep their state in RocksDB."""

    def __init__(self, spark) -> None:
        self.conf = spark.conf

    def __enter__(self) -> None:
        self.before = self.conf.get(PROVIDER, None)
        self.conf.set(PROVIDER, ROCKSDB)

    def __exit__(self, *_) -> None:
        if self.before is None:
            self.conf.unset(PROVIDER)
        else:
            self.conf.set(PROVIDER, self.before)
