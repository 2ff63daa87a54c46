"""Chunks of a stream of messages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logintake.operators.chunk import OPEN_COLUMNS, chunk_messages, left_open
from logintake.operators.clock import micros
from logintake.streaming.intake import trigger


def chunk_stream(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    key: str,
    ts: str,
    order: str | list[str] = (),
    max_idle: dt.timedelta = dt.timedelta(seconds=1),
    max_logs: int = 10_000,
    max_wait: dt.timedelta | None = dt.timedelta(seconds=10),
    hot_rows: int | None = None,
) -> StreamingQuery:
    """Start the stream that writes ``messages`` with their chunk to ``root/chunks``.

    Messages of one micro-batch come before those of the next; how many did not is
    counted under ``root/clock``, beside the latest time seen. Between batches
    only one row per sender is kept, under ``root/open``: the last message, and
    start and length of its session. A session that was silent for ``max_idle``
    before that time cannot go on and is left out. A sender of any size is cut into
    slices as in ``chunk_messages``, so no task holds all its messages. All folders
    are numbered by batch; a repeated batch starts from the same open sessions.
    """
    order = [order] if isinstance(order, str) else list(order)
    idle = max_idle // dt.timedelta(microseconds=1)

    def take(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before, clock = None, None
        if batch_id > 0:
            before = spark.read.parquet(f"{root}/open/batch_id={batch_id - 1}")
            clock = spark.read.parquet(f"{root}/clock/batch_id={batch_id - 1}").first().last_us
        target = f"{root}/chunks/batch_id={batch_id}"
        # Looked at twice, to count the rows of each sender and to cut them.
        batch = batch.persist()
        try:
            chunked = chunk_messages(
                batch, key, ts, order, max_idle, max_logs, hot_rows, before
            )
            chunked.write.mode("overwrite").parquet(target)
            at = micros(F.col(ts))
            seen = batch.agg(
                F.greatest(F.max(at), F.lit(clock).cast("long")).alias("last_us"),
                F.count(F.when(at < F.lit(clock).cast("long"), True)).alias("late"),
            )
            last_us, late = seen.first()
        finally:
            batch.unpersist()
        done = spark.read.schema(chunked.schema).parquet(target)
        now_open = left_open(done, key, ts, max_logs, order)
        if before is not None:
            # The later row of a sender wins.
            latest = F.max(F.struct(*OPEN_COLUMNS)).alias("last")
            now_open = now_open.unionByName(before).groupBy(key).agg(latest)
            now_open = now_open.select(key, *[f"last.{c}" for c in OPEN_COLUMNS])
        if last_us is not None:
            now_open = now_open.filter(F.col("last_us").isNull() | (F.col("last_us") + idle >= last_us))
        now_open.write.mode("overwrite").parquet(f"{root}/open/batch_id={batch_id}")
        clock_row = spark.createDataFrame([(last_us, late)], "last_us long, late long")
        clock_row.coalesce(1).write.mode("overwrite").parquet(f"{root}/clock/batch_id={batch_id}")

    return (
        messages.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(max_wait))
        .start()
    )
