"""Continuous intake: a stream of stored lines to tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logintake.operators.report import observed
from logintake.operators.route import Processor, Processors
from logintake.plans.intake import parse_lines
from logintake.plans.tables import INGEST_TIME, Writer, parquet_writer, write_tables

# Beside the tables: the files that each batch has read.
FILES = "_files"


def trigger(max_wait: dt.timedelta | None) -> dict:
    """Trigger options: a batch at most every ``max_wait``; all there is, once,
    without it. A file stream has no minimum size of a batch."""
    if max_wait is None:
        return {"availableNow": True}
    return {"processingTime": f"{max_wait // dt.timedelta(milliseconds=1)} milliseconds"}


def ingest_stream(
    lines: DataFrame,
    root: str,
    checkpoint: str,
    chain: Processors | list[Processor] | None = None,
    max_wait: dt.timedelta | None = dt.timedelta(seconds=10),
    ref_time: Column | dt.datetime | str | None = None,
    ingest_time: Column | None = None,
    writer: Callable[[str, int], Writer] = parquet_writer,
    col: str = "value",
    names: str | None = None,
    **options,
) -> StreamingQuery:
    """Start the stream that parses, quarantines, routes and writes ``lines``.

    Each micro-batch writes to folders of its own number and replaces them when
    it is repeated, so a failure leaves no duplicates. Unless given, ``ref_time``
    and ``ingest_time`` are the time of the micro-batch, which a repetition
    keeps. Counts of lines and errors appear in the progress of the stream.
    With ``names``, the values of that column in each batch are written to a table of
    their own, after the others.
    """
    parsed = parse_lines(lines.select(col, *([names] if names else [])), col, ref_time, **options)
    when = F.current_timestamp() if ingest_time is None else ingest_time
    parsed = observed(parsed.withColumn(INGEST_TIME, when), "intake")

    def take(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            rows = batch.drop(names) if names else batch
            write_tables(rows, writer(root, batch_id), chain, F.col(INGEST_TIME), keep="none")
            if names:
                read = batch.select(names).distinct()
                read.write.mode("overwrite").parquet(f"{root}/{FILES}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    return (
        parsed.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(max_wait))
        .start()
    )
