"""Cut the messages of each sender into chunks.

A chunk ends when it holds ``max_logs`` messages, or when the sender stays
silent for more than ``max_idle``. The messages between two silences are a
session; it is known by the time of its first message.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logintake.operators.clock import micros, unique_micros
from logintake.operators.ordered import carried

# What is left open at the end of a batch: last message, session start and the
# number of its messages so far.
OPEN_COLUMNS = ["last_us", "open_us", "open_rows"]


def chunk_messages(
    df: DataFrame,
    key: str,
    ts: str,
    order: str | list[str] = (),
    max_idle: dt.timedelta = dt.timedelta(seconds=1),
    max_logs: int = 10_000,
    hot_rows: int | None = None,
    open_chunks: DataFrame | None = None,
) -> DataFrame:
    """Add ``session_start``, ``part`` (chunk in the session, from 0) and
    ``line_no`` (message in the chunk, from 0).

    ``order`` breaks ties of ``ts``. ``open_chunks`` continues the sessions left
    open by earlier rows, as ``left_open`` returns them.
    """
    if max_logs < 1:
        raise ValueError("max_logs must be at least 1")
    order = [order] if isinstance(order, str) else list(order)
    idle = max_idle // dt.timedelta(microseconds=1)

    def local(rows, window):
        upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = rows.withColumn("_us", micros(F.col(ts)))
        rows = rows.withColumns(
            {
                "_n": F.row_number().over(window).cast("bigint"),
                "_gap": F.col("_us") - F.lag("_us").over(window) > idle,
                "_first": F.first("_us").over(upto),
            }
        )
        started = F.col("_gap")
        return rows.withColumns(
            {
                "_start": F.last(F.when(started, F.col("_us")), True).over(upto),
                "_start_n": F.last(F.when(started, F.col("_n")), True).over(upto),
            }
        )

    summary = {
        "_first_us": F.min("_us"),
        "_last_us": F.max("_us"),
        "_new": F.max("_start"),
        "_tail": F.count(F.lit(1)) - F.coalesce(F.max("_start_n") - 1, F.lit(0)),
    }

    def carry(sums, window):
        upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        joins = F.col("_first_us") - F.lag("_last_us").over(window) <= idle
        sums = sums.withColumn("_joins", F.coalesce(joins, F.lit(False)))
        opened = F.coalesce("_new", F.when(~F.col("_joins"), F.col("_first_us")))
        sums = sums.withColumn("_opened", opened)
        sums = sums.withColumns(
            {
                "_open": F.last("_opened", True).over(upto),
                "_run": F.count("_opened").over(upto),
            }
        )
        run = Window.partitionBy(key, "_run").orderBy("_slice").rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        sums = sums.withColumn("_rows", F.sum("_tail").over(run))
        return sums.withColumns(
            {
                "_open_us": F.when(F.col("_joins"), F.lag("_open").over(window)),
                "_open_rows": F.when(F.col("_joins"), F.lag("_rows").over(window)),
            }
        )

    earlier = None
    if open_chunks is not None:
        earlier = open_chunks.select(
            key,
            F.col("open_us").alias("_first_us"),
            F.col("last_us").alias("_last_us"),
            F.lit(None).cast("bigint").alias("_new"),
            F.col("open_rows").alias("_tail"),
        )
    out = carried(
        df, [key], [ts, *order], local, summary, carry,
        {"_open_us": "bigint", "_open_rows": "bigint"}, hot_rows, earlier,
    )
    before = F.when(F.col("_start").isNull(), F.col("_open_rows"))
    in_session = (
        F.col("_n") - F.coalesce("_start_n", F.lit(1)) + F.coalesce(before, F.lit(0))
    )
    start = F.coalesce("_start", "_open_us", "_first")
    out = out.withColumn("_at", in_session).withColumns(
        {
            "session_start": F.timestamp_micros(start),
            "part": F.expr(f"_at div {max_logs}"),
            "line_no": F.expr(f"_at % {max_logs}"),
        }
    )
    return out.drop(
        "_us", "_n", "_gap", "_first", "_start", "_start_n", "_open_us", "_open_rows", "_at"
    )


def left_open(
    chunked: DataFrame, key: str, ts: str, max_logs: int, order: str | list[str] = ()
) -> DataFrame:
    """One row per key: where its last session stands after these messages."""
    order = [order] if isinstance(order, str) else list(order)
    last = F.max(
        F.struct(
            micros(F.col(ts)).alias("last_us"),
            *order,
            micros(F.col("session_start")).alias("open_us"),
            (F.col("part") * max_logs + F.col("line_no") + 1).alias("open_rows"),
        )
    ).alias("last")
    return chunked.groupBy(key).agg(last).select(
        key, *[F.col(f"last.{c}").alias(c) for c in OPEN_COLUMNS]
    )


def spool_name(start_us, logs):
    """File name of a chunk: start in µs and number of lines, both in hex."""
    return F.format_string("%016x.%08x.log", start_us, logs)


def chunk_manifest(
    chunked: DataFrame, key: str, ts: str, hot_rows: int | None = None, after: int | None = None
) -> DataFrame:
    """One row per chunk: start time, line count and a file name.

    Names are unique in the whole table and sort by time: chunks that start in
    the same microsecond get the next free one. All lie behind the stamp ``after``.
    """
    chunks = chunked.groupBy(key, "session_start", "part").agg(
        F.min(ts).alias("start_ts"), F.count(F.lit(1)).alias("logs")
    )
    named = unique_micros(
        chunks, "start_ts", order=[key, "part"], name="start_us", hot_rows=hot_rows, after=after
    )
    return named.withColumn("file_name", spool_name(F.col("start_us"), F.col("logs")))
