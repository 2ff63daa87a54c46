"""What went wrong, and how often."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from logintake.operators.parse import REASONS


def error_lines(parsed: DataFrame) -> DataFrame:
    """Undecodable lines with code and reason."""
    return parsed.filter(F.col("error_code").isNotNull()).select(
        "error_code", "error_reason", "raw"
    )


def error_report(parsed: DataFrame) -> DataFrame:
    """Number of undecodable lines by code."""
    return (
        parsed.filter(F.col("error_code").isNotNull())
        .groupBy("error_code", "error_reason")
        .agg(F.count(F.lit(1)).alias("lines"))
    )


def observed(
    parsed: DataFrame, name: str | Observation = "intake", by_code: bool = False
) -> DataFrame:
    """The same rows; counts lines and errors on the way, if asked also by code.

    In a stream the numbers appear in the progress of each micro-batch. The
    counts by code take planning time that a short micro-batch will notice.
    """
    codes = [
        F.count_if(F.col("error_code") == code).alias(f"error_{code}")
        for code in (REASONS if by_code else ())
    ]
    return parsed.observe(
        name, F.count(F.lit(1)).alias("lines"), F.count("error_code").alias("errors"), *codes
    )


# Sketches of a day: registers of distinct senders (2 to this power), and error texts
# whose counts are kept.
REGISTERS = 14
TRACKED = 10_000


def day_sketches(
    parsed: DataFrame, day: Column | None = None, text: Column | str = "error_reason",
    registers: int = REGISTERS, tracked: int = TRACKED,
) -> DataFrame:
    """One row per day: ``day, lines, errors`` and two sketches of bounded size, ``senders``
    (distinct hostnames of messages) and ``texts`` (frequent error texts).

    The day of a message is that of its date; ``day`` is that of undecodable lines, which
    have none, by default null. Sketches of batches can be merged in any order.
    """
    undecoded = F.col("error_code").isNotNull()
    day = F.lit(None).cast("date") if day is None else day
    text = F.col(text) if isinstance(text, str) else text
    rows = parsed.select(
        F.when(undecoded, day).otherwise(F.to_date("date")).alias("day"), undecoded.alias("undecoded"),
        F.when(~undecoded, F.col("hostname")).alias("sender"), F.when(undecoded, text).alias("text"),
    )
    return rows.groupBy("day").agg(
        F.count(F.lit(1)).alias("lines"), F.count_if("undecoded").alias("errors"),
        F.hll_sketch_agg("sender", F.lit(registers)).alias("senders"),
        F.expr(f"approx_top_k_accumulate(text, {tracked}) FILTER (WHERE text IS NOT NULL)").alias("texts"),
    )


def merge_sketches(sketches: DataFrame, by: Column | None = None, tracked: int = TRACKED) -> DataFrame:
    """Sketches put together by day, or by another column of the day, as its month."""
    by = F.col("day") if by is None else by
    return sketches.groupBy(by.alias("day")).agg(
        F.sum("lines").alias("lines"), F.sum("errors").alias("errors"),
        F.hll_union_agg("senders").alias("senders"),
        F.expr(f"approx_top_k_combine(texts, {tracked})").alias("texts"),
    )


def read_sketches(sketches: DataFrame, top: int = 5) -> DataFrame:
    """``day, lines, errors, senders`` (estimated) and ``texts``: the most frequent error
    texts with their counts. Exact while a day has few senders against the registers and no
    more texts than are tracked; else senders are off by about 1.04 / sqrt(registers), and a
    count is too small by at most about lines / tracked."""
    return sketches.select(
        "day", "lines", "errors", F.hll_sketch_estimate("senders").alias("senders"),
        F.expr(f"approx_top_k_estimate(texts, {top})").alias("texts"),
    )
