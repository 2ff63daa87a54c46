"""Strictly increasing microsecond stamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logintake.operators.ordered import carried


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a timestamp column, with or without zone."""
    return F.unix_micros(ts.cast("timestamp"))


def unique_micros(
    df: DataFrame,
    ts: str,
    key: str | list[str] | None = None,
    order: str | list[str] = (),
    name: str = "unique_us",
    hot_rows: int | None = None,
    after: int | DataFrame | None = None,
) -> DataFrame:
    """Add a stamp per row: its time in µs, or one more than the stamp before it,
    whichever is later. Without ``key`` the stamps are unique in the whole table.

    ``after`` is the last stamp given before: a number or, with ``key``, a table of the key
    and ``last_us``. ``plans.stamps`` keeps it from batch to batch.

    Rows are taken by ``ts`` and ``order``. The rule step by step,
    ``stamp = max(now, previous + 1)``, equals the largest ``now - n`` so far
    plus n, where n counts the rows.
    """
    keys = [key] if isinstance(key, str) else list(key or [])
    order = [order] if isinstance(order, str) else list(order)

    def local(rows, window):
        upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = rows.withColumn("_n", F.row_number().over(window).cast("bigint"))
        return rows.withColumn("_lead", F.max(micros(F.col(ts)) - F.col("_n")).over(upto))

    def carry(sums, window):
        before = window.rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.withColumn("_before", F.sum("_rows").over(before))
        lead = F.col("_top") - F.coalesce("_before", F.lit(0))
        return sums.withColumn("_lead_before", F.max(lead).over(before))

    earlier, floor = None, F.lit(None).cast("bigint")
    if isinstance(after, DataFrame):
        # A summary of no rows, whose last stamp is still ahead of what follows.
        earlier = after.select(*keys, F.lit(0).cast("bigint").alias("_rows"), F.col("last_us").alias("_top"))
    elif after is not None:
        floor = F.lit(after).cast("bigint")
    out = carried(
        df, keys, [ts, *order], local,
        {"_rows": F.count(F.lit(1)), "_top": F.max("_lead")},
        carry, {"_before": "bigint", "_lead_before": "bigint"}, hot_rows, earlier,
    )
    before = F.coalesce("_before", F.lit(0))
    lead = F.greatest(F.col("_lead") - before, F.col("_lead_before"), floor)
    return out.withColumn(name, lead + before + F.col("_n")).drop(
        "_n", "_lead", "_before", "_lead_before"
    )
