"""What the names of spool files tell, and which files to take next."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logintake.operators.ordered import carried

def spool_manifest(files: DataFrame, name: str = "file_name") -> DataFrame:
    """Add ``start_ts`` and ``logs`` from the file name; drop other files.

    A spool file is named <hex µs>.<hex line count>.log, of 64 and 32 bits. A
    file still being written starts with a dot, and so has four parts.
    """
    parts = F.split(F.col(name), r"\.")
    good = (
        (F.size(parts) == 3)
        & (F.get(parts, F.lit(2)) == "log")
        & F.get(parts, F.lit(0)).rlike(r"^0*[0-9a-fA-F]{1,16}\z")
        & F.get(parts, F.lit(1)).rlike(r"^0*[0-9a-fA-F]{1,8}\z")
    )
    # A negative base reads the 64 bits as a signed number.
    start = F.conv(F.get(parts, F.lit(0)), 16, -10).cast("bigint")
    return files.filter(good).withColumns(
        {
            "start_ts": F.timestamp_micros(start),
            "logs": F.conv(F.get(parts, F.lit(1)), 16, 10).cast("bigint"),
        }
    )


def next_batch(
    manifest: DataFrame,
    min_logs: int = 10_000,
    name: str = "file_name",
    hot_rows: int | None = None,
) -> DataFrame:
    """Files in name order until they hold ``min_logs`` lines; the file that
    reaches the number belongs to the batch. Adds ``logs_upto``, the running sum."""

    def local(rows, window):
        upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return rows.withColumn("_sum", F.sum("logs").over(upto))

    def carry(sums, window):
        before = window.rowsBetween(Window.unboundedPreceding, -1)
        return sums.withColumn("_before", F.sum("_logs").over(before))

    out = carried(
        manifest, [], [name], local, {"_logs": F.sum("logs")}, carry,
        {"_before": "bigint"}, hot_rows,
    )
    out = out.withColumn("logs_upto", F.col("_sum") + F.coalesce("_before", F.lit(0)))
    first = F.col("logs_upto") - F.col("logs") < min_logs
    return out.filter(first).drop("_sum", "_before")


def spool_audit(lines: DataFrame, manifest: DataFrame, name: str = "file_name") -> DataFrame:
    """Declared against actual line count, per file of the manifest."""
    counted = lines.groupBy(name).agg(F.count(F.lit(1)).alias("actual"))
    return manifest.join(counted, name, "left").select(
        name,
        F.col("logs").alias("declared"),
        F.coalesce("actual", F.lit(0)).cast("bigint").alias("actual"),
        (F.coalesce("actual", F.lit(0)) - F.col("logs")).cast("bigint").alias("difference"),
    )
