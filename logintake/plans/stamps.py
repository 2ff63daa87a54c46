"""Stamps that are unique over all batches, not only within one.

Each batch takes its stamps behind the last one of the batch before, which is kept in a
table of a row per key. A batch that is repeated starts from the same table, so it gives
the same stamps again and none that an earlier batch gave.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logintake.operators.clock import unique_micros
from logintake.plans.tables import read_folder
from logintake.session import written

LAST = "last_us"


class StampBlocks:
    """Last stamps by batch, below ``root``. Batches are numbered without gaps."""

    def __init__(self, spark: SparkSession, root: str, key: str | list[str] | None = None) -> None:
        self.spark, self.root = spark, root
        self.keys = [key] if isinstance(key, str) else list(key or [])

    def before(self, batch_id: int, schema: str) -> DataFrame | None:
        """The last stamps that the batches before this one gave."""
        return read_folder(self.spark, f"{self.root}/batch_id={batch_id - 1}", schema) if batch_id else None

    def stamp(
        self, df: DataFrame, batch_id: int, ts: str, order: str | list[str] = (), name: str = "unique_us",
        hot_rows: int | None = None,
    ) -> DataFrame:
        """The batch with its stamps, as a written table; the last ones are kept."""
        kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in self.keys), f"{LAST} long"])
        known = self.before(batch_id, schema)
        if known is None and batch_id:
            raise ValueError(f"batch {batch_id - 1} has not been stamped")
        after = known
        if known is not None and not self.keys:
            after = known.first()[0]
        out = written(unique_micros(df, ts, self.keys, order, name, hot_rows, after))
        last = out.groupBy(*self.keys).agg(F.max(name).alias(LAST))
        if known is not None:
            # Keys that this batch has not got keep theirs.
            last = last.unionByName(known).groupBy(*self.keys).agg(F.max(LAST).alias(LAST))
        last.write.mode("overwrite").parquet(f"{self.root}/batch_id={batch_id}")
        return out
