"""Write the tables of an intake run."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logintake.operators.route import (
    ERRORS,
    ROUTE,
    Processor,
    Processors,
    ending_in_catch_all,
    error_rows,
    processor_tables,
    route_first_match,
)
from logintake.session import written

DAY = "date_day"
INGEST_TIME = "ingest_time"

# Folders beside the tables: the tables of each batch, and the columns of each table.
ATTEMPTS, COLUMNS = "_attempts", "_columns"

Writer = Callable[[DataFrame, str], None]


def by_day(df: DataFrame, date: str = "date") -> DataFrame:
    """Rows laid out by day and sorted by time inside a file.

    Rebalancing, unlike partitioning by day, splits the day that has most rows.
    """
    laid = df.withColumn(DAY, F.to_date(date)).hint("rebalance", F.col(DAY))
    return laid.sortWithinPartitions(DAY, date)


class ParquetWriter:
    """Parquet tables under ``root``.

    Without a batch id rows are appended. With one, the folders of that batch are replaced,
    those of tables included that an earlier attempt wrote and this one does not know, so a
    repeated batch leaves neither a second copy nor stale rows. Which tables an attempt has
    is written before the tables.

    A table without rows is written too: its folder is there, and its columns are kept
    beside the tables, so that it can be read.
    """

    def __init__(self, root: str, batch_id: str | int | None = None) -> None:
        self.root, self.batch_id = root, batch_id

    def begin(self, spark: SparkSession, tables: list[str]) -> None:
        """Name the tables of this attempt; empty the batch's folders of all others."""
        if self.batch_id is None:
            return
        listed = f"{self.root}/{ATTEMPTS}/batch_id={self.batch_id}"
        known = read_folder(spark, listed, "table string")
        earlier = set() if known is None else {r[0] for r in known.collect()}
        both = sorted({*tables, *earlier})
        spark.createDataFrame([(t,) for t in both], "table string").coalesce(1).write.mode(
            "overwrite"
        ).parquet(listed)
        for table in sorted(earlier - set(tables)):
            nothing = spark.createDataFrame([], _schema(spark, self.root, table))
            self._write(nothing, table)

    def __call__(self, df: DataFrame, table: str) -> None:
        df.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{COLUMNS}/{table}")
        self._write(df, table)

    def _write(self, df: DataFrame, table: str) -> None:
        path, mode = f"{self.root}/{table}", "append"
        if self.batch_id is not None:
            path, mode = f"{path}/batch_id={self.batch_id}", "overwrite"
        if "date" in df.columns:
            by_day(df).write.mode(mode).partitionBy(DAY).parquet(path)
        else:
            df.write.mode(mode).parquet(path)


def parquet_writer(root: str, batch_id: str | int | None = None) -> Writer:
    return ParquetWriter(root, batch_id)


def read_folder(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The rows of a folder, or None if there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _schema(spark: SparkSession, root: str, table: str):
    return spark.read.parquet(f"{root}/{COLUMNS}/{table}").schema


def jdbc_writer(url: str, **options: str) -> Writer:
    """Append to the tables of a database, in the column order of the rows.

    The driver jar has to be on the class path. A repeated batch is appended a
    second time, as there is no folder to replace.
    """

    def write(df: DataFrame, table: str) -> None:
        df.write.format("jdbc").options(url=url, dbtable=table, **options).mode(
            "append"
        ).save()

    return write


def write_tables(
    parsed: DataFrame,
    write: Writer,
    chain: Processors | list[Processor] | None = None,
    ingest_time: Column | None = None,
    keep: str = "table",
) -> None:
    """Errors first, then one table after the other in the order of the chain.

    Every row goes to exactly one table: the catch-all stands behind every chain, and a
    processor that writes to the errors table adds to the quarantine, whose missing columns
    are null. All tables of the chain are written, with or without rows.

    Every table is a job of its own. So that the lines are parsed once, the
    routed rows are kept in a written table (``keep="table"``, for a run of any
    size), in executor memory and disk (``keep="cache"``, for a micro-batch), or
    not at all (``keep="none"``).
    """
    chain = ending_in_catch_all(chain)
    routed = route_first_match(parsed, chain)
    if keep == "table":
        routed = written(routed, partition_by=ROUTE)
    elif keep == "cache":
        routed = routed.persist()
    elif keep != "none":
        raise ValueError(f"keep must be table, cache or none, not {keep!r}")
    messages = routed.drop("error_code", "error_reason", "raw", INGEST_TIME)
    tables = {ERRORS: error_rows(routed, ingest_time)}
    for table, rows in processor_tables(messages, chain).items():
        known = tables.get(table)
        tables[table] = rows if known is None else known.unionByName(rows, allowMissingColumns=True)
    try:
        if hasattr(write, "begin"):
            write.begin(parsed.sparkSession, list(tables))
        for table, rows in tables.items():
            write(rows, table)
    finally:
        if keep == "cache":
            routed.unpersist()


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A written table without the columns of its layout, also if it has no rows."""
    stored = _schema(spark, root, table)
    path = f"{root}/{table}"
    return spark.read.option("basePath", path).schema(stored).parquet(path).select(*stored.names)
