"""Tables with a versioned list of their files, and compaction of a day.

A table's files are never changed. Which of them make up the table is told by a list, with
a version for each change: a batch adds its files and replaces those of its earlier
attempt; a compaction replaces the small files of a day by a few large ones. A new list
becomes visible by one rename, so a reader sees a table before or after a change, never in
between, and a reader of an older version is not disturbed until ``vacuum``.

A list has the day of each file: who asks for a day opens the files of that day, and no
folder is listed.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from logintake.operators.ordered import carried
from logintake.plans.tables import ATTEMPTS, COLUMNS, DAY, by_day, read_folder
from logintake.session import written
from logintake.sources.files import filesystem, list_files

LIVE, DATA = "_live", "data"
FILE = "file string, day date, batches array<string>, bytes long"
TARGET_BYTES = 256 << 20
# Bytes of bins that a task of a compaction takes, if there are more than its cores keep busy.
TASK_BYTES = 32 << 20
# Times that a change is tried again on the version that another one has made.
TRIES = 20


class Conflict(RuntimeError):
    """Another change was faster, and both want the same files."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def versions(self) -> list[int]:
        """Numbers of the versions there are. One small name each, until ``vacuum``."""
        from pyarrow import fs as kinds

        fs, base = filesystem(f"{self.path}/{LIVE}")
        found = fs.get_file_info(kinds.FileSelector(base, allow_not_found=True))
        return sorted(int(f.base_name[8:]) for f in found if f.base_name.startswith("version="))

    def latest(self) -> int:
        return (self.versions() or [0])[-1]

    def live(self, version: int | None = None) -> DataFrame:
        """The files of a version: path below ``data``, day, the batches whose rows it holds,
        and bytes."""
        version = self.latest() if version is None else version
        if not version:
            return self.spark.createDataFrame([], FILE)
        return self.spark.read.schema(FILE).parquet(f"{self.path}/{LIVE}/version={version}")

    def change(self, gone: DataFrame | None = None, added: DataFrame | None = None, batch: str | None = None) -> int:
        """A new version without the files ``gone``, which must all be live, and without
        those of ``batch``, and with the files ``added``."""
        fs, base = filesystem(f"{self.path}/{LIVE}")
        fs.create_dir(base, recursive=True)
        n_gone = 0 if gone is None else gone.count()
        for _ in range(TRIES):
            version = self.latest()
            rows = live = self.live(version)
            if gone is not None:
                if live.join(gone.select("file"), "file", "left_semi").count() != n_gone:
                    raise Conflict("files to replace are not live any more")
                rows = rows.join(gone.select("file"), "file", "left_anti")
            if batch is not None:
                rows = rows.filter(~F.array_contains("batches", batch))
            if added is not None:
                rows = rows.unionByName(added)
            draft = f"draft-{uuid.uuid4().hex}"
            cores = self.spark.sparkContext.defaultParallelism
            rows.coalesce(cores).write.parquet(f"{self.path}/{LIVE}/{draft}")
            try:
                # Fails where the version has come to be meanwhile.
                if version + 1 not in self.versions():
                    fs.move(f"{base}/{draft}", f"{base}/version={version + 1}")
                    return version + 1
            except OSError:
                if version + 1 not in self.versions():
                    raise
        raise Conflict("other changes were always faster")

    def store(self, df: DataFrame, batch: str | None) -> DataFrame:
        """Write rows as files that are in no version yet; their list. Rows that have a
        ``date_day`` are laid out already, others are by their date."""
        attempt = uuid.uuid4().hex
        folder = f"{self.path}/{DATA}/{attempt}"
        if DAY not in df.columns and "date" in df.columns:
            df = by_day(df)
        writer = df.write.partitionBy(DAY) if DAY in df.columns else df.write
        writer.parquet(folder)
        # The files of one write; their bytes are not read.
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        files = listed.option("pathGlobFilter", "*.parquet").load(folder)
        return files.select(
            F.regexp_extract("path", f"/{DATA}/({attempt}/.+)$", 1).alias("file"),
            F.try_to_date(F.regexp_extract("path", f"/{DAY}=([0-9-]+)/", 1)).alias("day"),
            F.array_compact(F.array(F.lit(batch).cast("string"))).alias("batches"), F.col("length").alias("bytes"),
        )

    def files(self, version: int | None = None, day: dt.date | None = None) -> list[str]:
        """Paths of the files, of one day if asked for. As many names as a scan of them
        holds on the driver anyway."""
        rows = self.live(version)
        if day is not None:
            rows = rows.filter(F.col("day") == F.lit(day))
        return [f"{self.path}/{DATA}/{r.file}" for r in rows.select("file").collect()]

    def read(self, schema: StructType, version: int | None = None, day: dt.date | None = None) -> DataFrame:
        """The rows of a version, of the files of one day if asked for."""
        paths = self.files(version, day)
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)


def bins(files: DataFrame, target_bytes: int, hot_rows: int | None = None) -> DataFrame:
    """The files of each day packed into bins: ``file, day, bin``. Along their order, a file
    goes to the bin in which its first byte lies, so a day has at most bytes / target + 1,
    and a bin exceeds the target by less than one file."""
    def local(rows, window):
        upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return rows.withColumn("_sum", F.sum("bytes").over(upto))

    def carry(sums, window):
        before = window.rowsBetween(Window.unboundedPreceding, -1)
        return sums.withColumn("_before", F.sum("_bytes").over(before))

    out = carried(
        files.select("file", "day", "bytes"), ["day"], ["file"], local, {"_bytes": F.sum("bytes")}, carry,
        {"_before": "bigint"}, hot_rows,
    )
    first = F.col("_sum") - F.col("bytes") + F.coalesce("_before", F.lit(0))
    return out.select("file", "day", F.floor(first / F.lit(target_bytes)).cast("int").alias("bin"))


def dealt_out(packed: DataFrame, total_bytes: int) -> tuple[DataFrame, int]:
    """The bins given to tasks: ``day, bin, _task``, and how many tasks. They follow the
    bytes, however many days there are. Bins of a day are in different tasks, so a task,
    which makes a file for each day, makes one of each bin."""
    cores = packed.sparkSession.sparkContext.defaultParallelism
    found = packed.select("day", "bin").distinct()
    count, most = found.groupBy("day").count().agg(F.sum("count"), F.max("count")).first()
    tasks = min(count, max(most, 2 * cores, -(-total_bytes // TASK_BYTES)))
    # About one number for each ``target_bytes`` and day; those of a day are in a row.
    number = F.row_number().over(Window.orderBy("day", "bin")) - 1
    return found.withColumn("_task", number % tasks), tasks


def compact(
    spark: SparkSession, root: str, table: str, days: list[dt.date] | None = None,
    target_bytes: int = TARGET_BYTES, hot_rows: int | None = None,
) -> int | None:
    """Put the files of days, of all by default, together to files of about
    ``target_bytes``, rows by time; the new version, or None where nothing is to be gained.

    Only days are touched that have more files than they need. A file then holds rows of
    many batches, so none of these can be repeated any more, see ``VersionedWriter``.
    """
    found = VersionedTable(spark, f"{root}/{table}")
    version = found.latest()
    files = found.live(version).filter("day IS NOT NULL")
    if days is not None:
        files = files.filter(F.col("day").isin(days))
    need = F.ceil(F.sum("bytes") / F.lit(target_bytes))
    crowded = files.groupBy("day").agg(F.count(F.lit(1)).alias("n"), need.alias("need")).filter("n > need")
    small = written(files.join(crowded.select("day"), "day", "left_semi"))
    if small.isEmpty():
        return None
    packed = written(bins(small, target_bytes, hot_rows))
    numbered, tasks = dealt_out(packed, small.agg(F.sum("bytes")).first()[0])
    numbered = written(packed.join(numbered, ["day", "bin"]).select(F.col("file").alias("_file"), "day", "_task"))
    schema = _schema(spark, root, table)
    # The file of each row tells its bin.
    paths = [f"{found.path}/{DATA}/{r.file}" for r in small.select("file").collect()]
    rows = spark.read.schema(schema).parquet(*paths).select(
        "*", F.regexp_extract("_metadata.file_path", f"/{DATA}/([0-9a-f]{{32}}/.+)$", 1).alias("_file")
    )
    rows = rows.join(numbered, "_file").withColumnRenamed("day", DAY)
    rows = rows.repartitionById(tasks, F.col("_task")).sortWithinPartitions(DAY, "date")
    added = written(found.store(rows.select(*schema.names, DAY), None))
    of_day = small.select("day", F.explode("batches").alias("b")).groupBy("day").agg(
        F.sort_array(F.collect_set("b")).alias("batches")
    )
    nothing = F.array().cast("array<string>")
    added = added.drop("batches").join(of_day, "day", "left").select(
        "file", "day", F.coalesce("batches", nothing).alias("batches"), "bytes"
    )
    return found.change(gone=small, added=added)


class VersionedWriter:
    """A writer for ``intake`` and ``ingest_stream``: each table of a batch becomes one new
    version, which replaces what an earlier attempt of the batch has written, in tables
    included that this attempt has not got. Without a batch id rows are appended.

    A batch can be repeated until files of it have been compacted; then it is refused.
    """

    def __init__(self, root: str, batch_id: str | int | None = None) -> None:
        self.root, self.batch = root, None if batch_id is None else str(batch_id)

    def _refuse_compacted(self, spark: SparkSession, table: str) -> None:
        live = VersionedTable(spark, f"{self.root}/{table}").live()
        if not live.filter(F.array_contains("batches", self.batch) & (F.size("batches") > 1)).isEmpty():
            raise ValueError(f"batch {self.batch} is part of compacted files of {table}")

    def begin(self, spark: SparkSession, tables: list[str]) -> None:
        if self.batch is None:
            return
        listed = f"{self.root}/{ATTEMPTS}/batch_id={self.batch}"
        known = read_folder(spark, listed, "table string")
        earlier = set() if known is None else {r[0] for r in known.collect()}
        for table in sorted(earlier | set(tables)):
            self._refuse_compacted(spark, table)
        both = sorted({*tables, *earlier})
        spark.createDataFrame([(t,) for t in both], "table string").coalesce(1).write.mode("overwrite").parquet(listed)
        for table in sorted(earlier - set(tables)):
            VersionedTable(spark, f"{self.root}/{table}").change(batch=self.batch)

    def __call__(self, df: DataFrame, table: str) -> None:
        spark, found = df.sparkSession, VersionedTable(df.sparkSession, f"{self.root}/{table}")
        df.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/{COLUMNS}/{table}")
        added = written(found.store(df, self.batch))
        found.change(added=added, batch=self.batch)


def versioned_writer(root: str, batch_id: str | int | None = None) -> VersionedWriter:
    return VersionedWriter(root, batch_id)


def _schema(spark: SparkSession, root: str, table: str) -> StructType:
    return spark.read.parquet(f"{root}/{COLUMNS}/{table}").schema


def read_versioned(
    spark: SparkSession, root: str, table: str, version: int | None = None, day: dt.date | None = None
) -> DataFrame:
    """The rows of a table of ``VersionedWriter``, of one day if asked for."""
    return VersionedTable(spark, f"{root}/{table}").read(_schema(spark, root, table), version, day)


def vacuum(spark: SparkSession, root: str, table: str, keep: int = 1, before=None) -> int:
    """Forget all but the last ``keep`` versions, and delete files that none of these has
    and that are older than ``before``, a time since which no write of now has been running;
    how many files."""
    found = VersionedTable(spark, f"{root}/{table}")
    numbers = found.versions()
    fs, base = filesystem(f"{root}/{table}/{LIVE}")
    for number in numbers[:-keep]:
        fs.delete_dir(f"{base}/version={number}")
    used = None
    for number in numbers[-keep:]:
        rows = found.live(number).select("file")
        used = rows if used is None else used.unionByName(rows)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(f"{root}/{table}/{DATA}")
        for batch in batches:
            for name in batch.column("file").to_pylist():
                fs.delete_file(f"{base}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    old = list_files(spark, f"{root}/{table}/{DATA}").filter("path LIKE '%.parquet'")
    if before is not None:
        old = old.filter(F.col("modified") < F.lit(before))
    old = old.select(F.col("path").alias("file"))
    if used is not None:
        old = old.join(used.distinct(), "file", "left_anti")
    return old.mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
