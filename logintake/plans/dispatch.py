"""Intake of a spool folder as soon as enough lines wait in it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logintake.operators.route import Processor, Processors
from logintake.plans.tables import read_folder
from logintake.session import written
from logintake.sources.files import filesystem
from logintake.sources.spool import FILES, NAME, list_spool, stream_spool
from logintake.streaming.intake import FILES as TAKEN
from logintake.streaming.intake import ingest_stream

# Beside the tables: what has been taken, by a mark and the names behind it.
MARK = "_mark"
# By how much a file may appear later than its time of change tells.
SLACK = dt.timedelta(hours=1)


def taken_files(
    spark: SparkSession, root: str, listed: DataFrame, slack: dt.timedelta = SLACK
) -> tuple[DataFrame | None, int | None]:
    """What the batches so far have taken, and the number of the last one.

    All files changed before a mark have been taken; of those changed later the names are
    kept. The state is ``file_name, modified, mark``, a row without name among them. Names
    that batches have left since the last call are put into it, the mark moves up to
    ``slack`` before the latest change, but never past a file that still waits, and what
    is older is forgotten: neither the state nor its making grows with the batches that were.
    """
    schema = f"{NAME} string, modified timestamp, mark timestamp, batch_id long"
    state = read_folder(spark, f"{root}/{MARK}", schema)
    last = None if state is None else state.agg(F.max("batch_id")).first()[0]
    if last is not None:
        state = state.filter(F.col("batch_id") == last)
    left = read_folder(spark, f"{root}/{TAKEN}", f"{NAME} string, batch_id long")
    if left is not None and last is not None:
        left = left.filter(F.col("batch_id") > last)
    number = None if left is None else left.agg(F.max("batch_id")).first()[0]
    if number is None:
        return state, last
    # Files that are gone need not be remembered.
    fresh = left.select(NAME).distinct().join(listed.select(NAME, "modified"), NAME)
    known = fresh if state is None else fresh.unionByName(state.filter(F.col(NAME).isNotNull()).select(NAME, "modified"))
    known = written(known.groupBy(NAME).agg(F.max("modified").alias("modified")))
    before = None if state is None else state.agg(F.max("mark")).first()[0]
    waiting = waiting_files(listed, before, known).agg(F.min("modified")).first()[0]
    latest = known.agg(F.max("modified")).first()[0]
    mark = max((t for t in (before, latest - slack if latest else None) if t is not None), default=None)
    if mark is not None and waiting is not None:
        mark = min(mark, waiting)
    kept = known if mark is None else known.filter(F.col("modified") >= F.lit(mark))
    head = spark.createDataFrame([(None, None)], f"{NAME} string, modified timestamp")
    kept = kept.unionByName(head).withColumn("mark", F.lit(mark).cast("timestamp"))
    kept.write.mode("overwrite").parquet(f"{root}/{MARK}/batch_id={number}")
    _forget(f"{root}/{MARK}", number - 1)
    _forget(f"{root}/{TAKEN}", number)
    state = spark.read.schema(schema).parquet(f"{root}/{MARK}").filter(F.col("batch_id") == number)
    return state, number


def _forget(path: str, upto: int) -> None:
    """Remove the folders of batches up to a number: few, as each call removes them."""
    from pyarrow import fs as kinds

    fs, base = filesystem(path)
    for found in fs.get_file_info(kinds.FileSelector(base)):
        if found.base_name.startswith("batch_id=") and int(found.base_name[9:]) <= upto:
            fs.delete_dir(found.path)


def waiting_files(listed: DataFrame, mark: dt.datetime | None, known: DataFrame) -> DataFrame:
    """Listed files behind the mark whose names are not known."""
    behind = listed if mark is None else listed.filter(F.col("modified") >= F.lit(mark))
    return behind.join(known.filter(F.col(NAME).isNotNull()).select(NAME), NAME, "left_anti")


def dispatch(
    spark: SparkSession,
    spool: str,
    root: str,
    checkpoint: str | None = None,
    min_logs: int = 10_000,
    max_wait: dt.timedelta = dt.timedelta(seconds=10),
    waited: dt.timedelta | None = None,
    layout: str = FILES,
    chain: Processors | list[Processor] | None = None,
    max_files: int | None = None,
    clean_source: str = "off",
    archive: str | None = None,
    slack: dt.timedelta = SLACK,
    **options,
) -> int | None:
    """Take the waiting files of a spool folder in; returns the number of the last batch.

    Nothing happens, and the result is None, while the waiting files hold fewer than
    ``min_logs`` lines by their names and less than ``max_wait`` has passed since the last
    batch (``waited``; by default the wait is over). What has been processed is known to
    the checkpoint of a stream (by default below the tables), which takes all that waits
    and stops; a run that breaks is taken up by the next. Lines are counted in files that
    no batch has taken, as ``taken_files`` tells; ``slack`` is said there.
    ``clean_source`` retires files as in ``stream_spool``.
    """
    listed = written(list_spool(spark, spool, layout).select(NAME, "logs", "modified"))
    waiting, (state, _) = listed, taken_files(spark, root, listed, slack)
    if state is not None:
        waiting = waiting_files(listed, state.agg(F.max("mark")).first()[0], state)
    files, logs = waiting.agg(F.count(F.lit(1)), F.sum("logs")).first()
    if not files or (waited is not None and waited < max_wait and logs < min_logs):
        return None
    query = ingest_stream(
        stream_spool(spark, spool, layout, max_files, clean_source, archive),
        root, checkpoint or f"{root}/_checkpoint", chain, max_wait=None, names=NAME, **options,
    )
    query.awaitTermination()
    # Listed again: the stream may have taken what came meanwhile.
    listed = list_spool(spark, spool, layout).select(NAME, "modified")
    return taken_files(spark, root, listed, slack)[1]
