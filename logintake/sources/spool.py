"""Spool folders: escaped lines in files whose names carry time and line count.

Three layouts are read. "files": the folder holds the files themselves. "folders": every
file is a folder ``spool_file=<name>``. "containers": many files lie in one container,
with a directory (see ``containers``); this is the one that is written.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logintake.functions.codec import escape
from logintake.operators.chunk import chunk_manifest, chunk_messages
from logintake.operators.manifest import spool_manifest
from logintake.session import written
from logintake.sources import containers
from logintake.sources.containers import NAME
from logintake.sources.files import list_files

FILES, FOLDERS, CONTAINERS = LAYOUTS = ("files", "folders", "containers")
PARTITION = "spool_file"
PATTERN = "*.*.log"


def _known(layout: str) -> None:
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")


def bare(value):
    """One carriage return before the newline belongs to the line end."""
    return F.when(
        value.endswith("\r"), F.substring(value, F.lit(1), F.length(value) - 1)
    ).otherwise(value)


def _lines(raw: DataFrame, layout: str) -> DataFrame:
    """Lines with the name of their file."""
    name = F.col({FILES: "_metadata.file_name", FOLDERS: PARTITION, CONTAINERS: NAME}[layout])
    return raw.select(name.alias(NAME), bare(F.col("value")).alias("value"))


def read_spool(spark: SparkSession, path: str, layout: str = FILES, where=None) -> DataFrame:
    """All lines of the spool files in ``path``: ``file_name`` and ``value``.

    ``where``, a condition on ``file_name``, selects files before any is opened; with
    files and folders a later filter does, too.
    """
    _known(layout)
    if layout == CONTAINERS:
        return _lines(containers.read_containers(spark, path, where), layout)
    reader = spark.read.option("lineSep", "\n")
    if layout == FOLDERS:
        reader = reader.schema(f"value string, {PARTITION} string")
    else:
        reader = reader.option("pathGlobFilter", PATTERN)
    lines = _lines(reader.text(path), layout)
    return lines if where is None else lines.filter(where)


def stream_spool(
    spark: SparkSession,
    path: str,
    layout: str = FILES,
    max_files: int | None = 1000,
    clean_source: str = "off",
    archive: str | None = None,
) -> DataFrame:
    """The same lines as a stream; ``max_files`` bounds a micro-batch (of containers, by
    the files of their manifest).

    ``clean_source`` is off, delete or archive; the checkpoint, not the removal
    of a file, decides what has been processed. Containers are not removed by a stream.
    """
    _known(layout)
    if layout == CONTAINERS:
        if clean_source != "off":
            raise ValueError("containers are removed by vacuum only")
        return _lines(containers.stream_containers(spark, path, max_files), layout)
    reader = (
        spark.readStream.option("lineSep", "\n")
        .option("cleanSource", clean_source)
        .schema("value string" + (f", {PARTITION} string" if layout == FOLDERS else ""))
    )
    if layout == FILES:
        reader = reader.option("pathGlobFilter", PATTERN)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("sourceArchiveDir", archive)
    return _lines(reader.text(path), layout)


def list_spool(spark: SparkSession, path: str, layout: str = FILES) -> DataFrame:
    """Manifest of the folder, empty files included, with the time ``modified`` at which
    each was last changed. No file is opened, and no name comes to the driver: folders are
    listed by tasks, and containers have a manifest."""
    _known(layout)
    if layout == CONTAINERS:
        changed = F.col("_metadata.file_modification_time").alias("modified")
        return spool_manifest(containers.manifest(spark, path).select(NAME, "bytes", changed))
    files = list_files(spark, path)
    if layout == FOLDERS:
        # A file is the folder's: there is one also where a folder holds only empty parts.
        name = F.url_decode(F.regexp_extract("path", f"^{PARTITION}=([^/]+)/", 1))
        files = files.filter(~F.element_at(F.split("path", "/"), -1).rlike("^[._]"))
        files = files.groupBy(name.alias(NAME)).agg(F.sum("bytes").alias("bytes"), F.max("modified").alias("modified"))
    else:
        files = files.filter(~F.contains("path", F.lit("/"))).select(F.col("path").alias(NAME), "bytes", "modified")
    return spool_manifest(files)


def write_spool(
    messages: DataFrame,
    path: str,
    key: str,
    ts: str,
    col: str,
    order: str | list[str] = (),
    max_idle: dt.timedelta = dt.timedelta(seconds=1),
    max_logs: int = 10_000,
    mode: str = "errorifexists",
    hot_rows: int | None = None,
) -> None:
    """Write messages as escaped lines, chunk by chunk of a sender, into containers.

    All chunks become visible together. With mode "append" their names go on behind the
    latest one in the folder, so that no name is given twice.
    """
    order = [order] if isinstance(order, str) else list(order)
    # Written: names and lines both need it, and the chunks are computed once.
    chunked = written(
        chunk_messages(
            messages.select(key, ts, *order, col), key, ts, order, max_idle, max_logs, hot_rows
        )
    )
    after = containers.latest_start(messages.sparkSession, path) if mode == "append" else None
    names = chunk_manifest(chunked, key, ts, hot_rows, after).select(
        *[F.col(c).alias("_" + c) for c in (key, "session_start", "part")], F.col("file_name").alias(NAME),
    )
    # Names on the left of an outer join: a chunk then always stays in one task,
    # because Spark may split the left side of it, but never the right one.
    on = F.lit(True)
    for c in (key, "session_start", "part"):
        on = on & F.col("_" + c).eqNullSafe(F.col(c))
    # Sent as a sort on both sides at every size: the lines are most of the input.
    lines = names.join(chunked.hint("merge"), on, "left").select(
        NAME, "line_no", escape(F.col(col)).alias("value")
    )
    containers.write_containers(lines, path, mode)
