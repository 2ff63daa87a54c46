"""Files of a shared folder: opened and listed by tasks, never by the driver."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logintake.session import written

FILE = "path string, folder boolean, bytes long, modified timestamp"
# Entries handed on at a time.
ENTRIES = 10_000


def filesystem(path: str):
    """The file system of a folder, and the path in it."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path)


def entries(path: str, folder: str) -> Iterator[tuple]:
    """Path below ``path``, whether it is a folder, bytes and time of what lies in ``folder``."""
    from pyarrow import fs as kinds

    fs, base = filesystem(path)
    base = base.rstrip("/")
    found = fs.get_file_info(kinds.FileSelector(f"{base}/{folder}".rstrip("/"), allow_not_found=not folder))
    for info in found:
        at = None if info.mtime_ns is None else info.mtime_ns // 1000
        yield info.path[len(base) + 1 :], info.type == kinds.FileType.Directory, info.size or 0, at


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """All files below ``path``: ``path`` (from there), ``bytes`` and ``modified``.

    Folders are listed by tasks, level by level, each with its own; no name comes to the
    driver. A folder that is not there has no files. No file is opened.
    """
    schema = pa.schema([("path", pa.string()), ("folder", pa.bool_()), ("bytes", pa.int64()), ("modified", pa.timestamp("us", "UTC"))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column("path").to_pylist():
                rows: list[tuple] = []
                for row in entries(path, folder):
                    rows.append(row)
                    if len(rows) == ENTRIES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    level = spark.createDataFrame([("",)], "path string")
    found = None
    while True:
        rows = written(level.mapInArrow(run, FILE))
        found = rows if found is None else found.unionByName(rows)
        level = rows.filter("folder").select("path")
        more = level.count()
        if not more:
            return found.filter("NOT folder").drop("folder")
        # Dealt out one by one, however few bytes their names have.
        tasks = min(more, 4 * spark.sparkContext.defaultParallelism)
        level = level.repartition(tasks, F.xxhash64("path"))
