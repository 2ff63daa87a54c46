"""Container files: the lines of many spool files in one, with a chunk directory.

A container holds chunks, each behind a header line of its name and size, in the order of
their names. At its end stands a sparse index, the name and place of the first chunk of
each block, and a fixed tail that tells where the index begins. So one chunk is found by
two small reads and one of a block, and a whole container is read in one go.

Which chunks there are is told by a manifest, a table beside the containers. It is committed
by Spark when all tasks have written, so all chunks of a write become visible together, and
what lost attempts have written is in no manifest. ``rebuild_manifest`` makes it again from
the containers, if it is lost.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logintake.sources.files import filesystem, list_files

NAME = "file_name"
MANIFEST, DATA = "_manifest", "data"
CHUNK = f"{NAME} string, container string, lines long, bytes long"

# Fixed values of the format.
MAGIC = b"LSPOOL01"
TAIL = struct.Struct("<QII8s")
SUFFIX = ".spool"

# Bytes of a container, of a block of chunks between two entries of its index, and of
# the containers that a task reads.
CONTAINER_BYTES = 128 << 20
BLOCK_BYTES = 256 << 10
TASK_BYTES = 128 << 20


class ContainerWriter:
    """Writes one container, chunk after chunk, names ascending."""

    def __init__(self, path: str, block_bytes: int = BLOCK_BYTES) -> None:
        self.name = f"part-{uuid.uuid4().hex}{SUFFIX}"
        fs, base = filesystem(f"{path}/{DATA}")
        fs.create_dir(base, recursive=True)
        self.sink, self.block_bytes = fs.open_output_stream(f"{base}/{self.name}"), block_bytes
        self.at = self.chunks = 0
        self.index: list[tuple[str, int]] = []

    def add(self, name: str, payload: bytes) -> None:
        if not self.index or self.at - self.index[-1][1] >= self.block_bytes:
            self.index.append((name, self.at))
        head = f"{name}\t{len(payload)}\n".encode()
        self.sink.write(head)
        self.sink.write(payload)
        self.at += len(head) + len(payload)
        self.chunks += 1

    def close(self) -> None:
        index = zlib.compress(json.dumps(self.index).encode())
        self.sink.write(index)
        self.sink.write(TAIL.pack(self.at, len(index), self.chunks, MAGIC))
        self.sink.close()


class ContainerReader:
    """Chunks of one container by name."""

    def __init__(self, path: str, name: str) -> None:
        fs, base = filesystem(f"{path}/{DATA}")
        self.source = fs.open_input_file(f"{base}/{name}")
        size = self.source.size()
        self.end, length, self.chunks, magic = TAIL.unpack(self.source.read_at(TAIL.size, size - TAIL.size))
        if magic != MAGIC:
            raise ValueError(f"{name} is no container")
        index = json.loads(zlib.decompress(self.source.read_at(length, self.end)))
        self.firsts, self.places = [n for n, _ in index], [at for _, at in index] + [self.end]
        self.block_no, self.block = -1, {}

    def _load(self, i: int) -> dict[str, bytes]:
        if i != self.block_no:
            raw = self.source.read_at(self.places[i + 1] - self.places[i], self.places[i])
            self.block, self.block_no, at = {}, i, 0
            while at < len(raw):
                stop = raw.index(b"\n", at)
                name, _, size = raw[at:stop].rpartition(b"\t")
                at = stop + 1 + int(size)
                self.block[name.decode()] = raw[stop + 1 : at]
        return self.block

    def names(self) -> Iterator[tuple[str, bytes]]:
        for i in range(len(self.firsts)):
            yield from self._load(i).items()

    def find(self, name: str) -> bytes | None:
        """The lines of a chunk, each with its newline; None if it is not there."""
        i = bisect_right(self.firsts, name) - 1
        return self._load(i).get(name) if i >= 0 else None

    def close(self) -> None:
        self.source.close()


def write_containers(
    lines: DataFrame, path: str, mode: str = "errorifexists",
    container_bytes: int = CONTAINER_BYTES, block_bytes: int = BLOCK_BYTES,
) -> None:
    """Write ``file_name, line_no, value`` as chunks, each in one task and in the order of
    ``line_no``. A row with a null value gives a chunk without that line, and so one
    without any. All rows of a name have to lie in one partition; a null name is refused.

    ``mode`` is errorifexists, append or overwrite, as of a table; containers that an
    overwritten manifest named stay until ``vacuum``. A task holds one chunk at a time.
    """
    schema = pa.schema([(NAME, pa.string()), ("container", pa.string()), ("lines", pa.int64()), ("bytes", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: ContainerWriter | None = None
        rows: list[tuple] = []
        name, held = None, []

        def put() -> None:
            nonlocal out, held
            if name is None:
                return
            if out is None:
                out = ContainerWriter(path, block_bytes)
            payload = b"\n".join(held) + b"\n" if held else b""
            out.add(name, payload)
            rows.append((name, out.name, len(held), len(payload)))
            held = []
            if out.at >= container_bytes:
                out.close()
                out = None

        for batch in batches:
            names = batch.column(NAME).dictionary_encode()
            if names.null_count:
                raise ValueError("a chunk without name")
            codes, values = names.indices.to_numpy(), batch.column("value").to_pylist()
            edges = np.flatnonzero(np.diff(codes, prepend=-1)).tolist() + [len(codes)]
            for lo, hi in zip(edges, edges[1:]):
                own = names.dictionary[int(codes[lo])].as_py()
                if own != name:
                    put()
                    name = own
                held += [v for v in values[lo:hi] if v is not None]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                rows = []
        put()
        if out is not None:
            out.close()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    rows = lines.select(NAME, "line_no", F.col("value").cast("binary").alias("value"))
    rows = rows.sortWithinPartitions(NAME, "line_no").select(NAME, "value")
    rows.mapInArrow(run, CHUNK).write.mode(mode).parquet(f"{path}/{MANIFEST}")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The committed chunks: ``file_name, container, lines, bytes``."""
    return spark.read.schema(CHUNK).parquet(f"{path}/{MANIFEST}")


def latest_start(spark: SparkSession, path: str) -> int | None:
    """The latest start in µs that a committed name tells; None if there is none."""
    start = F.conv(F.substring_index(NAME, ".", 1), 16, -10).cast("bigint")
    try:
        return manifest(spark, path).agg(F.max(start)).first()[0]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def lines_of(chunks: DataFrame, path: str) -> DataFrame:
    """``file_name, value``: the lines of chunks of a manifest, in batch or in a stream.
    Chunks of one container should lie in one partition."""
    schema = pa.schema([(NAME, pa.string()), ("value", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, opened = None, None
        for batch in batches:
            for container, name in sorted(zip(batch.column("container").to_pylist(), batch.column(NAME).to_pylist())):
                if container != opened:
                    if reader is not None:
                        reader.close()
                    reader, opened = ContainerReader(path, container), container
                payload = reader.find(name)
                if payload is None:
                    raise ValueError(f"{container} has no chunk {name}")
                values = payload.split(b"\n")[:-1]
                if values:
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(values)), pa.array(values, pa.binary())], schema=schema)
        if reader is not None:
            reader.close()

    return chunks.select("container", NAME).mapInArrow(run, f"{NAME} string, value binary")


def read_containers(spark: SparkSession, path: str, where: Column | None = None, files: DataFrame | None = None) -> DataFrame:
    """All lines of a container folder: ``file_name`` and ``value``.

    Only chunks are read whose row of the manifest passes ``where`` and whose name is in
    ``files``; the blocks of others are passed over.
    """
    chunks = manifest(spark, path)
    if where is not None:
        chunks = chunks.filter(where)
    if files is not None:
        chunks = chunks.join(files.select(NAME).distinct(), NAME, "left_semi")
    # By the bytes of the lines: rows of the manifest alone would all fit into one task.
    size = manifest(spark, path).agg(F.sum("bytes")).first()[0] or 0
    cores = spark.sparkContext.defaultParallelism
    chunks = chunks.repartition(max(cores, -(-size // TASK_BYTES)), "container").sortWithinPartitions("container", NAME)
    return lines_of(chunks, path).select(NAME, F.col("value").cast("string").alias("value"))


def stream_containers(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same lines as a stream that follows the manifest; ``max_files`` bounds the files
    of the manifest, one per task that wrote, of a micro-batch."""
    reader = spark.readStream.schema(CHUNK)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = lines_of(reader.parquet(f"{path}/{MANIFEST}"), path)
    return rows.select(NAME, F.col("value").cast("string").alias("value"))


def rebuild_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest as the containers themselves tell it, of lost attempts included."""
    schema = pa.schema([(NAME, pa.string()), ("container", pa.string()), ("lines", pa.int64()), ("bytes", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for container in batch.column("path").to_pylist():
                reader = ContainerReader(path, container)
                rows = [(n, container, p.count(b"\n"), len(p)) for n, p in reader.names()]
                reader.close()
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    files = list_files(spark, f"{path}/{DATA}").filter(F.col("path").endswith(SUFFIX))
    files = files.repartition(spark.sparkContext.defaultParallelism, "path")
    return files.select("path").mapInArrow(run, CHUNK)


def vacuum(spark: SparkSession, path: str, before) -> int:
    """Delete containers that no manifest names and that are older than ``before`` (a time
    since which no write of now has been running); how many."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(f"{path}/{DATA}")
        for batch in batches:
            for name in batch.column("path").to_pylist():
                fs.delete_file(f"{base}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    old = list_files(spark, f"{path}/{DATA}").filter(F.col("modified") < F.lit(before))
    known = manifest(spark, path).select(F.col("container").alias("path")).distinct()
    gone = old.join(known, "path", "left_anti").select("path").mapInArrow(run, "n long")
    return gone.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
