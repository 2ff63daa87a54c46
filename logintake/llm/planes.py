"""Token ids in files of bit planes.

A file holds the ids of documents in ascending order of their ids. Ids come in chunks
of a fixed number; a chunk is transposed into planes, one per bit (or byte) of an id,
and each plane is compressed on its own with zstandard. The end of the file holds the
documents' ids and lengths, and the chunk index: where each plane of each chunk lies.
So any stretch of ids is read without the rest.

    magic, planes of chunk 0, planes of chunk 1, ..., documents, index, length of the
    index (8 bytes), magic

One task writes one file under a name of its own. A file counts once its row is in the
manifest, a table that Spark commits; what a lost attempt has written is not in it.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logintake.llm import tokens
from logintake.llm.tables import documents, filesystem, new_name, nulls_last, slices

MAGIC = b"IDPLANE1"
CHUNK_IDS = 65_536
MANIFEST = "manifest"
LEVEL = 3


def to_planes(ids: np.ndarray, kind: str = "bit") -> list[bytes]:
    """Compressed planes of a chunk, lowest first; planes above the largest id are left out."""
    compress = zstandard.ZstdCompressor(level=LEVEL).compress
    bits = int(ids.max()).bit_length() if len(ids) else 0
    if kind == "byte":
        rows = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
        return [compress(rows[:, b].tobytes()) for b in range((bits + 7) // 8)]
    return [
        compress(np.packbits(((ids >> np.uint32(b)) & 1).astype(np.uint8)).tobytes())
        for b in range(bits)
    ]


def from_planes(planes: list[bytes], n: int, kind: str = "bit") -> np.ndarray:
    expand = zstandard.ZstdDecompressor().decompress
    ids = np.zeros(n, np.uint32)
    for b, plane in enumerate(planes):
        data = np.frombuffer(expand(plane), np.uint8)
        if kind == "byte":
            ids |= data.astype(np.uint32) << np.uint32(8 * b)
        else:
            ids |= np.unpackbits(data, count=n).astype(np.uint32) << np.uint32(b)
    return ids


def write_file(parts: Iterable[tuple[list, np.ndarray, np.ndarray]], out, chunk_ids: int, kind: str) -> dict:
    """Write parts of (document ids, ids, starts); returns the counts of the file."""
    chunks, doc_ids, lengths, held, n_held, at = [], [], [], [], 0, len(MAGIC)
    out.write(MAGIC)

    def put(ids: np.ndarray) -> None:
        nonlocal at
        planes = to_planes(ids, kind)
        chunks.append([at, len(ids), [len(p) for p in planes]])
        for plane in planes:
            out.write(plane)
            at += len(plane)

    for names, ids, starts in parts:
        doc_ids += names
        lengths.append(np.diff(starts))
        held.append(ids)
        n_held += len(ids)
        if n_held >= chunk_ids:
            ids = np.concatenate(held)
            full = n_held - n_held % chunk_ids
            for lo in range(0, full, chunk_ids):
                put(ids[lo : lo + chunk_ids])
            held, n_held = [ids[full:]], n_held - full
    if n_held:
        put(np.concatenate(held))
    sizes = np.concatenate([*lengths, np.zeros(0, np.int64)]).astype("<i8")
    known = np.array([i is not None for i in doc_ids], np.uint8)
    names = np.array([i or 0 for i in doc_ids], "<i8")
    table = zstandard.ZstdCompressor(level=LEVEL).compress(
        known.tobytes() + names.tobytes() + sizes.tobytes()
    )
    out.write(table)
    n_ids = int(sizes.sum())
    index = json.dumps({
        "kind": kind, "chunks": chunks, "documents": [at, len(table), len(doc_ids)], "ids": n_ids,
    }).encode()
    out.write(index + len(index).to_bytes(8, "little") + MAGIC)
    return {"n_docs": len(doc_ids), "n_ids": n_ids}


class IdFile:
    """Random access to the ids of a file; ``source`` is an open file of pyarrow."""

    def __init__(self, source) -> None:
        self.source = source
        size = source.size()
        tail = source.read_at(16, size - 16)
        if tail[8:] != MAGIC or source.read_at(8, 0) != MAGIC:
            raise ValueError("not a file of id planes")
        length = int.from_bytes(tail[:8], "little")
        self.index = json.loads(source.read_at(length, size - 16 - length))
        self.ends = np.cumsum([n for _, n, _ in self.index["chunks"]], dtype=np.int64)

    def documents(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each document has an id, the ids, and the lengths."""
        at, size, n = self.index["documents"]
        raw = zstandard.ZstdDecompressor().decompress(self.source.read_at(size, at))
        return (
            np.frombuffer(raw, np.uint8, n),
            np.frombuffer(raw, "<i8", n, n),
            np.frombuffer(raw, "<i8", n, 9 * n),
        )

    def chunk(self, i: int) -> np.ndarray:
        at, n, sizes = self.index["chunks"][i]
        raw = self.source.read_at(sum(sizes), at)
        cut = np.cumsum([0, *sizes]).tolist()
        return from_planes([raw[a:b] for a, b in zip(cut, cut[1:])], n, self.index["kind"])

    def stretch(self, start: int, stop: int) -> np.ndarray:
        """Ids from start up to stop; reads only the chunks that hold them."""
        first, last = np.searchsorted(self.ends, [start, stop - 1], "right").tolist()
        if stop <= start:
            return np.zeros(0, np.uint32)
        ids = np.concatenate([self.chunk(i) for i in range(first, last + 1)])
        before = int(self.ends[first - 1]) if first else 0
        return ids[start - before : stop - before]

    def each(self) -> Iterator[tuple[int | None, list[np.ndarray]]]:
        """Documents with their ids, in parts where they reach over chunks."""
        known, names, sizes = self.documents()
        i, ids = -1, np.zeros(0, np.uint32)
        for has, name, size in zip(known.tolist(), names.tolist(), sizes.tolist()):
            parts = []
            while size > len(ids):
                parts.append(ids)
                size -= len(ids)
                i, ids = i + 1, self.chunk(i + 1)
            parts.append(ids[:size])
            ids = ids[size:]
            yield name if has else None, parts


def write_ids(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_ids: int = CHUNK_IDS,
    kind: str = "bit",
) -> DataFrame:
    """Write the ids of all texts to files in ``folder``, which all executors share, and
    return the manifest: ``part, file, n_docs, n_ids``, one row per file.

    Files follow each other in ascending order of the document ids, across ``part``. A
    null id comes last; rows with the same id keep the order in which they were read. A
    null or empty text has the end id alone. No rows give files without documents, or
    no files.
    """
    order = [*nulls_last("doc_id"), "row"]
    rows = (
        documents(docs, id_col, text_col)
        .withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        file = new_name(f"ids-{part:06d}", ".planes")

        def encoded():
            for batch in slices(batches, limit=tokens.SLICE_BYTES):
                ids, starts = tokens.encode(batch.column("text"), tokenizer, end_id)
                yield batch.column("doc_id").to_pylist(), ids, starts

        with fs.open_output_stream(f"{base}/{file}") as out:
            counts = write_file(encoded(), out, chunk_ids, kind)
        yield pa.RecordBatch.from_pylist([{"part": part, "file": file, **counts}])

    rows.mapInArrow(write, "part long, file string, n_docs long, n_ids long").write.parquet(
        f"{folder.rstrip('/')}/{MANIFEST}"
    )
    return manifest(docs.sparkSession, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema("part long, file string, n_docs long, n_ids long").parquet(
        f"{folder.rstrip('/')}/{MANIFEST}"
    )


def read_ids(spark: SparkSession, folder: str, digest: bool = False) -> DataFrame:
    """One row per document of a folder: ``doc_id, start, n_tokens`` and ``ids``, or
    ``ids_crc32`` of the ids as little-endian unsigned 32-bit integers if ``digest``.

    ``start`` counts the ids of all documents before. One task reads one file.
    """
    files = manifest(spark, folder)
    # One row per file: the window holds as many rows as the writing job had tasks.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    files = files.repartition(max(1, files.count()), "part")

    def row(name: int | None, start: int, parts: list[np.ndarray]) -> dict:
        out = {"doc_id": name, "start": start, "n_tokens": sum(map(len, parts))}
        if digest:
            crc = 0
            for part in parts:
                crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
            return {**out, "ids_crc32": crc}
        return {**out, "ids": np.concatenate(parts).astype(np.int64)}

    value = pa.field("ids_crc32", pa.int64()) if digest else pa.field("ids", pa.list_(pa.int64()))
    schema = pa.schema([
        ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), value,
    ])

    def load(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = filesystem(folder)
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                held, size = [], 0
                with fs.open_input_file(f"{base}/{file}") as source:
                    for name, parts in IdFile(source).each():
                        held.append(row(name, start, parts))
                        start += held[-1]["n_tokens"]
                        size += 1 if digest else held[-1]["n_tokens"]
                        if size >= 1 << (14 if digest else 20):
                            yield pa.RecordBatch.from_pylist(held, schema)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    last = "ids_crc32 long" if digest else "ids array<long>"
    return files.select("file", "start").mapInArrow(
        load, f"doc_id long, start long, n_tokens long, {last}"
    )
