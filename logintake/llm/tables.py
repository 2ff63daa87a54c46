"""Small helpers shared by the operators."""

from __future__ import annotations

import ctypes
import os
import uuid
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Bits of a filter on hashes: 8 MB.
BITMAP_BITS = 26

# Text that a task works on at a time.
SLICE_BYTES = 2 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only ``doc_id`` and ``text``; a null text is empty. Other columns, whatever
    their names, stay outside."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def nulls_last(column: Column | str) -> list[Column]:
    """Sort keys that put a null behind all values."""
    column = F.col(column) if isinstance(column, str) else column
    return [column.isNull(), column]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names for working columns that the frame has not got."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column, and where each value starts
    (with the end of the last one). Nulls are empty."""
    wide = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = wide.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    if not len(wide):
        return flat[:0], np.zeros(1, np.int64)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(
    column: pa.Array, lower: bool = True, dropped: np.ndarray | None = None, apart: np.ndarray = SPACE
) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each value: the distinct ones, the number of
    each word among them, and where each value's words start (with the end).

    A-Z become a-z if ``lower``. Bytes of the table ``dropped`` are taken out of words,
    and a word of such bytes alone is none. Bytes of the table ``apart`` stand between words.
    Works on whole columns of bytes at once.
    """
    data, starts = bytes_of(column)
    if lower:
        data = LOWER[data]
    solid = ~apart[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    begins = starts[:-1][starts[:-1] < starts[1:]]
    first[begins] = solid[begins]
    if dropped is not None:
        word = np.cumsum(first)
        solid &= ~dropped[data]
        at = np.flatnonzero(solid)
        at = at[np.flatnonzero(np.diff(word[at], prepend=0))]
    else:
        at = np.flatnonzero(first)
    compact = np.concatenate(([0], np.cumsum(solid)))
    offsets = np.append(compact[at], compact[-1])
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data[solid])]
    ).dictionary_encode()
    return words.dictionary, words.indices.to_numpy(), np.searchsorted(at, starts)


def bitmap(rows: DataFrame, column: str) -> np.ndarray:
    """A bit for each value of the top ``BITMAP_BITS`` bits of a column of hashes that
    occurs: a filter of a fixed size, however many values there are."""
    place = f"shiftrightunsigned({column}, {64 - BITMAP_BITS})"
    words = rows.groupBy(F.expr(f"{place} div 64").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast({place} % 64 as int))")).alias("bits")
    ).toArrow()
    out = np.zeros(1 << BITMAP_BITS >> 6, np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out.view(np.uint64)


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes >> np.uint64(64 - BITMAP_BITS)
    return (bits[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES):
    """The batches in parts of at most ``limit`` bytes of a column, or of one row."""
    for batch in batches:
        _, starts = bytes_of(batch.column(column))
        lo = 0
        while lo < batch.num_rows:
            hi = int(np.searchsorted(starts, starts[lo] + limit, "right")) - 1
            hi = min(max(hi, lo + 1), batch.num_rows)
            yield batch.slice(lo, hi - lo)
            lo = hi
    give_back()


def give_back() -> None:
    """Return freed memory to the system: a Python worker serves many tasks, and what each
    left behind would add up beside the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def filesystem(path: str):
    """The file system of a shared folder, and the path in it."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), os.path.abspath(path)


def new_name(stem: str, suffix: str) -> str:
    """A file name that no other attempt of the task uses."""
    return f"{stem}-{uuid.uuid4().hex}{suffix}"
