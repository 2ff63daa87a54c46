"""Packing into windows of equal capacity by multiway differencing.

Documents of a task are cut into pieces and packed group by group. Each piece begins as
a partial partition: itself in one window, all others empty. The two partitions with
the largest imbalance are merged, the fullest window of one with the emptiest of the
other, until one partition is left: its windows are nearly equal (Karmarkar and Karp,
1982). If one of them exceeds the capacity, the group gets one more window.

A group takes tokens until its windows are full but for a little slack, and a document
may be cut at its end, so only the last group of a task has windows with room. Nothing
is shuffled, and a task holds the tokens of one group.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from logintake.llm import tokens
from logintake.llm.tables import documents, slices

CAPACITY = 4096
WINDOWS = 32
PIECE = 512
SLACK = 24


def differencing(sizes: list[int], windows: int) -> tuple[np.ndarray, np.ndarray]:
    """The window of each size, and what each window holds."""
    heap = []
    for i, size in enumerate(sizes):
        sums = np.zeros(windows, np.int64)
        sums[0] = size
        heap.append((-size, i, sums, None))
    heapq.heapify(heap)
    # How each merge arranged its windows, to find the pieces in them afterwards.
    merges, number = {}, len(sizes)
    while len(heap) > 1:
        _, a, one, _ = heapq.heappop(heap)
        _, b, other, _ = heapq.heappop(heap)
        sums = one + other[::-1]
        order = np.argsort(-sums, kind="stable")
        sums = sums[order]
        merges[number] = (a, b, order)
        heapq.heappush(heap, (int(sums[-1] - sums[0]), number, sums, None))
        number += 1
    placed = np.zeros(len(sizes), np.int64)
    if not heap:
        return placed, np.zeros(windows, np.int64)
    _, root, sums, _ = heap[0]
    todo = [(root, np.arange(windows))]
    while todo:
        node, window = todo.pop()
        if node < len(sizes):
            placed[node] = window[0]
            continue
        a, b, order = merges[node]
        before = np.empty(windows, np.int64)
        before[order] = window
        todo += [(a, before), (b, before[::-1])]
    return placed, sums


def windows_of(sizes: list[int], capacity: int, least: int) -> np.ndarray:
    """The window of each size, in ``least`` windows or as few more as hold them."""
    while True:
        placed, sums = differencing(sizes, least)
        if sums.max() <= capacity:
            return placed
        least += 1


class Packer:
    """Packs a stream of documents; each piece is a row as ``pack`` returns it."""

    def __init__(self, first_id: int, capacity: int, windows: int, piece: int, slack: int, ids: bool) -> None:
        self.next_id, self.capacity, self.windows = first_id, capacity, windows
        self.piece, self.slack, self.ids = min(piece, capacity), slack, ids
        self.full = windows * (capacity - slack)
        self.held: list[tuple] = []
        self.size = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[dict]:
        start = 0
        while start < len(ids):
            n = min(self.piece, len(ids) - start, self.full - self.size)
            self.held.append((doc_id, start, ids[start : start + n], len(ids)))
            self.size += n
            start += n
            if self.size == self.full:
                yield from self.close()

    def close(self) -> Iterator[dict]:
        if not self.held:
            return
        least = -(-self.size // self.capacity)
        placed = windows_of([len(h[2]) for h in self.held], self.capacity, least)
        filled: dict[int, int] = {}
        sequence: dict[int, int] = {}
        for (doc_id, start, ids, total), window in zip(self.held, placed.tolist()):
            at = filled.get(window, 0)
            row = {
                "doc_id": doc_id, "start": start, "length": len(ids),
                "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes()), "doc_tokens": total,
                "sequence_id": self.next_id + sequence.setdefault(window, len(sequence)),
                "offset": at,
            }
            if self.ids:
                row["ids"] = ids.astype(np.int64)
            filled[window] = at + len(ids)
            yield row
        self.next_id += len(sequence)
        self.held, self.size = [], 0


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    windows: int = WINDOWS,
    piece: int = PIECE,
    slack: int = SLACK,
    ids: bool = True,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset`` and, if asked for, ``ids``.

    ``start`` counts the document's ids before the piece, ``offset`` those before it in
    its sequence. A sequence holds at most ``capacity`` ids. Each document ends with
    ``end_id``, so a null or empty text is a piece of one id; null and repeated document
    ids are packed like others. No rows give no rows. A text is whole in its task's
    memory, however long, and its pieces go to several groups.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
        ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
        ("offset", pa.int64()), *([("ids", pa.list_(pa.int64()))] if ids else []),
    ])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId() << 33, capacity, windows, piece, slack, ids)
        for batch in slices(batches, limit=tokens.SLICE_BYTES):
            flat, starts = tokens.encode(batch.column("text"), tokenizer, end_id)
            rows = []
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                rows += packer.add(doc_id, flat[starts[i] : starts[i + 1]])
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema)
        rows = list(packer.close())
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)

    names = [f"{f.name} {'array<long>' if f.name == 'ids' else 'long'}" for f in schema]
    return documents(docs, id_col, text_col).mapInArrow(run, ", ".join(names))
