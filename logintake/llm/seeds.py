"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask of words: some positions count, the others are ignored, so one
substituted word does not hide all matches around it. Hashes of the seeds of benchmark
items and documents are joined, and around each hit the words are compared along the
same alignment: an overlap is a window in which enough words agree. Items shorter than a
window have masks of their own, made of blocks of words.

Documents are scanned once, against a filter of fixed size made of the benchmark's
hashes, so only stretches around possible hits are moved, whatever the benchmark's size.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logintake.llm.tables import bitmap, fresh, in_bitmap, slices, words_of
from logintake.session import written

# Five words each. The first alone fits somewhere in any 13 words of which two differ.
MASKS = ("11010011", "1101011")
WINDOW = 13
SIMILARITY = 0.8
# Words from the first seed of a stretch to its last one at most.
STRETCH = 512
SEED = 42
MIX = np.uint64(0x9E3779B97F4A7C15)
PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[ord(c) for c in string.punctuation]] = True

SEGMENT = (
    "segment long, doc_id long, t1 long, t2 long, first long, words array<string>, "
    "hits array<struct<at: long, mask: int, h: long>>"
)


def agreeing(size: int, similarity: float) -> int:
    """Words that agree at least in an overlap of so many."""
    return math.ceil(similarity * size - 1e-9)


def masks_for(size: int, similarity: float) -> tuple[str, ...]:
    """Masks of which one fits wherever enough of so many words agree.

    Shorter windows than 13 words are cut into two blocks more than words may differ, and
    each mask is two of the blocks, or the whole where no word may differ.
    """
    differ = size - agreeing(size, similarity)
    if size >= WINDOW and differ <= 2:
        return MASKS
    if size <= differ:
        return ()
    parts = np.array_split(np.arange(size), min(differ + 2, size) if differ else 1)
    out = set()
    for blocks in combinations(parts, max(1, len(parts) - differ)):
        on = {int(i) for block in blocks for i in block}
        out.add("".join("01"[i in on] for i in range(min(on), max(on) + 1)))
    return tuple(sorted(out))


def seeds(hashes: np.ndarray, mask: str, number: int) -> np.ndarray:
    """The seed's hash at each position where the mask fits into all the words."""
    size = max(0, len(hashes) - len(mask) + 1)
    out = np.full(size, number + 1, np.uint64)
    for k in (i for i, c in enumerate(mask) if c == "1"):
        out = (out ^ hashes[k : k + size]) * MIX
        out ^= out >> np.uint64(29)
    return out


def _hashed(column: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    words, codes, starts = words_of(column, dropped=PUNCTUATION)
    words = words.to_pylist()
    digest = xxhash.xxh64_intdigest
    known = np.fromiter((digest(w, SEED) for w in words), np.uint64, len(words))
    return words, codes, starts, known[codes] if len(words) else np.zeros(0, np.uint64)


def _seeds_of(
    hashes: np.ndarray, starts: np.ndarray, masks: dict[int, str]
) -> Iterator[tuple[int, str, np.ndarray, np.ndarray]]:
    """Number, mask, positions and hashes of all seeds that lie within one value."""
    ends = np.repeat(starts[1:], np.diff(starts))
    for number, mask in masks.items():
        found = seeds(hashes, mask, number)
        at = np.flatnonzero(np.arange(len(found)) + len(mask) <= ends[: len(found)])
        yield number, mask, at, found[at]


def benchmark_seeds(
    benchmark: DataFrame, id_col: str, text_col: str, window: int, similarity: float
) -> tuple[DataFrame, DataFrame, dict[int, str]]:
    """Items with their words, their seeds ``item_id, h, mask, item_at``, written, and the
    masks by their numbers."""
    of_size = {size: masks_for(size, similarity) for size in range(1, window + 1)}
    numbers = {mask: n for n, mask in enumerate(sorted({m for masks in of_size.values() for m in masks}))}
    rows = benchmark.select(
        F.col(id_col).cast("long").alias("item_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).distinct().withColumn("item", F.monotonically_increasing_id())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, codes, starts, hashes = _hashed(batch.column("text"))
            hits: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            sizes = np.minimum(np.diff(starts), window)
            here = [size for size in np.unique(sizes).tolist() if size]
            masks = {numbers[mask]: mask for size in here for mask in of_size[size]}
            for number, mask, at, found in _seeds_of(hashes, starts, masks):
                doc = np.searchsorted(starts, at, "right") - 1
                # An item has the masks of its own size only.
                mine = np.isin(sizes[doc], [size for size in here if mask in of_size[size]])
                at, found, doc = at[mine], found[mine], doc[mine]
                own = (at - starts[doc]).tolist()
                for d, a, h in zip(doc.tolist(), own, found.view(np.int64).tolist()):
                    hits[d].append({"at": a, "mask": number, "h": h})
            lists = [
                [words[c].decode("utf-8", "replace") for c in codes[a:b]]
                for a, b in zip(starts.tolist(), starts[1:].tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), batch.column("item_id"), pa.array(lists, pa.list_(pa.string())),
                 pa.array(hits, _hits_type())],
                ["item", "item_id", "item_words", "hits"],
            )

    items = written(rows.mapInArrow(
        run, "item long, item_id long, item_words array<string>, "
        "hits array<struct<at: long, mask: int, h: long>>"
    ))
    found = items.select("item", F.explode("hits").alias("hit")).select(
        "item", F.col("hit.h").alias("h"), F.col("hit.mask").alias("mask"), F.col("hit.at").alias("item_at")
    )
    found = written(found)
    used = {r.mask for r in found.select("mask").distinct().collect()}
    return items.drop("hits"), found, {n: mask for mask, n in numbers.items() if n in used}


def _hits_type() -> pa.DataType:
    return pa.list_(pa.struct([("at", pa.int64()), ("mask", pa.int32()), ("h", pa.int64())]))


def _segments(docs: DataFrame, filter_bits: np.ndarray, known_masks: dict[int, str], window: int) -> DataFrame:
    """Stretches of documents around seeds that the filter lets through, none much longer
    than ``STRETCH``."""
    broadcast = docs.sparkSession.sparkContext.broadcast(filter_bits)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = broadcast.value
        number = TaskContext.get().partitionId() << 33
        for batch in slices(batches):
            words, codes, starts, hashes = _hashed(batch.column("text"))
            places, masks, values, stops = ([np.zeros(0, t)] for t in (np.int64, np.int64, np.uint64, np.int64))
            for n, mask, at, found in _seeds_of(hashes, starts, known_masks):
                hit = np.flatnonzero(in_bitmap(bits, found))
                places.append(at[hit])
                values.append(found[hit])
                masks.append(np.full(len(hit), n))
                stops.append(at[hit] + len(mask))
            order = np.argsort(np.concatenate(places), kind="stable")
            place, mask, value, stop = (np.concatenate(x)[order] for x in (places, masks, values, stops))
            doc = np.searchsorted(starts, place, "right") - 1
            reach = np.maximum.accumulate(stop) if len(stop) else stop
            new = np.ones(len(place), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (place[1:] - reach[:-1] > 2 * window)
            head = np.maximum.accumulate(np.where(new, np.arange(len(place)), 0))
            part = (place - place[head]) // STRETCH
            new[1:] |= part[1:] != part[:-1]
            cut = np.append(np.flatnonzero(new), len(place)).tolist()
            ids = {c: batch.column(c).to_pylist() for c in ("doc_id", "t1", "t2")} if len(place) else {}
            rows = []
            for a, b in zip(cut, cut[1:]):
                d = int(doc[a])
                lo = max(int(starts[d]), int(place[a]) - window)
                hi = min(int(starts[d + 1]), int(stop[a:b].max()) + window)
                rows.append({
                    "segment": number, **{c: v[d] for c, v in ids.items()}, "first": lo - int(starts[d]),
                    "words": [words[c].decode("utf-8", "replace") for c in codes[lo:hi]],
                    "hits": [
                        {"at": p - int(starts[d]), "mask": m, "h": h}
                        for p, m, h in zip(place[a:b].tolist(), mask[a:b].tolist(), value[a:b].view(np.int64).tolist())
                    ],
                })
                number += 1
            if rows:
                yield pa.RecordBatch.from_pylist(rows, pa.schema([
                    ("segment", pa.int64()), ("doc_id", pa.int64()), ("t1", pa.int64()), ("t2", pa.int64()),
                    ("first", pa.int64()), ("words", pa.list_(pa.string())), ("hits", _hits_type()),
                ]))

    return written(docs.mapInArrow(run, SEGMENT))


def best_window(words: list[str], item: list[str], shift: int, window: int) -> tuple[int, int]:
    """Most agreeing words in a window along an alignment, and the window's size: ``window``
    or the whole item if that is shorter. ``words[i]`` lies over ``item[i + shift]``."""
    size = min(window, len(item))
    same = [0 <= i - shift < len(words) and words[i - shift] == w for i, w in enumerate(item)]
    total = np.concatenate(([0], np.cumsum(same)))
    return int((total[size:] - total[:-size]).max()), size


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """One row per document and benchmark item that overlap: ``doc_id, item_id, matches,
    window`` and the hashes ``t1, t2`` of the document's text.

    Words are lower-cased and lose their ASCII punctuation. An overlap is a window of
    ``window`` words, or of the whole item if it is shorter, of which at least the share
    ``similarity`` agree along one alignment. ``matches`` is the most there are. Each such
    window holds a common seed, whatever the item's length. An item without words overlaps
    with nothing; nulls are empty texts. Null ids stay null. Rows with the same id and text give one row.
    """
    items, known, masks = benchmark_seeds(benchmark, item_col, item_text_col, window, similarity)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    keyed = rows.withColumns(dict(zip(("t1", "t2"), text_key("text"))))
    segments = _segments(keyed, bitmap(known, "h"), masks, window)
    hits = segments.select("segment", F.explode("hits").alias("hit")).select("segment", "hit.*")
    # Written, so that the joins can split a passage that many documents share.
    lines = written(
        hits.join(known, ["h", "mask"])
        .select("segment", "item", (F.col("at") - F.col("item_at")).alias("diagonal")).distinct()
    )
    pairs = written(lines.join(segments.drop("hits"), "segment"))
    pairs = pairs.join(items, "item")

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                matches, size = best_window(
                    row["words"], row["item_words"], row["first"] - row["diagonal"], window
                )
                if matches >= agreeing(size, similarity):
                    out.append({c: row[c] for c in ("doc_id", "t1", "t2", "item_id")} | {
                        "matches": matches, "window": size,
                    })
            if out:
                yield pa.RecordBatch.from_pylist(out, pa.schema([
                    (c, pa.int64()) for c in ("doc_id", "t1", "t2", "item_id", "matches", "window")
                ]))

    found = pairs.select("doc_id", "t1", "t2", "item_id", "words", "first", "diagonal", "item_words")
    found = found.mapInArrow(
        verify, "doc_id long, t1 long, t2 long, item_id long, matches long, window long"
    )
    return found.groupBy("doc_id", "t1", "t2", "item_id").agg(
        F.max("matches").alias("matches"), F.max("window").alias("window")
    )


def text_key(column: str) -> tuple:
    """Two hashes that tell texts apart."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.xxhash64(F.lit(1), text), F.xxhash64(F.lit(2), text)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, whose text overlaps with no benchmark item."""
    t1, t2 = fresh(docs, "t1", "t2")
    found = written(leaks(docs, benchmark, text_col=text_col, **options).select("t1", "t2").distinct())
    keyed = docs.withColumns(dict(zip((t1, t2), text_key(text_col))))
    # A merge at every size: what is found grows with the documents.
    return keyed.join(found.toDF(t1, t2).hint("merge"), [t1, t2], "left_anti").drop(t1, t2)
