"""Line dedup by content-defined chunks and passages of lines.

The lines of a text are hashed, and a rolling hash over the last lines decides where a
chunk ends, so that a passage is cut alike wherever it stands and whatever is inserted
elsewhere. A line of many words is a passage of its own and always a chunk. Of equal
chunks anywhere in the corpus the first stays and the others are removed from their texts.

Besides, from each line the shortest run of lines with enough words is a passage, and so
is the shortest run that ends with it. What two texts have in common is covered by such
runs wherever it begins and ends, so every repeated stretch goes that is long enough.

Runs are told apart by two 64-bit hashes made of two 64-bit hashes of each line. Those that
may occur more than once are compared by the hashes of all their lines, and these lines
byte by byte: hashes with two contents make it start again with another seed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from logintake.llm.tables import SPACE, bitmap, bytes_of, fresh, in_bitmap, nulls_last, slices
from logintake.session import written

# Lines that the rolling hash sees, lines of a chunk at least, and one line in so many
# ends a chunk beyond that.
WINDOW = 2
MIN_LINES = 2
DIVISOR = 2
# A line of so many words is a chunk.
LONG_LINE = 50
# Words of a passage at least.
PASSAGE = 50
SEEDS = 16
SEED = 42
# An odd factor for each of the two hashes of a run.
FACTORS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


class Chunks:
    """The chunks of a column's texts, in order: the text each belongs to, its number in
    it, its first and last byte, its lines, and whether it may be removed. A chunk may be
    if it has two lines or more, or one long line, and holds a word."""

    def __init__(
        self, column: pa.Array, window: int = WINDOW, min_lines: int = MIN_LINES,
        divisor: int = DIVISOR, long_line: int = LONG_LINE, passage: int = PASSAGE,
    ) -> None:
        data, starts = bytes_of(column)
        # A line begins at each start of a text and behind each newline within it.
        at = np.flatnonzero(data == 10) + 1
        begin = np.concatenate([starts[:-1], at])
        doc = np.concatenate([np.arange(len(column)), np.searchsorted(starts, at - 1, "right") - 1])
        order = np.lexsort((np.concatenate([np.zeros(len(column), int), np.ones(len(at), int)]), begin, doc))
        begin, doc = begin[order], doc[order]
        last = np.append(doc[1:] != doc[:-1], True) if len(doc) else np.zeros(0, bool)
        # The newline belongs to no line.
        end = np.where(last, starts[doc + 1], np.append(begin[1:], 0) - 1)
        solid = ~SPACE[data]
        first = solid.copy()
        first[1:] &= ~solid[:-1]
        heads = starts[:-1][starts[:-1] < starts[1:]]
        first[heads] = solid[heads]
        words = np.flatnonzero(first)
        n_words = np.searchsorted(words, end) - np.searchsorted(words, begin)
        del solid, first, words

        self.raw, digest = data.tobytes(), xxhash.xxh64_intdigest
        raw = self.raw
        hashes = np.fromiter(
            (digest(raw[a:b], SEED) for a, b in zip(begin.tolist(), end.tolist())), np.uint64, len(begin)
        )
        rolled = np.zeros(len(hashes), np.uint64)
        for back in range(min(window, len(hashes))):
            # Lines of another text do not count.
            own = np.zeros(len(hashes), np.uint64)
            own[back:] = np.where(doc[back:] == doc[: len(doc) - back], hashes[: len(doc) - back], 0)
            turn = np.uint64(back % 64)
            rolled ^= (own << turn) | (own >> ((np.uint64(64) - turn) % np.uint64(64))) if back else own
        marked = (rolled >> np.uint64(32)) % np.uint64(divisor) == 0

        cut, size = [], 0
        for i, (ends, long, mark) in enumerate(zip(last.tolist(), (n_words >= long_line).tolist(), marked.tolist())):
            if long and size:
                cut.append(i)
                size = 0
            size += 1
            if long or ends or (mark and size >= min_lines):
                cut.append(i + 1)
                size = 0
        cut = np.array(cut, np.int64)
        head = np.concatenate(([0], cut[:-1])) if len(cut) else cut
        self.head, self.stop, self.lines = head, cut, cut - head
        self.held = np.concatenate(([0], np.cumsum(n_words)))
        held = self.held[cut] - self.held[head]
        self.removable = (held > 0) & ((self.lines > 1) | (held >= long_line))
        # The lines: their text, its first one, and their bytes.
        self.doc, self.begin, self.end, self.passage = doc, begin, end, passage
        self.first = np.searchsorted(doc, doc)

    def forward(self) -> tuple[np.ndarray, np.ndarray]:
        """First line and end of the shortest passage from each line with a word, if any."""
        head = np.flatnonzero(np.diff(self.held))
        stop = np.searchsorted(self.held, self.held[head] + self.passage)
        fits = stop <= np.searchsorted(self.doc, self.doc[head], "right")
        return head[fits], stop[fits]

    def backward(self) -> tuple[np.ndarray, np.ndarray]:
        """The same of the shortest passage that ends with each line with a word."""
        stop = np.flatnonzero(np.diff(self.held)) + 1
        head = np.searchsorted(self.held, self.held[stop] - self.passage, "right") - 1
        fits = head >= self.first[stop - 1]
        return head[fits], stop[fits]

    def contents(self, some: np.ndarray) -> list[bytes]:
        """The bytes of lines."""
        raw = self.raw
        return [raw[a:b] for a, b in zip(self.begin[some].tolist(), self.end[some].tolist())]


class Runs:
    """Hashes of runs of lines, each in the same time."""

    def __init__(self, chunks: Chunks, seed: int, digests) -> None:
        n = len(chunks.begin)
        self.ids = digests(chunks.contents(np.arange(n)), seed)
        self.powers, self.sums = [], []
        for ids, factor in zip(self.ids, FACTORS):
            up = np.full(n + 1, factor, np.uint64)
            up[0] = 1
            up = np.cumprod(up, dtype=np.uint64)
            down = np.full(n + 1, pow(factor, -1, 1 << 64), np.uint64)
            down[0] = 1
            self.powers.append(np.cumprod(down, dtype=np.uint64))
            self.sums.append(np.concatenate((np.zeros(1, np.uint64), np.cumsum(ids.view(np.uint64) * up[:n], dtype=np.uint64))))
        self.bytes = np.column_stack(self.ids).tobytes()

    def hashes(self, head: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out = []
        for sums, powers in zip(self.sums, self.powers):
            h = (sums[stop] - sums[head]) * powers[head] + (stop - head).astype(np.uint64)
            # The low bits depend on little of the lines, and the filter looks at the top ones.
            for _ in range(2):
                h = (h ^ (h >> np.uint64(32))) * np.uint64(FACTORS[0])
            out.append((h ^ (h >> np.uint64(32))).view(np.int64))
        return out[0], out[1]

    def sequences(self, head: np.ndarray, stop: np.ndarray) -> list[bytes]:
        """The hashes of all lines of each run."""
        return [self.bytes[16 * a : 16 * b] for a, b in zip(head.tolist(), stop.tolist())]


def _digests(contents: list[bytes], seed: int) -> tuple[np.ndarray, np.ndarray]:
    digest = xxhash.xxh64_intdigest
    return tuple(
        np.fromiter((digest(c, s) for c in contents), np.uint64, len(contents)).view(np.int64)
        for s in (2 * seed, 2 * seed + 1)
    )


def row_key(id_col: str, text_col: str) -> list[Column]:
    """Two hashes of id and text. Rows that share both are one document here."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return [F.xxhash64(F.lit(i), F.col(id_col).cast("long"), text) for i in (1, 2)]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    k1, k2 = row_key(id_col, text_col)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), k1.alias("k1"), k2.alias("k2"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )


def _candidates(rows: DataFrame, seed: int, digests, options: dict) -> DataFrame:
    """The first hashes of chunks and passages that occur more than once."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            chunks = Chunks(batch.column("text"), **options)
            runs = Runs(chunks, seed, digests)
            some = np.flatnonzero(chunks.removable)
            head, stop = _united((chunks.head[some], chunks.stop[some]), chunks.forward())
            yield pa.RecordBatch.from_arrays([pa.array(runs.hashes(head, stop)[0])], ["h1"])

    found = rows.select("text").mapInArrow(run, "h1 long")
    return found.groupBy("h1").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def _united(*runs: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """First lines and ends of all runs, each once."""
    head, stop = (np.concatenate(x) for x in zip(*runs))
    both = np.unique(head << 32 | stop)
    return both >> 32, both & 0xFFFFFFFF


def _likely(chunks: Chunks, runs: Runs, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chunks and passages that the filter lets through. A passage is repeated only if
    the shortest one from its first line is."""
    def passed(head: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return in_bitmap(bits, runs.hashes(head, stop)[0].view(np.uint64))

    some = np.flatnonzero(chunks.removable)
    some = some[passed(chunks.head[some], chunks.stop[some])]
    head, stop = chunks.forward()
    hit = passed(head, stop)
    begins = np.zeros(len(chunks.begin) + 1, bool)
    begins[head[hit]] = True
    back, end = chunks.backward()
    own = np.flatnonzero(begins[back])
    return _united((chunks.head[some], chunks.stop[some]), (head[hit], stop[hit]), (back[own], end[own]))


def _occurrences(rows: DataFrame, bits: np.ndarray, seed: int, digests, options: dict) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            chunks = Chunks(batch.column("text"), **options)
            runs = Runs(chunks, seed, digests)
            head, stop = _likely(chunks, runs, shared.value)
            own = pa.array(chunks.doc[head])
            whole = np.zeros(len(chunks.begin) + 1, np.int64)
            some = np.flatnonzero(chunks.removable)
            whole[chunks.head[some]] = chunks.stop[some]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(own) for c in ("doc_id", "k1", "k2")),
                 pa.array((head - chunks.first[head]).astype(np.int32)), pa.array((stop - head).astype(np.int32)),
                 pa.array(whole[head] == stop), *map(pa.array, runs.hashes(head, stop)),
                 pa.array(runs.sequences(head, stop), pa.binary())],
                ["doc_id", "k1", "k2", "number", "lines", "chunk", "h1", "h2", "sequence"],
            )

    return rows.mapInArrow(
        run, "doc_id long, k1 long, k2 long, number int, lines int, chunk boolean, h1 long, h2 long, sequence binary"
    )


def _contents(rows: DataFrame, repeated: np.ndarray, seed: int, digests, options: dict) -> DataFrame:
    """Hashes and bytes of the lines of all runs whose first hash may occur more than once."""
    bits = rows.sparkSession.sparkContext.broadcast(repeated)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            chunks = Chunks(batch.column("text"), **options)
            runs = Runs(chunks, seed, digests)
            hit = _covered(*_likely(chunks, runs, bits.value), len(chunks.begin))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(ids[hit]) for ids in runs.ids), pa.array(chunks.contents(hit), pa.binary())],
                ["h1", "h2", "content"],
            )

    return rows.select("text").mapInArrow(run, "h1 long, h2 long, content binary")


def _covered(head: np.ndarray, stop: np.ndarray, n: int) -> np.ndarray:
    """The lines, out of n, that lie in one of the runs."""
    turns = np.bincount(head, minlength=n + 1) - np.bincount(stop, minlength=n + 1)
    return np.flatnonzero(np.cumsum(turns)[:n])


def repeated_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests=_digests, **options
) -> DataFrame:
    """``k1, k2, numbers``: the lines to remove from each document, by its key, as the first
    line and the end of each run, and whether it is a chunk."""
    rows = _keyed(docs, id_col, text_col)
    for seed in range(SEEDS):
        bits = bitmap(_candidates(rows, seed, digests, options), "h1")
        found = written(_occurrences(rows, bits, seed, digests, options))
        # A document that is repeated as a whole, id and all, counts once.
        place = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(nulls_last("doc_id"))], "k1", "k2", "number")
        groups = written(found.groupBy("h1", "h2", "sequence").agg(
            F.count(F.lit(1)).alias("n"), F.min(place).alias("first")
        ).drop("sequence"))
        if not groups.groupBy("h1", "h2").agg(F.count("n").alias("n")).filter("n > 1").isEmpty():
            continue
        groups = groups.filter("n > 1")
        contents = _contents(rows, bitmap(groups, "h1"), seed, digests, options)
        distinct = contents.groupBy("h1", "h2", "content").agg(F.count(F.lit(1)).alias("n"))
        if distinct.groupBy("h1", "h2").agg(F.count("n").alias("n")).filter("n > 1").isEmpty():
            break
    else:
        raise ValueError(f"none of {SEEDS} seeds tells the lines apart")
    # Written, so that the join can split a run that many documents hold.
    own = (F.col("first.k1") == F.col("k1")) & (F.col("first.k2") == F.col("k2"))
    later = found.drop("sequence").join(groups.drop("n"), ["h1", "h2"]).filter(~own | (F.col("first.number") != F.col("number")))
    # Where a run overlaps the first one, the lines of the first stay.
    head = F.when(own, F.greatest("number", F.col("first.number") + F.col("lines"))).otherwise(F.col("number"))
    gone = F.struct(head.alias("head"), (F.col("number") + F.col("lines")).alias("stop"), "chunk")
    return written(later.groupBy("k1", "k2").agg(F.sort_array(F.collect_set(gone)).alias("numbers")))


def drop_repeated_chunks(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counts: bool = False,
    digests=_digests, **options,
) -> DataFrame:
    """The rows of ``docs``, all columns, their texts without repeated chunks and passages.

    A passage is any run of lines of ``passage`` words or more that begins and ends with a
    word's line. Of equal ones the one in the document with the smallest id stays, in a
    document the first; a null id comes last. Rows with the same id and text are one document and get
    the same text. No row is dropped: a text that is repeated as a whole becomes
    empty, and a null text stays null. Lines are cut at ``\\n`` and joined by it again; a
    text in which nothing is repeated stays as it is, byte by byte.

    What goes is decided for each chunk and passage by itself. So the first copy of a long
    passage can lose a part that stands earlier still: of "A B", "B C" and "B C", in this
    order, "A B", "C" and nothing are left. Each line is left somewhere, and no passage twice.

    ``options`` are those of ``Chunks``. With ``counts`` two columns are added at the end,
    repeated chunks, and lines in chunks or passages: ``removed_chunks`` and
    ``removed_lines``, with underscores in front where ``docs`` has such columns.
    """
    removed = repeated_runs(docs, id_col, text_col, digests, **options)
    k1, k2, numbers, whole = fresh(docs, "k1", "k2", "numbers", "whole")
    names = docs.columns
    keyed = docs.withColumns({
        k1: row_key(id_col, text_col)[0], k2: row_key(id_col, text_col)[1], whole: F.col(text_col).cast("string"),
    })
    others = [c for c in names if c != text_col]
    # A merge at every size: what is removed grows with the documents.
    gone = removed.toDF(k1, k2, numbers).hint("merge")
    rows = keyed.drop(text_col).join(gone, [k1, k2], "left").select(*others, whole, numbers)
    schema = StructType([
        *(f for f in docs.schema.fields if f.name != text_col), docs.schema[text_col],
    ])
    counted = fresh(docs, "removed_chunks", "removed_lines") if counts else []
    for name in counted:
        schema = schema.add(name, LongType())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, whole):
            texts = batch.column(whole).cast(pa.string()).to_pylist()
            listed = batch.column(numbers)
            n_chunks, n_lines = [0] * batch.num_rows, [0] * batch.num_rows
            hit = np.flatnonzero(listed.is_valid().to_numpy(zero_copy_only=False))
            if len(hit):
                some = batch.take(pa.array(hit))
                chunks = Chunks(some.column(whole), **options)
                first = np.searchsorted(chunks.doc, np.arange(len(hit) + 1)).tolist()
                for i, (row, gone) in enumerate(zip(hit.tolist(), some.column(numbers).to_pylist())):
                    n = first[i + 1] - first[i]
                    head, stop = (np.array([x[c] for x in gone], np.int64) for c in ("head", "stop"))
                    lines = _covered(head, stop, n)
                    stay = np.delete(np.arange(first[i], first[i + 1]), lines)
                    texts[row] = b"\n".join(chunks.contents(stay)).decode()
                    n_chunks[row] = sum(x["chunk"] for x in gone)
                    n_lines[row] = len(lines)
            columns = [batch.column(c) for c in others] + [pa.array(texts, batch.column(whole).type)]
            if counts:
                columns += [pa.array(n_chunks, pa.int64()), pa.array(n_lines, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())

    out = rows.mapInArrow(run, schema)
    return out.select(*names, *counted)
