"""How the words of each source differ from those of the other sources of a language.

Frequencies come from an index that is built in a single pass: a task counts the terms of
its documents in blocks of postings until its memory is full, sorts them by term and spills
them as a run, in segments by the hash of the term. One task per hash shard then merges the
segments of all runs: a heap tells the run whose block ends first, and what lies up to that
end, in any run, is complete and summed. Beyond a number of runs, groups of them are merged
to larger runs first. Only frequencies of kept terms leave the merge.

The distance of two sources is a sum over all kept terms, but most terms are rare in both.
So it starts from what two sources without any term would have, and is corrected for the
terms that one of them has, by their counts alone, and for those that both have, which are
streamed term by term into sums of pairs.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logintake.llm.tables import filesystem, give_back, new_name, slices, words_of
from logintake.session import shared_folder, written

LEAST_DOCS = 30
TOP = 50
SCALE = 1_000_000_000
ADDED = 5

# Bytes between terms: all of ASCII but its letters.
APART = np.zeros(256, bool)
APART[:128] = True
APART[65:91] = APART[97:123] = False

# Postings that a task holds, and that a merge task gets, in bytes; postings of a block of a
# run; runs merged at once; and the sources of a square of pair sums.
BLOCK_BYTES = 48 << 20
STRETCH_BYTES = 64 << 20
BLOCK_ROWS = 8192
FAN_IN = 64
TILE = 1024
SQUARES = 16

POSTING = pa.schema([
    ("key", pa.binary()), ("lang", pa.string()), ("term", pa.string()), ("source", pa.string()),
    ("count", pa.int64()), ("docs", pa.int64()),
])
NAMES = ["lang", "term", "source"]
SEGMENT = "shard int, file string, first int, stop int, bytes long"


def postings(batch: pa.RecordBatch) -> pa.Table:
    """Of each term, language and source of some documents: occurrences, and documents."""
    terms, codes, starts = words_of(batch.column("text"), apart=APART)
    both = pa.StructArray.from_arrays([batch.column("lang"), batch.column("source")], ["lang", "source"])
    # Groups by their number among the distinct ones.
    ranks = [c.dictionary_encode() for c in both.flatten()]
    group = ranks[0].indices.to_numpy().astype(np.int64) * len(ranks[1].dictionary) + ranks[1].indices.to_numpy()
    n = max(1, len(terms))
    doc = np.repeat(np.arange(batch.num_rows), np.diff(starts))
    keys, counts = np.unique(group[doc] * n + codes, return_counts=True)
    once = np.unique(doc * n + codes)
    _, docs = np.unique(group[once // n] * n + once % n, return_counts=True)
    lang, source = np.divmod(keys // n, max(1, len(ranks[1].dictionary)))
    return pa.table({
        "lang": ranks[0].dictionary.take(pa.array(lang)),
        "term": terms.take(pa.array(keys % n)).cast(pa.large_string()).cast(pa.string()),
        "source": ranks[1].dictionary.take(pa.array(source)), "count": counts, "docs": docs,
    })


def summed(parts: list[pa.Table]) -> pa.Table:
    """Equal postings added up."""
    whole = pa.concat_tables([p.select([*NAMES, "count", "docs"]) for p in parts])
    out = whole.group_by(NAMES).aggregate([("count", "sum"), ("docs", "sum")])
    return out.rename_columns([*NAMES, "count", "docs"])


def _keyed(table: pa.Table) -> pa.Table:
    """With the key by which runs are sorted: language, then term."""
    key = pc.binary_join_element_wise(
        table["lang"].cast(pa.binary()), table["term"].cast(pa.binary()), pa.scalar(b"\x00", pa.binary())
    )
    return table.add_column(0, "key", key).cast(POSTING)


class Run:
    """A run on disk: blocks of postings sorted by term, shard after shard."""

    def __init__(self, folder: str) -> None:
        self.file = new_name("run", ".arrow")
        fs, base = filesystem(folder)
        fs.create_dir(base, recursive=True)
        self.sink = fs.open_output_stream(f"{base}/{self.file}")
        self.writer = pa.ipc.new_file(self.sink, POSTING, options=pa.ipc.IpcWriteOptions(compression="zstd"))
        self.blocks, self.rows = 0, []

    def add(self, shard: int, tables: Iterable[pa.Table]) -> None:
        """The postings of a shard, sorted by key."""
        first, size = self.blocks, self.sink.tell()
        for table in tables:
            for lo in range(0, table.num_rows, BLOCK_ROWS):
                self.writer.write_batch(table.slice(lo, BLOCK_ROWS).combine_chunks().to_batches()[0])
                self.blocks += 1
        if self.blocks > first:
            self.rows.append((shard, self.file, first, self.blocks, self.sink.tell() - size))

    def close(self) -> pa.RecordBatch:
        self.writer.close()
        self.sink.close()
        names = [c.split()[0] for c in SEGMENT.split(", ")]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(
                list(zip(*self.rows)) or [()] * 5, (pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int64())
            )], names
        )


def spill(parts: list[pa.Table], folder: str, shards: int) -> pa.RecordBatch:
    """Write postings as a run; what it returns tells where each shard's segment lies."""
    table = _keyed(summed(parts))
    keys = table["key"].combine_chunks().dictionary_encode()
    digest = xxhash.xxh64_intdigest
    of_key = np.fromiter((digest(k) % shards for k in keys.dictionary.to_pylist()), np.int64, len(keys.dictionary))
    shard = of_key[keys.indices.to_numpy()]
    rank = np.empty(len(keys.dictionary), np.int64)
    rank[pc.sort_indices(keys.dictionary).to_numpy()] = np.arange(len(rank))
    order = np.lexsort((rank[keys.indices.to_numpy()], shard))
    table, shard = table.take(pa.array(order)), shard[order]
    run = Run(folder)
    for s in np.unique(shard).tolist():
        lo, hi = np.searchsorted(shard, [s, s + 1]).tolist()
        run.add(s, [table.slice(lo, hi - lo)])
    return run.close()


def build_runs(docs: DataFrame, folder: str, shards: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Spill the postings of documents (``lang, source, text``) as runs below ``folder``;
    the table of their segments. Files of attempts that were lost are in no table."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in slices(batches):
            parts.append(postings(batch))
            size += parts[-1].nbytes
            if size > block_bytes:
                # What is left once equal postings are added up may fit again.
                parts = [summed(parts)]
                size = parts[0].nbytes
                if size > block_bytes // 2:
                    yield spill(parts, folder, shards)
                    parts, size = [], 0
        if parts:
            yield spill(parts, folder, shards)
        give_back()

    return written(docs.select("lang", "source", "text").mapInArrow(run, SEGMENT))


def blocks_of(folder: str, file: str, first: int, stop: int) -> Iterator[pa.Table]:
    """The blocks of one segment, each read when it is asked for."""
    fs, base = filesystem(folder)
    with fs.open_input_file(f"{base}/{file}") as source:
        reader = pa.ipc.open_file(source)
        for i in range(first, stop):
            yield pa.Table.from_batches([reader.get_batch(i)])


def merged(streams: list[Iterator[pa.Table]]) -> Iterator[pa.Table]:
    """Sorted streams of postings as one sorted stream, equal postings added up. All
    postings of a term are in one of its tables."""
    heap = []

    def advance(i: int) -> None:
        table = next(streams[i], None)
        if table is not None:
            heapq.heappush(heap, (table["key"][-1].as_py(), i, table))

    for i in range(len(streams)):
        advance(i)
    held: list[pa.Table] = []
    while heap:
        # The block that ends first, and all others that end with the same key.
        bound, i, table = heapq.heappop(heap)
        held.append(table)
        advance(i)
        if heap and heap[0][0] == bound:
            continue
        # Of the other runs, what lies up to that key. Nothing of it is still to come.
        rest = []
        for last, j, other in heap:
            keys = other["key"].combine_chunks()
            cut = bisect_right(range(len(keys)), bound, key=lambda n: keys[n].as_py())
            if cut:
                held.append(other.slice(0, cut))
            rest.append((last, j, other.slice(cut)))
        heap[:] = rest
        heapq.heapify(heap)
        out = _keyed(summed(held))
        held = []
        yield out.take(pc.sort_indices(out["key"]))


def _tasks(segments: DataFrame, fan_in: int) -> tuple[DataFrame, int]:
    """Segments in groups of ``fan_in`` runs of a shard, a row each, and the most runs that
    a shard has. A task gets groups of about ``STRETCH_BYTES``."""
    order = Window.partitionBy("shard").orderBy("file", "first")
    numbered = segments.withColumn("n", F.row_number().over(order))
    numbered = written(numbered.withColumn("part", F.expr(f"cast((n - 1) div {fan_in} as int)")))
    most, size = numbered.agg(F.max("n"), F.sum("bytes")).first()
    groups = numbered.groupBy("shard", "part").agg(
        F.collect_list(F.struct("file", "first", "stop")).alias("segments")
    )
    tasks = max(1, -(-(size or 0) // STRETCH_BYTES), segments.sparkSession.sparkContext.defaultParallelism)
    return groups.repartition(tasks, "shard", "part"), most or 0


def merge_runs(groups: DataFrame, folder: str) -> DataFrame:
    """Each group of runs as one larger run; the table of their segments."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, listed in zip(batch.column("shard").to_pylist(), batch.column("segments").to_pylist()):
                out = Run(folder)
                out.add(shard, merged([blocks_of(folder, s["file"], s["first"], s["stop"]) for s in listed]))
                yield out.close()
        give_back()

    return written(groups.mapInArrow(run, SEGMENT))


def frequencies(
    docs: DataFrame, least_docs: int = LEAST_DOCS, shards: int | None = None,
    block_bytes: int = BLOCK_BYTES, fan_in: int = FAN_IN,
) -> DataFrame:
    """``lang, term, source, n, total, head``: occurrences of each kept term in each source
    that has it, and in its language; ``head`` is 1 in one of the rows of a term."""
    folder = shared_folder(docs.sparkSession)
    # Few enough that a run's segments stay long, as many as the runs ask for.
    shards = shards or min(1024, max(16, docs.rdd.getNumPartitions() // 4))
    groups, most = _tasks(build_runs(docs, folder, shards, block_bytes), fan_in)
    while most > fan_in:
        groups, most = _tasks(merge_runs(groups, folder), fan_in)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for listed in batch.column("segments").to_pylist():
                streams = [blocks_of(folder, s["file"], s["first"], s["stop"]) for s in listed]
                for table in merged(streams):
                    codes = table["key"].combine_chunks().dictionary_encode().indices.to_numpy()
                    docs_of, counts = table["docs"].to_numpy(), table["count"].to_numpy()
                    n = int(codes.max()) + 1
                    kept, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
                    np.add.at(kept, codes, docs_of)
                    np.add.at(total, codes, counts)
                    stay = np.flatnonzero(kept[codes] >= least_docs)
                    head = np.diff(codes, prepend=-1)[stay] != 0
                    some = table.take(pa.array(stay))
                    yield from pa.table({
                        **{name: some[name] for name in NAMES}, "n": some["count"], "total": total[codes[stay]],
                        "head": head.astype(np.int32),
                    }).combine_chunks().to_batches()
        give_back()

    return written(groups.mapInArrow(run, "lang string, term string, source string, n long, total long, head int"))


def _share(count: Column, total: Column, kept: Column) -> Column:
    """The smoothed share of a term, in billionths, one added; exact at any size."""
    wide = "decimal(28,0)"
    above = (count + ADDED).cast(wide) * F.lit(SCALE).cast("decimal(10,0)")
    below = (total.cast(wide) + kept.cast(wide) * F.lit(ADDED).cast("decimal(2,0)")).cast("decimal(30,0)")
    return F.call_function("div", above, below) + F.lit(1)


def pair_corrections(shared: DataFrame) -> DataFrame:
    """``lang, a, b, value``: for the terms that two sources share, what their distance
    differs by from the corrections of each alone. ``shared`` has a row per term: its
    language, and a list of sources with the share of the term (p) and of none (b)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, str], int] = {}
        names: list[str] = []
        sums: dict[tuple[str, int, int], np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, low, high), square in sums.items():
                i, j = np.nonzero(square)
                a = pa.array(names).take(pa.array(low * TILE + i))
                b = pa.array(names).take(pa.array(high * TILE + j))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(i), pa.string()), a, b, pa.array(square[i, j])], ["lang", "a", "b", "value"]
                )
            sums.clear()

        for batch in batches:
            for lang, entries in zip(batch.column("lang").to_pylist(), batch.column("entries").to_pylist()):
                at = []
                for e in entries:
                    at.append(known.setdefault(e["source"], len(names)))
                    if at[-1] == len(names):
                        names.append(e["source"])
                order = np.argsort(at)
                at = np.array(at)[order]
                p, b = (np.array([e[c] for e in entries], np.int64)[order] for c in ("p", "b"))
                tiles = np.unique(at // TILE).tolist()
                for low in tiles:
                    one = np.flatnonzero(at // TILE == low)
                    for high in tiles[tiles.index(low) :]:
                        other = np.flatnonzero(at // TILE == high)
                        more = (
                            np.abs(p[one, None] - p[other]) - np.abs(p[one, None] - b[other])
                            - np.abs(b[one, None] - p[other]) + np.abs(b[one, None] - b[other])
                        )
                        if low == high:
                            more = np.triu(more, 1)
                        if (lang, low, high) not in sums:
                            if len(sums) >= SQUARES:
                                yield from flush()
                            sums[lang, low, high] = np.zeros((TILE, TILE), np.int64)
                        sums[lang, low, high][np.ix_(at[one] % TILE, at[other] % TILE)] += more
        yield from flush()

    parts = shared.mapInArrow(run, "lang string, a string, b string, value long")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def source_divergence(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
    least_docs: int = LEAST_DOCS, top: int = TOP, **options,
) -> DataFrame:
    """``lang, source, part, item, value, rank`` for each source of each language.

    Part ``pair``: the distance to each other source of the language, over all kept terms.
    Part ``term``: the ``top`` terms that the source has and uses more than its language.
    Ranks count from 1 by descending value, then by item. A term is kept that at least
    ``least_docs`` documents of the language have; every row is a document, repeated rows
    included. Null texts, languages and sources are empty strings. A language in which no
    term is kept has distances of 0 and no terms, one with a single source no pairs; no
    rows give no rows. The result has a row per two sources of a language, and tasks hold
    sums for ``TILE`` sources by ``TILE``; a text is whole in its task's memory.
    """
    rows = docs.select(*[
        F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n)
        for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))
    ])
    found = frequencies(rows, least_docs, **options)
    languages = found.groupBy("lang").agg(F.sum("head").alias("kept"), F.sum("n").alias("lang_total"))
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = written(
        rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left")
        .join(languages, "lang", "left").na.fill(0)
        # Without kept terms nothing is divided.
        .withColumn("none", F.when(F.col("kept") > 0, _share(F.lit(0), F.col("total"), F.col("kept"))).otherwise(F.lit(0)))
    )
    used = found.withColumnRenamed("total", "term_total").join(groups, ["lang", "source"]).withColumns({
        "p": _share(F.col("n"), F.col("total"), F.col("kept")),
        "q": _share(F.col("term_total"), F.col("lang_total"), F.col("kept")),
    })
    used = written(used.select("lang", "source", "term", "n", "p", "q", "none"))
    terms = used.filter("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")
    )

    # One side: by the number of occurrences alone.
    alike = used.groupBy("lang", "source", "n", "p", "none").agg(F.count(F.lit(1)).alias("terms"))
    others = groups.select("lang", F.col("source").alias("other"), F.col("none").alias("other_none"))
    alone = alike.join(others, "lang").filter("source != other").groupBy("lang", "source", "other").agg(
        F.sum(F.expr("terms * (abs(p - other_none) - abs(none - other_none))")).alias("value")
    )
    entry = F.struct("source", "p", F.col("none").alias("b"))
    shared = used.groupBy("lang", "term").agg(F.collect_list(entry).alias("entries")).filter(F.size("entries") > 1)
    both = written(pair_corrections(shared.select("lang", "entries")))
    start = groups.join(others, "lang").filter("source != other").select(
        "lang", "source", "other", (F.col("kept") * F.abs(F.col("none") - F.col("other_none"))).alias("value")
    )
    turned = [F.col(c) for c in ("lang", "other", "source", "value")]
    named = ["lang", "source", "other", "value"]
    alone = written(alone)
    pairs = start
    for more in (alone, alone.select(*turned).toDF(*named), both.toDF(*named), both.select("lang", "b", "a", "value").toDF(*named)):
        pairs = pairs.unionByName(more)
    pairs = pairs.groupBy("lang", "source", "other").agg(F.sum("value").alias("value")).select(
        "lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value"
    )
    place = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    best = terms.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= top)
    return best.unionByName(pairs.withColumn("rank", F.row_number().over(place)))
