"""SimHash near-dedup with bit-sliced comparison.

Fingerprints that differ in at most ``radius`` bits are linked, and linked documents form
components. Equal fingerprints are one from the start. Candidates come from pigeonholes:
of ``blocks`` blocks of bits, two fingerprints within the radius agree on at least
``blocks - radius``, so they meet in a bucket of one choice of that many blocks.

Within buckets, bits are stored vertically: word b of 64 lanes holds bit b of 64
fingerprints. A fingerprint is compared with 64 at a time: the differing lanes of each
plane are added to counters that are themselves bit planes, with carry-save adds, and a
word is abandoned once all its lanes exceed the radius. Buckets lie side by side in the
lanes, so small ones share words.

A bucket above a bound is dealt out again, by the distance from its centre, the majority
of each bit. Members far from it agree on the bits of the key, so their differences lie in
the others, and these are cut into ``radius + 1`` blocks, on one of which two linked
members agree. Members near it, a ball of near copies, agree on nearly all bits whichever
are taken; they are dealt out by the few bits in which they leave the centre, their flips.
Two of w and v flips within the radius share (w + v - radius) / 2 of them or more: one of
half the radius or less, of which there are few, is compared with all members, and others
meet under their two smallest shared flips. As fingerprints are distinct, this ends.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logintake.llm.components import components
from logintake.llm.tables import LOWER, bytes_of, documents, fresh, slices
from logintake.session import written

SHINGLE = 4
RADIUS = 4
SEED = 42
BLOCKS = 6
BUCKET_ROWS = 2048
# Choices of bits have numbers below this.
PATHS = 128
# Members with at most this many flips are near the centre of their bucket.
CORE = 10
BUCKET = ["path", "key", "flips", "part"]
# The flips of a bucket that is cut into pieces for want of a better way.
NO_FLIPS = -1

FULL = np.uint64(0xFFFF_FFFF_FFFF_FFFF)
# Words compared at a time, and shingles whose votes are counted at a time.
WORDS = 1 << 15
VOTES = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Majority of the hashes' bits of all shingles of words, repeats included. A text of
    fewer words is one shingle; one without words has fingerprint 0."""
    words = text.split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    width = min(shingle, len(words))
    begins = (ends - sizes)[: len(words) - width + 1].tolist()
    ends = ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(begins, ends)], "<u8")
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), VOTES):
        rows = hashes[lo : lo + VOTES].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << b for b in np.flatnonzero(2 * ones > len(hashes)).tolist())


def with_fingerprints(docs: DataFrame, text: str, out: str, shingle: int = SHINGLE) -> DataFrame:
    """The rows with the fingerprint of a text column as a long (its 64 bits)."""
    from pyspark.sql.types import LongType, StructType

    schema = StructType([*docs.schema.fields]).add(out, LongType())

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            data, starts = bytes_of(batch.column(text))
            data = LOWER[data].tobytes()
            values = [
                fingerprint(data[a:b], shingle) for a, b in zip(starts.tolist(), starts[1:].tolist())
            ]
            column = pa.array(np.array(values, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, out])

    return docs.mapInArrow(run, schema)


def _cut(bits: list[int], parts: int) -> list[list[int]]:
    """The bits in parts of nearly equal size."""
    return [part.tolist() for part in np.array_split(np.array(bits, np.int64), parts) if len(part)]


def _signed(bits: list[int]) -> int:
    """A long with these bits set."""
    mask = sum(1 << b for b in bits)
    return mask - (1 << 64) if mask >> 63 else mask


def _keyed(rows: DataFrame, choices: list[tuple[int, int, list[int]]]) -> DataFrame:
    """A row per choice of bits for each row of its ``path``: the bucket is the choice's
    own path and the fingerprint's bits at these places. Choices are (path, own path, bits);
    there are as many as the choices of bits made so far, whatever the number of rows."""
    spark = rows.sparkSession
    table = spark.createDataFrame(
        [(path, own, _signed(bits)) for path, own, bits in choices], "path long, own long, mask long"
    )
    joined = rows.select("path", "fp", "size").join(F.broadcast(table), "path")
    return joined.select(
        F.col("own").alias("path"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp",
        F.col("size").alias("was"),
    )


def _pieces(rows: DataFrame, bucket_rows: int) -> DataFrame:
    """Buckets cut into pieces of about ``bucket_rows`` rows, and a bucket of its own, with
    a ``part``, for each two pieces."""
    n = F.ceil(F.col("size") / bucket_rows)
    piece = F.pmod(F.xxhash64("fp"), n)
    rows = rows.select("path", "key", "fp", n.alias("n"), piece.alias("piece"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    part = F.least("piece", "other") * F.col("n") + F.greatest("piece", "other") + 1
    return rows.select("path", "key", F.lit(NO_FLIPS).cast("long").alias("flips"), part.alias("part"), "fp")


def _centres(rows: DataFrame) -> DataFrame:
    """``path, key, centre``: the majority of each bit over the members of a bucket."""
    ones = [F.sum(F.shiftrightunsigned("fp", b).bitwiseAND(F.lit(1))).alias(f"b{b}") for b in range(64)]
    votes = rows.groupBy("path", "key").agg(F.count(F.lit(1)).alias("n"), *ones)
    bits = [F.when(2 * F.col(f"b{b}") > F.col("n"), F.lit(_signed([b]))).otherwise(F.lit(0)) for b in range(64)]
    # In two steps: an expression of 64 terms in a row is long for the optimizer.
    eighths = [f"e{i}" for i in range(8)]
    halves = {
        name: functools.reduce(lambda x, y: x.bitwiseOR(y), bits[8 * i : 8 * i + 8])
        for i, name in enumerate(eighths)
    }
    centre = functools.reduce(lambda x, y: x.bitwiseOR(y), map(F.col, eighths))
    return votes.withColumns(halves).select("path", "key", centre.alias("centre"))


def _half(radius: int) -> int:
    """Of two members that share too few flips, one has at most this many."""
    return -(-radius // 2)


def shared_flips(away: np.ndarray, flips: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and the flips they are dealt out by; ``away`` are the flips of each member,
    ``flips`` those that all members of its bucket share.

    Two members that are linked, both with more further flips than half the radius, share
    two of them (one, if both have one more than half of an even radius). They meet under
    the smallest that they share. These are larger than all of ``flips``, as those are the
    smallest of all, and lie among the first of each, as many as may be left out.
    """
    half = _half(radius)
    weight = np.bitwise_count(away & ~flips).astype(np.int64)
    top = flips.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        top |= top >> np.uint64(shift)
    later = away & ~top
    need = -((radius - weight - np.maximum(half + 1, weight - radius)) // 2)
    usable = np.bitwise_count(later).astype(np.int64) - need + 2
    rows = np.flatnonzero((weight > half) & (later != 0))
    later, first = later[rows], []
    while len(first) < radius + 2 and later.any():
        bit = later & (~later + np.uint64(1))
        first.append(bit)
        later = later ^ bit
    if radius % 2 == 0:
        single = weight[rows] == half + 1
        for bit in first:
            some = single & (bit != 0)
            yield rows[some], flips[rows[some]] | bit[some]
    for j in range(1, len(first)):
        some = (first[j] != 0) & (j < usable[rows])
        for i in range(j):
            yield rows[some], flips[rows[some]] | first[i][some] | first[j][some]


def _balls(rows: DataFrame, radius: int, bucket_rows: int) -> DataFrame:
    """Buckets for the members ``path, key, fp, away`` near the centre of theirs, ``away``
    being the bits in which they leave it.

    A level deals out the buckets above the bound by two more flips; what is left for a
    member shrinks by two, so levels are few. Each member is in one piece of its bucket,
    and those with few flips left, whose number has a bound, are in all pieces.
    """
    bucket = ["path", "key", "flips"]

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            away = batch.column("away").to_numpy().view(np.uint64)
            flips = batch.column("flips").to_numpy().view(np.uint64)
            for some, mask in shared_flips(away, flips, radius):
                if len(some):
                    taken = batch.take(pa.array(some))
                    yield taken.set_column(2, "flips", pa.array(mask.view(np.int64)))

    rows = rows.select("path", "key", F.lit(0).cast("long").alias("flips"), "fp", "away")
    out = None
    while True:
        sizes = rows.groupBy(*bucket).agg(F.count(F.lit(1)).alias("size"))
        large = written(sizes.filter(F.col("size") > bucket_rows))
        whole = rows.join(large, bucket, "left_anti").select(*bucket, F.lit(0).cast("long").alias("part"), "fp")
        out = whole if out is None else out.unionByName(whole)
        if large.isEmpty():
            return out
        members = written(rows.join(large, bucket))
        n = F.ceil(F.col("size") / bucket_rows)
        few = F.bit_count(F.col("away").bitwiseAND(F.bitwise_not("flips"))) <= _half(radius)
        pieces = F.when(few, F.sequence(F.lit(1).cast("long"), n)).otherwise(
            F.array(F.pmod(F.xxhash64("fp"), n) + 1)
        )
        out = out.unionByName(members.select(*bucket, F.explode(pieces).alias("part"), "fp"))
        rows = members.select(*bucket, "fp", "away")
        rows = written(rows.mapInArrow(deal, rows.schema))


def _dealt(fps: DataFrame, radius: int, blocks: int, bucket_rows: int) -> DataFrame:
    """``path, key, flips, part, fp``: every two fingerprints within the radius share a
    bucket, and a bucket has at most about twice ``bucket_rows`` rows."""
    parts = _cut(list(range(64)), blocks)
    choices = [sum(some, []) for some in itertools.combinations(parts, blocks - radius)]
    spent = {i + 1: bits for i, bits in enumerate(choices)}
    rows = _keyed(
        fps.select("fp", F.lit(0).cast("long").alias("path"), F.lit(None).cast("long").alias("size")),
        [(0, i, bits) for i, bits in spent.items()],
    )
    nothing = F.lit(0).cast("long")
    whole = ["path", "key", nothing.alias("flips"), nothing.alias("part"), "fp"]
    out = None
    while True:
        sizes = rows.groupBy("path", "key").agg(F.count(F.lit(1)).alias("size"), F.first("was").alias("was"))
        large = written(sizes.filter(F.col("size") > bucket_rows))
        # At most one path per choice made so far.
        paths = sorted(r[0] for r in large.select("path").distinct().collect())
        if not paths:
            done = rows.select(*whole)
            return done if out is None else out.unionByName(done)
        small = rows.join(large, ["path", "key"], "left_anti").select(*whole)
        out = small if out is None else out.unionByName(small)
        # Dealt out again by blocks only where the last time halved it; else cut into pieces.
        open_paths = [p for p in paths if 64 - len(spent[p]) > radius]
        shrank = (F.col("was").isNull() | (2 * F.col("size") <= F.col("was"))) & F.col("path").isin(open_paths)
        members = written(rows.drop("was").join(large.withColumn("again", shrank), ["path", "key"]))
        members = members.join(written(_centres(members)), ["path", "key"])
        members = written(members.withColumn("away", F.col("fp").bitwiseXOR(F.col("centre"))).drop("centre"))
        # Linked members differ by at most the radius in their distance from the centre,
        # so each two of them are both near it or both in the rest.
        flips = F.bit_count("away")
        out = out.unionByName(_balls(members.filter(flips <= CORE), radius, bucket_rows))
        far = members.filter(flips > CORE - radius)
        sizes = far.groupBy("path", "key").agg(F.count(F.lit(1)).alias("far"))
        far = written(far.join(sizes, ["path", "key"]).drop("away", "size").withColumnRenamed("far", "size"))
        out = out.unionByName(_pieces(far.filter("NOT again"), bucket_rows))
        finer, deeper = [], {}
        for path in open_paths:
            rest = [b for b in range(64) if b not in spent[path]]
            for i, bits in enumerate(_cut(rest, radius + 1)):
                own = path * PATHS + i + 1
                deeper[own] = spent[path] + bits
                finer.append((path, own, deeper[own]))
        if not finer:
            return out
        rows, spent = written(_keyed(far.filter("again"), finer)), deeper


def _planes(fps: np.ndarray) -> np.ndarray:
    """Bit planes: word w of plane b holds bit b of fingerprints 64 w to 64 w + 63."""
    padded = np.zeros(-(-len(fps) // 64) * 64, np.uint64)
    padded[: len(fps)] = fps
    return np.stack([
        np.packbits(((padded >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), bitorder="little").view("<u8")
        for b in range(64)
    ])


def _ones(n: np.ndarray) -> np.ndarray:
    """Words whose lowest n bits are set, n from 0 to 64."""
    n = n.astype(np.uint64)
    return np.where(n >= 64, FULL, (np.uint64(1) << np.minimum(n, np.uint64(63))) - np.uint64(1))


def within(fps: np.ndarray, ends: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j), i before j, of fingerprints of one bucket that differ in at most
    ``radius`` bits. Buckets are stretches; ``ends`` is each row's end of its bucket."""
    planes = _planes(fps)
    place = np.arange(len(fps))
    counters = max(1, radius.bit_length())
    for lo in range(0, len(fps), WORDS):
        rows = place[lo : lo + WORDS]
        words = (ends[rows] - 1) // 64 - rows // 64 + 1
        query = np.repeat(rows, words)
        word = query // 64 + np.arange(len(query)) - np.repeat(np.cumsum(words) - words, words)
        for at in range(0, len(query), WORDS):
            q, w = query[at : at + WORDS], word[at : at + WORDS]
            lanes = _ones(np.clip(ends[q] - 64 * w, 0, 64)) & ~_ones(np.clip(q + 1 - 64 * w, 0, 64))
            far = ~lanes
            count = [np.zeros(len(q), np.uint64) for _ in range(counters)]
            for b in range(64):
                carry = planes[b][w] ^ (np.uint64(0) - ((fps[q] >> np.uint64(b)) & np.uint64(1)))
                for c in count:
                    held = c & carry
                    c ^= carry
                    carry = held
                far |= carry
                if b % 4 == 3:
                    far |= _above(count, radius)
                    alive = far != FULL
                    if not alive.all():
                        q, w, far = q[alive], w[alive], far[alive]
                        count = [c[alive] for c in count]
                    if not len(q):
                        break
            if len(q):
                near = np.unpackbits((~far).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                k, lane = np.nonzero(near)
                yield q[k], 64 * w[k] + lane


def _above(count: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counter, in bit planes from the lowest, is above the radius."""
    above = np.zeros_like(count[0])
    equal = np.full_like(count[0], FULL)
    for b in reversed(range(len(count))):
        if radius >> b & 1:
            equal &= count[b]
        else:
            above |= equal & count[b]
            equal &= ~count[b]
    return above


def _joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Labels after the pairs (i, j) have been joined; a label is the smallest place."""
    while True:
        while (label != label[label]).any():
            label = label[label]
        a, b = label[i], label[j]
        if (a == b).all():
            return label
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)


def _links(rows: DataFrame, radius: int) -> DataFrame:
    """Edges ``a, b`` that join the linked members of each bucket: fewer than members."""

    def edges(fps: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
        sizes = np.diff(np.append(starts, len(fps)))
        many = np.repeat(sizes > 1, sizes)
        ends = np.cumsum(sizes[sizes > 1])
        fps, ends = fps[many], np.repeat(ends, sizes[sizes > 1])
        label = np.arange(len(fps))
        for i, j in within(fps.view(np.uint64), ends, radius):
            label = _joined(label, i, j)
        child = np.flatnonzero(label != np.arange(len(fps)))
        return pa.RecordBatch.from_arrays(
            [pa.array(fps[child]), pa.array(fps[label[child]])], ["a", "b"]
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            # The last bucket may go on in the next batch.
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            starts = _starts(held)
            if len(starts) > 1 and len(held) >= 1 << 14:
                cut = int(starts[-1])
                yield edges(held["fp"][:cut].to_numpy(), starts[:-1])
                held = held.slice(cut).combine_chunks()
        if held is not None and len(held):
            yield edges(held["fp"].to_numpy(), _starts(held))

    dealt = rows.repartition(*BUCKET).sortWithinPartitions(*BUCKET, "fp")
    return dealt.select(*BUCKET, "fp").mapInArrow(run, "a long, b long")


def _starts(table: pa.Table) -> np.ndarray:
    """Rows at which a bucket begins."""
    new = np.ones(len(table), bool)
    new[1:] = False
    for name in BUCKET:
        column = table[name].to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def fingerprint_roots(
    fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """``fp, root`` for the distinct fingerprints ``fp``; linked ones share a root."""
    links = written(_links(_dealt(fps, radius, blocks, bucket_rows), radius).distinct())
    roots = components(links)
    return fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    blocks: int = BLOCKS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row per document: ``doc_id, fingerprint`` (16 hex digits) and ``component_id``,
    the smallest ``doc_id`` that links reach, its own included.

    A null or empty text, or one without words, has fingerprint 0 and is linked like any
    other. A null id does not count as smallest; in a component of null ids alone the
    component's id is null. Repeated rows stay rows. No rows give no rows.
    """
    rows = documents(docs, id_col, text_col)
    known = written(with_fingerprints(rows, "text", "fp", shingle).select("doc_id", "fp"))
    nodes = written(known.groupBy("fp").agg(F.min("doc_id").alias("first")))
    roots = written(fingerprint_roots(nodes.select("fp"), radius, blocks, bucket_rows).join(nodes, "fp"))
    least = written(roots.groupBy("root").agg(F.min("first").alias("component_id")))
    labels = written(roots.join(least, "root").select("fp", "component_id"))
    return known.join(labels, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    blocks: int = BLOCKS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """The rows of ``docs``, all columns, with one of each component: the one with the
    smallest id. A null id comes last, and of rows with the same id one stays."""
    row, fp, text = fresh(docs, "row", "fp", "whole")
    kept = docs.withColumns({
        row: F.monotonically_increasing_id(),
        text: F.coalesce(F.col(text_col).cast("string"), F.lit("")),
    })
    kept = written(with_fingerprints(kept, text, fp, shingle).drop(text))
    rows = kept.select(F.col(id_col).alias("doc_id"), F.col(row).alias("row"), F.col(fp).alias("fp"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    nodes = written(rows.groupBy("fp").agg(first))
    roots = fingerprint_roots(nodes.select("fp"), radius, blocks, bucket_rows).join(nodes, "fp")
    stay = roots.groupBy("root").agg(F.min("first").alias("first"))
    stay = written(stay.select(F.col("first.row").alias(row)))
    # A merge at every size: what stays grows with the documents.
    return kept.join(stay.hint("merge"), row, "left_semi").drop(row, fp)
