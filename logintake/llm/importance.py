"""Quality classifier by importance resampling (after Xie et al., 2023).

Two bag models over hashed n-grams (words, characters within words, and pairs of words):
the target, fitted on labelled good documents, and the raw text, fitted on all documents.
Gumbel noise is added to each document's log weight of target over raw, and the k
documents with the largest sums are drawn.

A few choices make the weight a classifier. The ratio of a bucket is the posterior mean
(target + a) / (expected + a) of a gamma prior, so rare n-grams say little. Only ratios
clearly below one count, else the common words of a long document outweigh whatever is
wrong in it. And the weight is the mean over words, in units of a temperature, so that
noise decides only near the cut. k is the number of documents whose weight is above the
cut that best splits labelled documents which the target has not seen.

Raw counts, weights, noise and the k-th key cover all documents. Only labels are sampled:
at most ``sample`` labelled ids are sent to the tasks, half for the target, half for the
cut. Models have a fixed number of buckets, and each task sends one row per bucket. The
noise of a document is a hash of its id and text, so a repeated task draws the same.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from logintake.llm.tables import fresh, slices, words_of
from logintake.session import written

BUCKETS = 1 << 17
CHARACTERS = 4
PRIOR = 1.0
CLEAR = -0.5
TEMPERATURE = 0.01
SAMPLE = 100_000
SEED = 42
BINS = 4096
MIX = np.uint64(0x9E3779B97F4A7C15)


class Grams:
    """Buckets of all n-grams of a column: words in the first part of the table, character
    n-grams in the second, pairs in the third."""

    def __init__(self, column: pa.Array, buckets: int) -> None:
        words, self.codes, starts = words_of(column)
        words, size = words.to_pylist(), np.uint64(buckets)
        digest = xxhash.xxh64_intdigest
        hashes = np.fromiter((digest(w, SEED) for w in words), np.uint64, len(words))
        self.n_docs, self.buckets = len(column), buckets
        self.sizes = np.diff(starts)
        self.doc = np.repeat(np.arange(len(column)), self.sizes)
        at, characters = _characters(words, buckets)
        # N-grams of a word are known once per distinct word.
        self.word = np.concatenate([np.arange(len(words)), at])
        self.word_bucket = np.concatenate([(hashes % size).astype(np.int64), characters + buckets])
        own = hashes[self.codes] if len(words) else hashes
        pairs = ((own[:-1] * MIX + own[1:]) * MIX) >> np.uint64(17)
        inside = self.doc[1:] == self.doc[:-1]
        self.pair = self.doc[1:][inside]
        self.pair_bucket = (pairs[inside] % size).astype(np.int64) + 2 * buckets

    def counts(self, chosen: np.ndarray | None = None) -> np.ndarray:
        """How often each bucket occurs, in the chosen documents."""
        codes, pairs = self.codes, self.pair_bucket
        if chosen is not None:
            codes, pairs = codes[chosen[self.doc]], pairs[chosen[self.pair]]
        times = np.bincount(codes, minlength=len(self.word))
        table = np.bincount(self.word_bucket, times[self.word], 3 * self.buckets)
        return table.astype(np.int64) + np.bincount(pairs, minlength=3 * self.buckets)

    def weights(self, ratio: np.ndarray) -> np.ndarray:
        """Mean over the words of a document; 0 for one without words."""
        own = np.bincount(self.word, ratio[self.word_bucket], len(self.word))
        total = np.bincount(self.doc, own[self.codes], self.n_docs)
        total += np.bincount(self.pair, ratio[self.pair_bucket], self.n_docs)
        return total / np.maximum(self.sizes, 1)


def _characters(words: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The word and the bucket of each n-gram of bytes, word ends included."""
    n = CHARACTERS
    flat = np.frombuffer(b" " + b" ".join(words) + b" " * n, np.uint8).astype(np.uint64)
    size = len(flat) - n + 1
    value, inside = np.zeros(size, np.uint64), np.ones(size, bool)
    for k in range(n):
        byte = flat[k : k + size]
        value = value * np.uint64(257) + byte
        if 0 < k < n - 1:
            inside &= byte != 32
    word = np.cumsum(flat == 32)[:size] - 1
    inside &= word < len(words)
    bucket = ((value * MIX) >> np.uint64(20)) % np.uint64(buckets)
    return word[inside], bucket[inside].astype(np.int64)


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log(target / raw) of each bucket where it is clearly negative, else 0."""
    out = np.zeros(len(raw))
    for part in np.split(np.arange(len(raw)), 3):
        expected = raw[part] * (target[part].sum() / max(1, raw[part].sum()))
        out[part] = np.log((target[part] + PRIOR) / (expected + PRIOR))
    return np.where(out < CLEAR, out, 0.0)


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def label_sample(labels: DataFrame, sample: int) -> DataFrame:
    """At most ``sample`` labelled ids, drawn by hash: ``label_id, good, fit``. An id with
    several labels is good if all of them are."""
    good = (F.col("quality").cast("int") == 1) & (F.col("toxic").cast("int") == 0)
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("label_id")
    ).agg(F.min(F.coalesce(good, F.lit(False))).alias("good"))
    draw = F.xxhash64(F.lit(SEED), "label_id")
    return written(
        known.withColumn("draw", draw).orderBy("draw", "label_id").limit(sample)
        .select("label_id", "good", (F.col("draw") % 2 == 0).alias("fit"))
    )


def fit(
    docs: DataFrame, sample: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    buckets: int = BUCKETS,
) -> np.ndarray:
    """The log ratio of each bucket. One row per bucket comes to the driver."""
    targets = sample.filter("good AND fit").select("label_id", F.lit(True).alias("target"))
    rows = docs.select(F.col(id_col).cast("long").alias("label_id"), _text(text_col).alias("text"))
    # At most ``sample`` rows, a parameter, are sent to the tasks.
    rows = rows.join(F.broadcast(targets), "label_id", "left").select("text", "target")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(3 * buckets, np.int64), np.zeros(3 * buckets, np.int64)
        for batch in slices(batches):
            grams = Grams(batch.column("text"), buckets)
            raw += grams.counts()
            chosen = batch.column("target").fill_null(False).to_numpy(zero_copy_only=False)
            if chosen.any():
                target += grams.counts(chosen)
        at = np.flatnonzero(raw)
        for lo in range(0, len(at), 1 << 16):
            some = at[lo : lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), pa.array(raw[some]), pa.array(target[some])],
                ["bucket", "raw", "target"],
            )

    sums = rows.mapInArrow(count, "bucket long, raw long, target long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")
    ).toArrow()
    raw, target = np.zeros(3 * buckets), np.zeros(3 * buckets)
    at = sums["bucket"].to_numpy()
    raw[at], target[at] = sums["raw"].to_numpy(), sums["target"].to_numpy()
    return log_ratio(target, raw)


def with_keys(
    docs: DataFrame, ratio: np.ndarray, id_col: str, text_col: str, weight: str, key: str
) -> DataFrame:
    """The rows with their weight and their weight plus noise."""
    text, number = fresh(docs, "whole", "number")
    rows = docs.withColumns({text: _text(text_col), number: F.col(id_col).cast("long")})
    schema = StructType([*docs.schema.fields]).add(weight, DoubleType()).add(key, DoubleType())
    digest = xxhash.xxh64_intdigest
    names, buckets = docs.columns, len(ratio) // 3

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            weights = Grams(batch.column(text), buckets).weights(ratio)
            ids = batch.column(number).to_pylist()
            texts = batch.column(text).cast(pa.large_binary()).to_pylist()
            draws = np.fromiter(
                (digest(f"{i}:".encode() + t, SEED) for i, t in zip(ids, texts)), np.float64, len(ids)
            )
            noise = -np.log(-np.log((draws + 0.5) / 2.0**64 * (1 - 1e-12) + 5e-13))
            own = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays(
                [*own, pa.array(weights), pa.array(weights / TEMPERATURE + noise)],
                [*names, weight, key],
            )

    return rows.mapInArrow(score, schema)


def best_cut(weights: np.ndarray, good: np.ndarray) -> float:
    """The cut between good documents above and others below with the fewest errors; of
    several the lowest. Without documents on one side there is no cut."""
    if good.all() or not good.any():
        return -np.inf
    order = np.argsort(weights, kind="stable")
    weights, good = weights[order], good[order]
    lost = np.concatenate(([0], np.cumsum(good)))
    kept = np.concatenate(([0], np.cumsum(~good)))
    errors = (lost + kept[-1] - kept).astype(float)
    errors[1:-1][weights[1:] == weights[:-1]] = np.inf
    at = int(np.argmin(errors))
    if at in (0, len(weights)):
        return -np.inf if at == 0 else np.inf
    return float((weights[at - 1] + weights[at]) / 2)


def kth_largest(rows: DataFrame, column: str, k: int) -> float:
    """The k-th largest value, by ever finer histograms of a fixed number of bins."""
    if k <= 0:
        return np.inf
    value = F.col(column)
    low, high = rows.agg(F.min(value), F.max(value)).first()
    if low is None:
        return -np.inf
    while low < high:
        place = F.least(F.lit(BINS - 1), F.floor((value - low) / (high - low) * BINS))
        bins = rows.filter(value.between(low, high)).groupBy(place.alias("bin")).agg(
            F.count(F.lit(1)).alias("n"), F.min(value).alias("low"), F.max(value).alias("high")
        )
        for _, n, low, high in sorted(bins.collect(), reverse=True):
            if k <= n:
                break
            k -= n
    return low


class Classifier:
    """A fitted model with the key that a document must reach.

    ``scores`` has the id, weight and key of every document. ``rows`` is the written table
    it is read from; with ``whole`` that holds all columns of ``docs``, so that the drawn
    rows need not be scored again.
    """

    def __init__(
        self, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        sample: int = SAMPLE, buckets: int = BUCKETS, whole: bool = False,
    ) -> None:
        labelled = label_sample(labels, sample)
        ratio = fit(docs, labelled, id_col, text_col, buckets)
        self.columns = [*docs.columns] if whole else [id_col]
        weight, key = fresh(docs, "weight", "key")
        rows = with_keys(docs if whole else docs.select(id_col, text_col), ratio, id_col, text_col, weight, key)
        self.rows = written(rows.select(*self.columns, weight, key))
        self.key = key
        self.scores = self.rows.select(
            F.col(id_col).cast("long").alias("doc_id"), F.col(weight).alias("log_weight"), F.col(key).alias("key")
        )
        held = labelled.filter("NOT fit").withColumnRenamed("label_id", "doc_id")
        judged = self.scores.join(F.broadcast(held), "doc_id").groupBy("doc_id").agg(
            F.min("log_weight"), F.min("good")
        ).toArrow()
        good = judged[2].to_numpy().astype(bool)
        self.cut = best_cut(judged[1].to_numpy(), good)
        self.k = self.scores.filter(F.col("log_weight") >= F.lit(self.cut)).count()
        self.least = kth_largest(self.scores, "key", self.k)

    def drawn(self) -> DataFrame:
        """The rows that are drawn."""
        return self.rows.filter(F.col(self.key) >= F.lit(self.least)).select(*self.columns)


def importance_sample(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    sample: int = SAMPLE, buckets: int = BUCKETS,
) -> DataFrame:
    """One row per document: ``doc_id, log_weight, key, kept``.

    ``labels`` has ``doc_id, quality, toxic``; good is quality 1 and toxic 0, and a null
    label is not good. Without labels all documents weigh 0 and are kept. A null or empty
    text weighs 0. Rows with the same id and text get the same key; all rows that tie with
    the k-th key are kept. Null ids are scored like others. No rows give no rows.
    """
    model = Classifier(docs, labels, id_col, text_col, sample, buckets)
    return model.scores.withColumn("kept", F.col("key") >= F.lit(model.least))


def keep_sample(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    sample: int = SAMPLE, buckets: int = BUCKETS,
) -> DataFrame:
    """The rows of ``docs`` that ``importance_sample`` keeps, with all their columns."""
    return Classifier(docs, labels, id_col, text_col, sample, buckets, whole=True).drawn()
