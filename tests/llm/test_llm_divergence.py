"""Source divergence against plain counts."""

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logintake.llm import divergence
from logintake.llm.divergence import blocks_of, build_runs, merged, pair_corrections, postings, source_divergence
from logintake.session import shared_folder

SCHEMA = "text string, lang string, source string"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text: str | None) -> list[str]:
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(rows: list[tuple], least: int = 30, top: int = 50) -> set[tuple]:
    rows = [(t or "", lang or "", source or "") for t, lang, source in rows]
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = terms(text)
        counts[lang, source].update(found)
        docs[lang].update(set(found))
    out = set()
    for lang in {r[1] for r in rows}:
        kept = {t for t, n in docs[lang].items() if n >= least}
        groups = {s: counts[lang, s] for _, s in {(r[1], r[2]) for r in rows if r[1] == lang}}

        def shares(of: Counter) -> dict:
            total = sum(of[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (of[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q = shares(sum(groups.values(), Counter()))
        p = {s: shares(c) for s, c in groups.items()}
        for s in groups:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in groups if o != s]
            words = [(t, p[s][t] - q[t]) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", words, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, value, n + 1) for n, (item, value) in enumerate(items[:most])}
    return out


def corpus(n: int = 900, seed: int = 1) -> list[tuple]:
    """Half of the rows in one source, languages with one source or no kept term, nulls."""
    draw = random.Random(seed)
    words = [f"{a}{b}{'x' * (a == 'q')}" for a in "abqé日Z" for b in ["", "a", "É", "ß", "ok"]]
    rows = []
    for i in range(n):
        lang = draw.choice(["en", "en", "de", None])
        source = "big" if draw.random() < 0.5 else f"s{draw.randint(0, 6)}"
        k = draw.randint(0, 25)
        text = "".join(draw.choice(words[: draw.randint(1, len(words))]) + draw.choice([" ", ",", "1", "\n", "_", "`"]) for _ in range(k))
        rows.append((text, lang, source))
    rows += [("only one source here " * 3, "one", "s")] * 40 + [("rare", "few", f"s{i}") for i in range(4)]
    return rows + [(None, "en", "empty"), ("", "en", None), ("aa " * 20_000, "en", "long"), (None, None, None)] * 2


def result(spark, rows, **options) -> set[tuple]:
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6).withColumns({c: F.lit(0) for c in ("term", "item", "n", "rank")})
    got = [tuple(r) for r in source_divergence(docs, **options).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_against_plain_counts(spark):
    rows = corpus()
    assert result(spark, rows) == plain(rows)


def test_many_runs(spark):
    """Runs of a few postings, merged two at a time in several rounds, and small blocks."""
    rows = corpus(300, 2)
    assert result(spark, rows, least_docs=5, top=3, shards=3, block_bytes=2000, fan_in=2) == plain(rows, 5, 3)


def test_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert source_divergence(docs).collect() == []
    assert result(spark, [(None, None, None)]) == set()


def test_tiles(spark, monkeypatch):
    """Sums of pairs in squares smaller than the number of sources, given on early."""
    monkeypatch.setattr(divergence, "TILE", 3)
    monkeypatch.setattr(divergence, "SQUARES", 2)
    draw, rows, want = random.Random(9), [], Counter()
    for _ in range(60):
        entries = [(f"s{i}", draw.randint(5, 99), draw.randint(1, 9)) for i in draw.sample(range(11), draw.randint(2, 9))]
        lang = draw.choice("xy")
        rows.append((lang, entries))
        for i, (s, p, b) in enumerate(entries):
            for t, r, c in entries[:i]:
                want[lang, *sorted((s, t))] += abs(p - r) - abs(p - c) - abs(b - r) + abs(b - c)
    df = spark.createDataFrame(rows, "lang string, entries array<struct<source string, p long, b long>>").repartition(3)
    got = Counter()
    for r in pair_corrections(df).collect():
        got[r.lang, *sorted((r.a, r.b))] += r.value
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_runs_are_sorted_and_whole(spark, monkeypatch):
    rows = corpus(200, 3)
    docs = spark.createDataFrame([(t or "", a or "", s or "") for t, a, s in rows], SCHEMA).repartition(8)
    folder = shared_folder(spark)
    segments = build_runs(docs, folder, 4, 3000).collect()
    assert len({s.file for s in segments}) > 6
    total = Counter()
    for shard in range(4):
        streams = [blocks_of(folder, s.file, s.first, s.stop) for s in segments if s.shard == shard]
        tables = list(merged(streams))
        keys = [k for t in tables for k in t["key"].to_pylist()]
        assert keys == sorted(keys)
        for t in tables:
            for r in t.to_pylist():
                total[r["lang"], r["term"], r["source"]] += r["count"]
    want = Counter((a or "", t, s or "") for text, a, s in rows for t in terms(text))
    assert total == want


@pytest.mark.parametrize("text", ["a`b@C[d", "É É é", "", "日本語,日本語", "x" * 5000])
def test_postings(text):
    batch = pa.record_batch({"lang": ["l", "l"], "source": ["s", "s"], "text": [text, "a"]})
    got = {r["term"]: (r["count"], r["docs"]) for r in postings(batch).to_pylist()}
    both = Counter(terms(text)) + Counter(["a"])
    assert got == {t: (n, (t in terms(text)) + (t == "a")) for t, n in both.items()}
