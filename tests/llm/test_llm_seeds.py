"""Benchmark items of every length, also of a few words."""

import random
from itertools import combinations

import pytest

import brute
from compare import connect, differences
from logintake.llm.oracle import ORACLE
from logintake.llm.queries import QUERIES
from logintake.llm.seeds import SIMILARITY, WINDOW, agreeing, decontaminate, leaks, masks_for

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def overlaps(docs: list[tuple], items: list[tuple], window: int = WINDOW, share: float = SIMILARITY) -> dict[tuple, int]:
    """The most agreeing words of each overlap, over all alignments and windows."""
    found = {}
    for d, text in docs:
        words = brute.plain_words(text)
        for i, item in items:
            other = brute.plain_words(item)
            size = min(window, len(other))
            for shift in range(-len(words), len(other) + 1) if size else ():
                same = [0 <= k - shift < len(words) and words[k - shift] == w for k, w in enumerate(other)]
                most = max(sum(same[lo : lo + size]) for lo in range(len(other) - size + 1))
                if most >= share * size - 1e-9:
                    found[d, i] = max(most, found.get((d, i), 0))
    return found


@pytest.mark.parametrize("similarity", [SIMILARITY, 0.5, 1.0])
def test_every_allowed_substitution_leaves_a_seed(similarity):
    for size in range(1, WINDOW + 1):
        masks = [{k for k, c in enumerate(m) if c == "1"} for m in masks_for(size, similarity)]
        for off in combinations(range(size), size - agreeing(size, similarity)):
            left = set(range(size)) - set(off)
            assert any({p + k for k in on} <= left for on in masks for p in range(size - max(on))), (size, off)


def tables() -> tuple[list[tuple], list[tuple]]:
    """Items of 0 to 16 words, and documents with each allowed substitution, and one more."""
    draw = random.Random(31)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(5))
    some = lambda: [word() for _ in range(draw.randint(0, 9))]
    items = [(n, " ".join(word() for _ in range(n))) for n in range(17)] + [(90, None), (91, "the"), (92, "of the")]
    docs = []
    for n, item in items[1:17]:
        size = min(n, WINDOW)
        differ = size - agreeing(size, SIMILARITY)
        for off in [*combinations(range(size), differ), *draw.sample([*combinations(range(size), differ + 1)], min(size, 4))]:
            passage = [word() if k in off else w for k, w in enumerate(item.split())]
            docs.append((len(docs), draw.choice([" ", "\n", " - "]).join(some() + passage + some())))
        # At the edge of the text, without its first or last word.
        docs += [(len(docs), " ".join(item.split()[1:])), (len(docs) + 1, " ".join(some() + item.upper().split()[:-1]))]
    return docs + [(5000, None), (5001, ""), (5002, "The, of the of: the " * 700), (None, "the"), (5003, "of")], items


def test_items_of_all_lengths(spark):
    docs, items = tables()
    table = spark.createDataFrame(docs, DOCS).repartition(4)
    benchmark = spark.createDataFrame(items, ITEMS)
    got = {(r.doc_id, r.item_id): r.matches for r in leaks(table, benchmark).collect()}
    want = overlaps(docs, items)
    assert {i for _, i in want} == {n for n in range(1, 17)} | {91, 92}
    assert got == want
    dirty = {d for d, _ in want}
    assert sorted(r.doc_id for r in decontaminate(table, benchmark).collect()) == sorted(d for d, _ in docs if d not in dirty)


def test_short_window(spark):
    docs, items = tables()
    got = leaks(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), window=6, similarity=0.6)
    assert {(r.doc_id, r.item_id): r.matches for r in got.collect()} == overlaps(docs, items, 6, 0.6)


def test_short_items_against_sql(spark, tmp_path):
    docs, items = tables()
    spark.createDataFrame([d for d in docs if d[0] is not None], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, ITEMS).write.parquet(str(tmp_path / "benchmark.parquet"))
    name, found = "op7_spaced_seeds", connect(str(tmp_path))
    assert differences(QUERIES[name](spark, str(tmp_path)), found, ORACLE[name]) == []
