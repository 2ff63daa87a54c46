"""Repeated stretches of lines against a comparison of all pairs of lines."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from logintake.llm.lines import Chunks, Runs, _digests, drop_repeated_chunks
from logintake.llm.queries import QUERIES

DOCS = "doc_id long, text string"
SF_DIR = "/root/testdata/sf0.001"


def planted(n: int = 60) -> list[tuple]:
    """Passages of 2 to 8 short lines, each in two documents between differing neighbours."""
    draw = random.Random(21)
    line = lambda k: " ".join("".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(k))
    rows = []
    for i in range(n):
        size = 2 + i % 7
        passage = [line(-(-60 // size)) for _ in range(size)]
        for copy in (0, 1):
            own = [line(draw.randint(1, 12)) for _ in range(draw.randint(2, 9))]
            at = draw.randint(1, len(own) - 1)
            rows.append((i + 1000 * copy, "\n".join(own[:at] + passage + own[at:]), "\n".join(own)))
    return rows


def test_planted_passages(spark):
    rows = planted()
    got = {r.doc_id: r for r in drop_repeated_chunks(spark.createDataFrame([r[:2] for r in rows], DOCS), counts=True).collect()}
    for i, text, own in rows:
        assert got[i].text == (own if i >= 1000 else text)
        assert got[i].removed_lines == text.count("\n") - got[i].text.count("\n")


def test_fewer_words_stay(spark):
    half = "\n".join(["a b c d e f g"] + ["h i j k l m n"] + ["o p q r s t u"])
    rows = [(1, f"one\n{half}\ntwo"), (2, f"three\n{half}\nfour")]
    assert brute.repeated_lines(rows) == {} and brute.repeated_lines(rows, 21)[rows[1]] == {1, 2, 3}
    got = drop_repeated_chunks(spark.createDataFrame(rows, DOCS), passage=21).collect()
    assert {r.doc_id: r.text for r in got} == {1: rows[0][1], 2: "three\nfour"}


def odd_corpus() -> list[tuple]:
    draw = random.Random(22)
    line = lambda: draw.choice(["", " ", *(f"{w} " * draw.randint(1, 30) for w in "abcdef")])
    pool = [line() for _ in range(12)]
    rows = [(i, "\n".join(draw.choice(pool) for _ in range(draw.randint(0, 14)))) for i in range(80)]
    return rows + [
        (100, None), (101, ""), (102, "\n\n"), (103, "x " * 60), (None, "x " * 60), (104, "\n".join(["y y y"] * 100)),
        (105, "\n".join(["y y y"] * 40)), (106, "\n\n" + "\n\n".join("p q r s t u".split() * 12) + "\n\n"),
        (107, "é " * 30 + "\nü\r\n" + "é " * 30), (108, "ende\n" + "é " * 30 + "\nü\r\n" + "é " * 30 + "\n"),
    ]


@pytest.mark.parametrize("weak", [False, True])
def test_odd_stretches(spark, weak):
    """Lines without words, lines in a row, nulls, and hashes that collide at first."""
    def colliding(contents, seed):
        return _digests(contents, seed) if seed or not weak else (np.zeros(len(contents), np.int64),) * 2

    rows = odd_corpus()
    docs = spark.createDataFrame(rows + rows[:9], DOCS).repartition(5)
    got = drop_repeated_chunks(docs, digests=colliding).collect()
    want = brute.without_stretches(rows)
    assert len(got) == len(rows) + 9
    assert {r.doc_id: r.text for r in got} == {d[0]: None if d[1] is None else t for d, t in want.items()}


def test_run_hashes():
    """Equal runs have equal hashes wherever they stand, and others differ."""
    texts = ["a\nb\nc\nd", "x\na\nb\nc", "a\na\na", "b\nc"]
    chunks = Chunks(pa.array(texts))
    runs, lines, seen = Runs(chunks, 0, _digests), "\n".join(texts).split("\n"), defaultdict(set)
    for head in range(len(lines)):
        for stop in range(head + 1, len(lines) + 1):
            h1, h2 = runs.hashes(np.array([head]), np.array([stop]))
            seen[int(h1[0]), int(h2[0]), runs.sequences(np.array([head]), np.array([stop]))[0]].add(tuple(lines[head:stop]))
    assert all(len(s) == 1 for s in seen.values()) and len(seen) == len({k[0] for k in seen}) == len({k[1] for k in seen})


def test_op4_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    want = brute.without_stretches(docs)
    got = QUERIES["op4_line_chunks"](spark, SF_DIR)
    assert {r.doc_id: r.text for r in got.collect()} == {d[0]: t for d, t in want.items()}
    assert got.agg(F.sum("removed_lines")).first()[0] > 0
