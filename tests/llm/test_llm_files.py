"""Token files, packing and archives: exact round trips."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from logintake.llm import tokens
from logintake.llm.packing import differencing, pack, windows_of
from logintake.llm.planes import IdFile, from_planes, read_ids, to_planes, write_ids
from logintake.llm.tables import filesystem, words_of
from logintake.llm.warc import find_captures, look_up, url_key, write_archives, write_index
from logintake.session import shared_folder

BYTES, WORDS = (public_tokenizers.path(f"{n}.json") for n in ("byte_bpe_50k", "word_bpe_49k"))
SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"
PIECES = [
    " ", "  ", "\n", "\t", "\r\n", "\x85", "\xa0", " ", "　", " ", "\x1c", "a", "Ab", "it's", "don't",
    "'s", "1", "23", ".", ",,", "é", "é", "́", "Σ", "ΑΣ", "İ", "ﬁ", "日本", "👍🏽", "​", "﻿",
    "<|endoftext|>", "</w>", "<|startoftext|>", "\x00", "<|endof", "text|>", "é<|endoftext|>.", "(", "a.b,c",
]


def odd_texts(n: int = 400) -> list[str | None]:
    draw = random.Random(5)
    some = ["".join(draw.choice(PIECES) for _ in range(draw.randint(0, 12))) for _ in range(n)]
    return [None, "", *PIECES, *some, "word " * 3000, "x" * 5000]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_ids_are_those_of_the_whole_text(path):
    texts = odd_texts()
    for kind in (pa.string(), pa.large_string()):
        ids, starts = tokens.encode(pa.array(texts, kind).slice(1), path, 7)
        for i, text in enumerate(texts[1:]):
            assert ids[starts[i] : starts[i + 1]].tolist() == brute.encoded(text, path, 7), repr(text)


def test_words():
    texts = [None, "", " a  B\ta", "é x\n", "--", "a-b - c"]
    for dropped in (None, np.isin(np.arange(256), [45])):
        words, codes, starts = words_of(pa.array(texts), dropped=dropped)
        for i, text in enumerate(texts):
            plain = (text or "").lower().replace("-", "-" if dropped is None else "").split()
            assert [words[c].as_py().decode() for c in codes[starts[i] : starts[i + 1]]] == plain


@pytest.mark.parametrize("kind", ["bit", "byte"])
@pytest.mark.parametrize("ids", [[], [0], [0] * 9, [1, 2**32 - 1, 5], list(range(1000))])
def test_planes(kind, ids):
    ids = np.array(ids, np.uint32)
    assert (from_planes(to_planes(ids, kind), len(ids), kind) == ids).all()


@pytest.mark.parametrize("kind", ["bit", "byte"])
def test_id_files(spark, kind):
    texts = odd_texts(60)
    rows = [(i * 7 % 211, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5).withColumns({"row": F.lit(0), "file": F.lit("f")})
    folder = shared_folder(spark)
    manifest = write_ids(docs, folder, BYTES, 0, chunk_ids=100, kind=kind)
    got = sorted(map(tuple, read_ids(spark, folder, digest=True).select("doc_id", "start", "n_tokens", "ids_crc32").collect()))
    assert got == brute.digests(rows, BYTES)
    whole = {r.doc_id: (r.start, r.ids) for r in read_ids(spark, folder).collect()}
    assert all(whole[i][1] == brute.encoded(t, BYTES, 0) for i, t in rows)
    # Any stretch, by the chunk index.
    file = manifest.orderBy(F.desc("n_ids")).first()
    every = [i for _, ids in sorted(whole.values()) for i in ids]
    fs, base = filesystem(folder)
    before = sum(r.n_ids for r in manifest.filter(F.col("part") < file.part).collect())
    with fs.open_input_file(f"{base}/{file.file}") as source:
        for a, b in ((0, 0), (0, 1), (99, 101), (150, 420), (file.n_ids - 3, file.n_ids)):
            assert IdFile(source).stretch(a, b).tolist() == every[before + a : before + b]


def test_id_files_of_ties_nulls_and_no_rows(spark):
    rows = [(None, "b"), (2, "x"), (None, "a"), (2, "x"), (1, None)]
    folder = shared_folder(spark)
    write_ids(spark.createDataFrame(rows, DOCS), folder, BYTES)
    got = sorted(read_ids(spark, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [1, 2, 2, None, None]
    assert [r.start for r in got] == [sum(x.n_tokens for x in got[:i]) for i in range(5)]
    folder = shared_folder(spark)
    write_ids(spark.createDataFrame([], DOCS), folder, BYTES)
    assert read_ids(spark, folder, digest=True).count() == 0


def test_differencing():
    draw = random.Random(6)
    for windows in (1, 2, 7):
        sizes = [draw.randint(1, 500) for _ in range(60)]
        placed, sums = differencing(sizes, windows)
        held = [0] * windows
        for size, window in zip(sizes, placed.tolist()):
            held[window] += size
        assert sorted(held) == sorted(sums.tolist())
        assert max(held) - min(held) < 60
    # By hand: 8 and 7 are set against each other, then 6 and 5, then 4; the result is 16 and 14.
    assert sorted(differencing([8, 7, 6, 5, 4], 2)[1].tolist()) == [14, 16]
    # Three pieces of 60 do not fit into two windows of 100: there are three.
    assert sorted(windows_of([60, 60, 60], 100, 2).tolist()) == [0, 1, 2]


@pytest.mark.parametrize("capacity", [64, 4096])
def test_packing(spark, capacity):
    texts = odd_texts(120)
    rows = list(enumerate(texts)) + [(None, "a b"), (None, None)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3).withColumn("ids", F.lit(1))
    got = pack(docs, WORDS, 2, capacity=capacity, windows=4, piece=capacity // 4, slack=capacity // 32).collect()
    pieces, sequences = {}, {}
    for r in got:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for i, text in rows[:-2]:
        want, at = brute.encoded(text, WORDS, 2), 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.length) == (at, len(want), len(r.ids))
            assert r.ids == want[at : at + r.length] and r.ids_crc32 == brute.crc(r.ids)
            at += r.length
        assert at == len(want)
    assert sorted(r.length for r in pieces[None]) == [1, 3]
    used = 0
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= capacity
        used += at
    # Three tasks; each may leave room in its last group.
    assert len(sequences) * capacity <= used * 1.2 + 6 * capacity


def test_packing_no_rows(spark):
    assert pack(spark.createDataFrame([], DOCS), WORDS).count() == 0


PAGES = "page_id long, url string, html string"
ODD_PAGES = [
    (1, "http://A.example.org:80/x?q=1", "one"), (2, "https://u@a.example.org/x?q=1", "one"), (3, None, "one"),
    (4, "http://b.org", ""), (5, "b.org/", None), (6, "http://c.net/ü\r\nX: y", "é"), (7, "http://c.net/" + "p" * 600, "é" * 9),
    (None, "http://d.org/", "null id"), (8, "", "x\r\n\r\ny"), (9, "http://a.example.org/x?q=1", "two"), (10, "http://b.org", "big " * 50_000),
    (10, "http://b.org", "big " * 50_000),
]


def test_url_key(spark):
    rows = [("http://A.Example.org:80/X?q#f",), ("https://me@b.org",), ("b.org?x",), ("",), (None,), ("http://c.net/a b",)]
    got = [r[0] for r in spark.createDataFrame(rows, "url string").select(url_key(F.col("url"))).collect()]
    assert got == ["org,example,a)/X?q#f", "org,b)/", "org,b)?x", ")/", "", "net,c)/a b"]


@pytest.mark.parametrize("least", [0, 3, 100])
def test_archives(spark, least):
    pages = spark.createDataFrame(ODD_PAGES, PAGES).repartition(4).withColumns({"key": F.lit("k"), "sha1": F.lit(0), "file": F.lit(0)})
    folder = shared_folder(spark)
    captures = write_archives(pages, folder, least_bytes=least)
    write_index(captures, folder, block_lines=2)
    got = look_up(spark, folder, pages)
    want = sorted(brute.captures(ODD_PAGES, least), key=repr)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.select(*names).collect()), key=repr) == want
    assert {(r.page_id, r.url) for r in got.collect()} == {(i, u) for i, u, _ in ODD_PAGES}


def test_look_up(spark):
    """Every key is found in all its captures, over blocks and parts; others are not."""
    rows = [(i, f"http://h{i % 7}.example.org/{'hot' if i % 3 else i}", f"page {i}") for i in range(300)]
    pages, folder = spark.createDataFrame(rows, PAGES).repartition(6), shared_folder(spark)
    write_index(write_archives(pages, folder), folder, block_lines=3)
    for url in (rows[1][1], rows[3][1], rows[299][1]):
        one = spark.createDataFrame([(url,), (url,), ("http://none.org/",), ("zzz",), (None,)], "url string")
        assert sorted(r.page_id for r in look_up(spark, folder, one).collect()) == [r[0] for r in rows if r[1] == url]
    every = find_captures(spark, folder, pages.select(url_key(F.col("url")).alias("key")))
    assert sorted(r.page_id for r in every.collect()) == list(range(300))


def test_archives_no_rows(spark):
    pages, folder = spark.createDataFrame([], PAGES), shared_folder(spark)
    write_index(write_archives(pages, folder), folder)
    assert look_up(spark, folder, pages).count() == 0
    assert look_up(spark, folder, spark.createDataFrame([("http://a.org/",)], "url string")).count() == 0
