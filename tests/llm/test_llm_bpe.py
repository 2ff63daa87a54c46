"""The backtracking encoder against the tokenizers library."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from logintake.llm import backtrack
from logintake.llm.backtrack import encode_texts, encoder
from logintake.llm.queries import QUERIES
from test_llm_files import BYTES, DOCS, SF_DIR, WORDS, odd_texts

LIBRARY = {path: Tokenizer.from_file(path) for path in (BYTES, WORDS)}


def plain(text: str | None, path: str) -> tuple[list[int], str]:
    ids = LIBRARY[path].encode(text or "", add_special_tokens=False).ids
    return ids, LIBRARY[path].decode(ids, skip_special_tokens=False)


def digests(doc_id, text: str | None, path: str) -> tuple:
    ids, decoded = plain(text, path)
    listed = " ".join(map(str, ids))
    return doc_id, len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def check(texts: list[str | None], path: str) -> None:
    coder = encoder(path)
    ids, starts = coder.encode(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        own = ids[starts[i] : starts[i + 1]]
        want, decoded = plain(text, path)
        assert own.tolist() == want, repr(text)
        assert b"".join(coder.decode(own)).decode() == decoded, repr(text)


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_odd_texts(path):
    check(odd_texts(), path)


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_words_that_need_backtracking(path):
    draw = random.Random(4)
    some = ["".join(draw.choice("aabcdet'shnABT") for _ in range(draw.randint(1, 90))) for _ in range(1500)]
    wide = ["".join(chr(draw.choice([draw.randint(33, 126), draw.randint(160, 0x2FFF), draw.randint(0x1F300, 0x1F6FF)]))
                    for _ in range(draw.randint(1, 40))) for _ in range(500)]
    check([*some, *wide, *("a" * k for k in range(1, 70)), *("ab" * k for k in range(1, 30)), "=" * 3000], path)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_any_text(texts):
    texts = [t.encode(errors="ignore").decode() for t in texts]
    for path in (BYTES, WORDS):
        check(texts, path)


def test_dead_ends_are_left():
    """Words in which the longest matches lead nowhere are among the ones above."""
    merges, taken = encoder(WORDS).merges, []
    real = merges._backtrack
    merges._backtrack = lambda found, word: taken.append(word) or real(found, word)
    draw = random.Random(6)
    words = ["".join(draw.choice("abcdefghinoprst") for _ in range(30)) for _ in range(3000)]
    try:
        ids, sizes = merges.encode(words)
    finally:
        del merges._backtrack
    assert taken and int(sizes.sum()) == len(ids)
    want = [plain(w, WORDS)[0] for w in words]
    assert np.split(ids, np.cumsum(sizes)[:-1])[words.index(taken[0])].tolist() == want[words.index(taken[0])]
    assert ids.tolist() == [i for w in want for i in w]


def test_pairs_against_the_merges():
    """Two tokens are compatible if the library gives them back for their text."""
    merges, draw = encoder(BYTES).merges, random.Random(7)
    letters = {c: i for i, c in enumerate(backtrack.letters())}
    words = [(i, n) for i, n in merges.names.items() if n.isascii() and n.isalpha() and len(n) < 7]
    kept = 0
    for _ in range(1500):
        (a, one), (b, other) = draw.choice(words), draw.choice(words)
        text = bytes(letters[c] for c in one + other).decode()
        same = plain(text, BYTES)[0] == [a, b]
        assert merges.compatible(a, b) == same, (one, other)
        kept += same
    assert 100 < kept < 1400


def test_letters_cut_by_blocks_of_ids(monkeypatch):
    monkeypatch.setattr(backtrack, "DECODED", 1)
    check(["日本語 é👍🏽 x", "👍" * 5, "a b"], BYTES)
    raw = [encoder(BYTES).decode(np.array(ids)) for ids in ([0xE9 % 256], [])]
    assert [b"".join(r).decode() for r in raw][1] == ""


def test_rows(spark):
    """Nulls, ties, repeated rows, a very long text, and columns with names of the result."""
    rows = [(i % 50, t) for i, t in enumerate(odd_texts(80))] + [(None, "x y"), (None, "x y"), (7, "ab " * 200_000)]
    docs = spark.createDataFrame(rows, DOCS).repartition(4).withColumns({"ids": F.lit(1), "n_tokens": F.lit("t"), "decoded": F.lit(0)})
    got = encode_texts(docs, WORDS)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
    found = got.collect()
    assert sorted(map(str, (tuple(r)[:4] for r in found))) == sorted(str(digests(i, t, WORDS)) for i, t in rows)
    by = {}
    for i, t in rows:
        by.setdefault((i, digests(i, t, WORDS)[2]), plain(t, WORDS))
    assert all((r.ids, r.decoded) == by[r.doc_id, r.ids_sha256] for r in found)
    assert encode_texts(docs.limit(0), WORDS).collect() == []


def test_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, QUERIES["op13_backtracking_bpe"](spark, SF_DIR).collect()))
    assert got == sorted(digests(r.doc_id, r.text, public_tokenizers.path("word_bpe_49k.json")) for r in docs)
