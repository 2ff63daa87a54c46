"""Fill-in-middle against plain slices."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from logintake.llm.infill import BlockTree, arranged, draws, fill_in_middle, restored
from test_llm_files import DOCS, odd_texts

PATTERNS = {"chars": r"(?s).", "words": r"(?s)\A[\t-\r ]*[^\t-\r ]*[\t-\r ]*|[^\t-\r ]+[\t-\r ]*", "lines": r"[^\n]*\n|[^\n]+"}


def units_of(text: str, units: str) -> list[str]:
    if units == "words":
        # White space that begins a text is a unit of its own.
        return re.findall(r"\A[\t-\r ]+|[^\t-\r ]+[\t-\r ]*", text)
    return re.findall(PATTERNS[units], text)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain(doc_id, text: str | None, units: str = "chars", rate: int = 90, spm: int = 20) -> tuple:
    text = text or ""
    parts = units_of(text, units)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or h3 % 100 >= rate or any(m in text for m in ("<P>", "<S>", "<M>")):
        return doc_id, len(parts), "plain", None, None, digest(text), digest(text)
    a, b = sorted((h1 % (len(parts) + 1), h2 % (len(parts) + 1)))
    prefix, middle, suffix = ("".join(p) for p in (parts[:a], parts[a:b], parts[b:]))
    form = "spm" if h4 % 100 < spm else "psm"
    out = f"<P>{prefix}<S>{suffix}<M>{middle}" if form == "psm" else f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, len(parts), form, len(prefix), len(middle), digest(out), digest(text)


@pytest.mark.parametrize("units", ["chars", "words", "lines"])
@pytest.mark.parametrize("block", [1, 2, 7, 1024])
def test_every_cut(units, block):
    draw = random.Random(block)
    texts = ["", "a", "é", " a\n\nb ", "\n", "日本 語\n👍🏽x"] + [
        "".join(draw.choice("ab \n\té日👍") for _ in range(draw.randint(1, 90))) for _ in range(25)
    ]
    for text in texts:
        parts, data = units_of(text, units), np.frombuffer(text.encode(), np.uint8)
        tree = BlockTree(data, units, block)
        assert (tree.total, tree.chars) == (len(parts), len(text))
        for k in range(len(parts) + 1):
            before = "".join(parts[:k])
            assert tree.cut(k) == (len(before.encode()), len(before)), (text, k)


def test_restored():
    """Also where the parts hold pieces of marks."""
    draw = random.Random(3)
    for _ in range(2000):
        parts = ["".join(draw.choice("<PSM>a") for _ in range(draw.randint(0, 5))).encode() for _ in range(3)]
        if any(m in b"".join(parts) for m in (b"<P>", b"<S>", b"<M>")):
            continue
        for form in ("psm", "spm"):
            assert restored(arranged(*parts, form), form) == b"".join(parts)
    with pytest.raises(ValueError):
        restored(b"no marks", "psm")


@pytest.mark.parametrize("units", ["chars", "words", "lines"])
def test_rows(spark, units):
    """Nulls, marks, ties, repeated rows, a very long text, and columns with names of the result."""
    rows = [(i % 90, t) for i, t in enumerate(odd_texts(150))]
    rows += [(None, "null id"), (None, "null id"), (3, "é " * 400_000), *((100 + i, f"x{m}y") for i, m in enumerate(["<P>", "<S>", "<M>", "<P"]))]
    docs = spark.createDataFrame(rows, DOCS).repartition(4).withColumns({"n": F.lit("n"), "form": F.lit(0), "output": F.lit(1)})
    got = fill_in_middle(docs, units=units).collect()
    assert sorted(str(tuple(r)[:7]) for r in got) == sorted(str(plain(i, t, units)) for i, t in rows)
    assert all(digest(r.output) == r.output_sha256 for r in got)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fill_in_middle(docs.limit(0)).collect() == []


def test_rates(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("abc").alias("text"))
    assert {r.form for r in fill_in_middle(docs, rate=0).collect()} == {"plain"}
    assert {r.form for r in fill_in_middle(docs, rate=100, spm=100).collect()} == {"spm"}
    assert draws(None) == draws("")
