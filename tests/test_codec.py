import random
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logintake.functions.codec import _RUN, NAMED_ESCAPES, escape, escape_valid, unescape
from workload.queries import unescape_invalid
from workload.shapes import BAD_ESCAPES

SPELLED = {ord(byte): text for byte, text in NAMED_ESCAPES}


def spell(data: bytes) -> str:
    return "".join(
        SPELLED.get(b) or (chr(b) if 32 <= b <= 126 else f"\\x{b:02X}") for b in data
    )


def both_ways(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "b binary")
    rows = df.select("b", escape(F.col("b")).alias("e")).select(
        "b", "e", unescape(F.col("e")).cast("binary").alias("u"), escape_valid(F.col("e")).alias("v")
    ).collect()
    for row in rows:
        assert row.e == spell(bytes(row.b))
        assert bytes(row.u) == bytes(row.b)
        assert row.v


def test_every_byte_and_text(spark):
    both_ways(
        spark,
        [bytes([b]) for b in range(256)]
        + [b"", b"plain", b"\\", b"\\\\n", b"a\\x41", bytes(range(256)), "é中\U0001f600".encode()],
    )


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.binary(max_size=60), min_size=200, max_size=300))
def test_any_bytes(spark, values):
    both_ways(spark, values)


def test_text_column(spark):
    df = spark.createDataFrame([("tab\tend é",), (None,)], "s string")
    assert [r[0] for r in df.select(escape(F.col("s"))).collect()] == [r"tab\tend \xC3\xA9", None]
    assert df.select(unescape(escape(F.col("s")))).collect() == df.collect()


def test_malformed_lines_come_back_unchanged(spark):
    bad = [r"end" + "\\", r"end\x", r"end\x4", r"end\xg0", r"end\q", r"\n then \q", "\\\\\\", "é\\"]
    df = spark.createDataFrame([(b,) for b in bad], "s string")
    rows = df.select("s", unescape(F.col("s")).alias("u"), escape_valid(F.col("s")).alias("v"))
    assert all(r.u == r.s and not r.v for r in rows.collect())


def test_either_case_of_hex_digits_and_bytes_between_escapes(spark):
    df = spark.createDataFrame([(b"\\xe9\\xE9 \xe9\\n",)], "b binary")
    row = df.select(unescape(F.col("b").cast("string")).cast("binary").alias("u")).first()
    assert bytes(row.u) == b"\xe9\xe9 \xe9\n"


def test_very_long_lines(spark):
    long = ["\\x41" * 300_000, "\\\\" * 300_000, "a\\n" * 300_000, "a" * 1_000_000]
    df = spark.createDataFrame([(s,) for s in long], "s string")
    got = [r[0] for r in df.select(unescape(F.col("s"))).collect()]
    assert sorted(got) == sorted(["A" * 300_000, "\\" * 300_000, "a\n" * 300_000, "a" * 1_000_000])
    back = df.select(unescape(escape(F.col("s")))).collect()
    assert sorted(r[0] for r in back) == sorted(long)


def test_valid_lines_are_those_of_whole_escapes(spark):
    draw = random.Random(3)
    made = ["".join(draw.choice(["\\", "\\", "x", "4", "f", "g", "n", "é", " "]) for _ in range(draw.randint(0, 9))) for _ in range(3000)]
    df = spark.createDataFrame([(s,) for s in made], "s string")
    whole = re.compile(r"(?:[^\\]|\\(?:[abtnvfr\\]|x[0-9A-Fa-f]{2}))*")
    for row in df.select("s", unescape(F.col("s")).alias("u"), escape_valid(F.col("s")).alias("v")).collect():
        assert row.v == bool(whole.fullmatch(row.s)), row.s
        assert row.v or row.u == row.s


def test_documents_are_escaped_once_for_all_endings(spark, tmp_path):
    """Below the generator that makes a row for each ending."""
    spark.createDataFrame([(1, "a\té")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = unescape_invalid(spark, str(tmp_path))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate explode") < plan.index(_RUN)
    assert sorted(r.line for r in out.collect()) == sorted(r"a\t\xC3\xA9" + e for e in BAD_ESCAPES.values())
