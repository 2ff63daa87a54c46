"""Every registered query over whole tables: against its SQL, or against brute force."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import brute
import corpus_pipeline
from compare import connect, differences
from logintake.llm.oracle import ORACLE
from logintake.llm.queries import QUERIES
from logintake.session import written

SF_DIR = "/root/testdata/sf0.001"


def docs_of(spark, df=None) -> list[tuple]:
    df = spark.read.parquet(f"{SF_DIR}/documents.parquet") if df is None else df
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_registered():
    names = entry_points.queries()
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(names)
    assert set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE[name]) == []


def test_op3(spark):
    packed(spark, QUERIES["op3_differencing"](spark, SF_DIR), docs_of(spark))


def packed(spark, got, docs) -> None:
    pieces, used, path = {}, {}, public_tokenizers.path("word_bpe_49k.json")
    for r in got.collect():
        pieces.setdefault(r.doc_id, []).append(r)
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, text in docs:
        ids, at = brute.encoded(text, path, 2), 0
        for r in sorted(pieces.pop(i), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == brute.crc(ids[at : at + r.length])
            at += r.length
        assert at == len(ids)
    assert not pieces
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096


def test_op4(spark):
    """What goes, by chunks and stretches; and each chunk that is repeated goes."""
    docs = docs_of(spark)
    got = {r.doc_id: r for r in QUERIES["op4_line_chunks"](spark, SF_DIR).collect()}
    assert {i: r.text for i, r in got.items()} == {d[0]: t for d, t in brute.without_stretches(docs).items()}
    by_chunks = brute.without_repeats(docs)
    for d, text in by_chunks.items():
        gone = d[1].count("\n") - text.count("\n") if text != d[1] else 0
        assert got[d[0]].removed_lines >= gone and (got[d[0]].removed_chunks > 0 or gone == 0)


def test_op6(spark):
    docs = docs_of(spark)
    fps = [brute.simhash(t) for _, t in docs]
    want = [(i, f"{f:016x}", docs[c][0]) for (i, _), f, c in zip(docs, fps, brute.clusters(fps, 4))]
    assert sorted(map(tuple, QUERIES["op6_bit_sliced"](spark, SF_DIR).collect())) == want


def test_op9(spark):
    got = sorted(map(tuple, QUERIES["op9_bit_planes"](spark, SF_DIR).collect()))
    assert got == brute.digests(docs_of(spark), public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def changed(spark, tmp_path_factory):
    """The tables, with odd rows and with columns that the operators add themselves."""
    folder = str(tmp_path_factory.mktemp("tables"))
    turns = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    odd = turns.filter("conv_id < 40 AND turn = 0").withColumns({
        "turn": F.lit(None).cast("bigint"), "role": F.lit("system"), "text": F.concat(F.lit("s"), F.col("conv_id") % 3),
    })
    turns.unionByName(odd).withColumns({"part": F.lit(1), "last": F.lit(2)}).write.parquet(f"{folder}/conversations.parquet")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    added = ("removed_chunks", "REMOVED_LINES", "ids", "file", "start", "row", "key", "n", "form", "term", "rank", "p")
    docs.withColumns({c: F.lit(0) for c in added}).write.parquet(f"{folder}/documents.parquet")
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    pages.withColumns({c: F.lit(0) for c in ("key", "file", "offset", "payload_bytes")}).write.parquet(f"{folder}/pages.parquet")
    for name in ("benchmark", "labels"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_op2_with_turns_without_number(spark, changed):
    """They come first, on both sides."""
    con = connect(SF_DIR)
    con.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT conv_id, turn, role, text FROM read_parquet('{changed}/conversations.parquet/*.parquet')")
    got = QUERIES["op2_preference_turns"](spark, changed)
    assert differences(got, con, ORACLE["op2_preference_turns"]) == []
    assert got.filter("part = 'prompt' AND number = 0 AND role = 'system'").count() >= 20


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op2_preference_turns"}))
def test_clashing_names(spark, changed, name):
    """Columns of the same names in the tables change nothing."""
    got, want = (QUERIES[name](spark, folder) for folder in (changed, SF_DIR))
    assert got.columns == want.columns
    if name == "op3_differencing":
        got, want = (df.groupBy("doc_id").agg(F.sum("length")) for df in (got, want))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def table_of(spark, name: str, *columns: str) -> list[tuple]:
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/{name}.parquet").select(*columns).collect()]


def test_op10(spark):
    """Weights, keys and k against a plain version; a row for every document."""
    docs, labels = docs_of(spark), table_of(spark, "labels", "doc_id", "quality", "toxic")
    want, k = brute.importance(docs, labels, 1 << 17)
    got = {r.doc_id: r for r in QUERIES["op10_importance"](spark, SF_DIR).collect()}
    assert len(got) == len(docs) and 0 < k < len(docs)
    for i, weight, key, kept in want:
        assert got[i].log_weight == pytest.approx(weight, abs=1e-9) and got[i].key == pytest.approx(key, abs=1e-6)
        assert got[i].kept == kept


# The pipeline, stage by stage: each is tested on what its predecessor kept.

STAGE = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def chain(spark):
    """What each stage is given."""
    inputs, docs = {}, spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs
        docs = written(stage(spark, docs, SF_DIR))
    return {**inputs, "": docs}


def after(chain, name: str):
    names = list(chain)
    return chain[names[names.index(name) + 1]]


def test_stages(chain):
    assert list(STAGE) == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"]
    names = chain["quality"].columns
    assert all(chain[s].columns == names for s in STAGE)


def test_quality_stage(spark, chain):
    want, _ = brute.importance(docs_of(spark), table_of(spark, "labels", "doc_id", "quality", "toxic"), 1 << 17)
    assert [i for i, _ in docs_of(spark, after(chain, "quality"))] == sorted(i for i, _, _, kept in want if kept)


def test_line_stage(spark, chain):
    before, kept = docs_of(spark, chain["line_dedup"]), after(chain, "line_dedup")
    want = brute.without_stretches(before)
    assert docs_of(spark, kept) == sorted((d[0], want[d]) for d in before)
    assert kept.filter("n_chars != length(text)").count() == 0


def test_near_stage(spark, chain):
    before = docs_of(spark, chain["near_dedup"])
    groups = brute.clusters([brute.simhash(t) for _, t in before], 4)
    assert docs_of(spark, after(chain, "near_dedup")) == [before[g] for g in sorted(set(groups))]


def test_decontamination_stage(spark, chain):
    before = docs_of(spark, chain["decontamination"])
    dirty = {d for d, _ in brute.overlaps(before, table_of(spark, "benchmark", "item_id", "text"))}
    assert dirty and docs_of(spark, after(chain, "decontamination")) == [d for d in before if d[0] not in dirty]


def test_packing_stage(spark, chain):
    packed(spark, after(chain, "packing"), docs_of(spark, chain["packing"]))


@pytest.mark.parametrize("name", list(STAGE))
def test_stage_with_odd_rows(spark, chain, name):
    """Nulls, empty texts, repeated rows; and no rows at all."""
    docs = chain["quality"]
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (9001, "", "", "", 0), (9002, None, "en", None, None), (9001, "", "", "", 0),
         (None, "one text", "en", "s", 8), (None, "one text", "en", "s", 8)], docs.schema,
    )
    got = STAGE[name](spark, docs.limit(40).unionByName(odd), SF_DIR)
    assert got.count() > 0
    none = STAGE[name](spark, docs.limit(0), SF_DIR)
    assert none.count() == 0 and none.columns == got.columns


def test_run_chains_the_stages(spark, monkeypatch):
    """Each stage gets what the one before it returned, written and read again."""
    def less(spark, docs, sf_dir):
        return docs.filter(F.col("doc_id") % 2 == 0).withColumn("doc_id", F.expr("doc_id div 2"))

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("a", less), ("b", less), ("c", lambda s, d, p: d.select("doc_id"))])
    got = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(r.doc_id for r in got.collect()) == [i // 4 for i, _ in docs_of(spark) if i % 4 == 0]


def test_native_queries_run_no_python(spark):
    for name in ("op1_secret_ownership", "op2_preference_turns"):
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
