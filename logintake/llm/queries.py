"""One query per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logintake.llm.backtrack import encode_texts
from logintake.llm.blocks import exact_duplicates
from logintake.llm.importance import importance_sample
from logintake.llm.divergence import source_divergence
from logintake.llm.infill import fill_in_middle
from logintake.llm.lines import drop_repeated_chunks
from logintake.llm.packing import pack
from logintake.llm.planes import read_ids, write_ids
from logintake.llm.preference import preference_turns
from logintake.llm.secrets import KINDS, secret_scan
from logintake.llm.seeds import leaks
from logintake.llm.simhash import near_duplicates
from logintake.llm.tables import read
from logintake.llm.warc import look_up, write_archives, write_index
from logintake.session import shared_folder, written


def op1_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source of a document is the owner, its part in one language a repository."""
    found = secret_scan(
        read(spark, sf_dir, "documents"),
        owner="source",
        repo=F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit(""))),
    )
    spans = F.array_join(
        F.transform("found", lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ","
    )

    def count(field: str, value: str) -> Column:
        return F.size(F.filter("found", lambda x: x[field] == value)).cast("long")

    return found.select(
        "doc_id",
        *[count("kind", kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(spans, 256).alias("base_sha256"),
        spans.alias("spans"),
        count("status", "example").alias("n_example"),
        count("status", "live").alias("n_live"),
    )


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def preference_sides(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each conversation as the chosen side of a pair. Its rejected side ends, instead of
    with its own last answer, with that of the neighbour (the id with its last bit turned).
    """
    turns = turns.select(F.col("conv_id").alias("pair_id"), "turn", "role", "text")
    last = F.max(F.when(F.col("role") == "assistant", F.col("turn"))).alias("last")
    # Written, so that the joins can split a long conversation.
    last = written(turns.groupBy("pair_id").agg(last))
    marked = turns.join(last, "pair_id")
    earlier = F.col("turn").isNull() | (F.col("turn") < F.col("last"))
    before = marked.filter(F.col("last").isNull() | earlier)
    answers = marked.filter((F.col("role") == "assistant") & (F.col("turn") == F.col("last")))
    answers = answers.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), "role", "text")
    # Behind all turns where the conversation has no answer of its own.
    place = F.coalesce("last", F.lit(1 << 40)).cast("long").alias("turn")
    other = answers.join(last, "pair_id").select("pair_id", place, "role", "text")
    return turns, before.drop("last").unionByName(other)


def op2_preference_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference_turns(*preference_sides(read(spark, sf_dir, "conversations")))


def op3_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), 2, ids=False)


def op4_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = drop_repeated_chunks(read(spark, sf_dir, "documents"), counts=True)
    chunks, lines = cleaned.columns[-2:]
    return cleaned.select("doc_id", "text", F.col(chunks).alias("removed_chunks"), F.col(lines).alias("removed_lines"))


def op5_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read(spark, sf_dir, "documents"))


def op6_bit_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def op7_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "matches", "window")


def op8_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, folder = read(spark, sf_dir, "pages"), shared_folder(spark)
    write_index(write_archives(pages, folder), folder)
    return look_up(spark, folder, pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark)
    write_ids(read(spark, sf_dir, "documents"), folder, tokenizer_file("byte_bpe_50k.json"), 0)
    return read_ids(spark, folder, digest=True)


def op10_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight and key of every document, and whether it is drawn."""
    return importance_sample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_fenwick_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(read(spark, sf_dir, "documents"), text=False)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(read(spark, sf_dir, "documents"))


def op13_backtracking_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return encode_texts(docs, tokenizer_file("word_bpe_49k.json"), ids=False, text=False)


QUERIES = {
    "op1_secret_ownership": op1_secret_ownership,
    "op2_preference_turns": op2_preference_turns,
    "op3_differencing": op3_differencing,
    "op4_line_chunks": op4_line_chunks,
    "op5_block_naming": op5_block_naming,
    "op6_bit_sliced": op6_bit_sliced,
    "op7_spaced_seeds": op7_spaced_seeds,
    "op8_capture_index": op8_capture_index,
    "op9_bit_planes": op9_bit_planes,
    "op10_importance": op10_importance,
    "op11_fenwick_infill": op11_fenwick_infill,
    "op12_source_divergence": op12_source_divergence,
    "op13_backtracking_bpe": op13_backtracking_bpe,
}
