"""A training corpus from raw documents, stage by stage.

Each stage works on all that its predecessor kept, and what it returns is written and read
again as the next one's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logintake.llm.importance import keep_sample
from logintake.llm.lines import drop_repeated_chunks
from logintake.llm.queries import tokenizer_file
from logintake.llm.packing import pack
from logintake.llm.seeds import decontaminate
from logintake.llm.simhash import keep_one
from logintake.llm.tables import read
from logintake.session import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the importance sample leaves out."""
    return keep_sample(docs, read(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated chunks of lines, and their lengths counted again."""
    names = docs.columns
    cleaned = drop_repeated_chunks(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*names)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that overlap with a benchmark item."""
    return decontaminate(docs, read(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their ids, and the sequences they lie in."""
    return pack(docs, tokenizer_file("word_bpe_49k.json"), 2, ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


# Tokenizers, rolling hashes and bit votes are beyond SQL: tests/llm compares each stage
# with a brute-force version.
ORACLE_SQL = None
