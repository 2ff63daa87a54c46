"""Exact dedup: deterministic naming of blocks.

A text is cut into blocks of a fixed size. Distinct blocks are sorted and numbered:
equal blocks get the same integer, different ones different integers. Then pairs of
adjacent names are named in the same way, until a document has one name left. Two
documents have the same identity (level, name) if and only if their texts are equal.

Blocks are sorted by two 64-bit hashes. That these tell all blocks apart is checked
on the bytes: blocks are grouped by hashes and content, and hashes with two contents
make the naming start again with another seed. So only one shuffle moves the text,
after equal blocks of a task have become one, and all others move names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logintake.llm.tables import documents
from logintake.session import written

BLOCK_BYTES = 4096
SEEDS = 16
SPACES = r"[\x20\x09-\x0D]+"


def block_hashes(block: Column, seed: int) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(seed), block), F.xxhash64(F.lit(~seed), block)


def _blocks(docs: DataFrame, size: int, seed: int, hashes: Callable) -> DataFrame:
    """One row per block; the text's own columns stand at its first block."""
    cut = docs.select(
        "doc_id",
        F.monotonically_increasing_id().alias("row"),
        F.regexp_replace("text", SPACES, " ").cast("binary").alias("data"),
    )
    count = F.greatest(F.lit(1), F.ceil(F.octet_length("data") / size)).cast("int")
    blocks = F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda i: F.substring(F.col("data"), i * size + 1, F.lit(size)),
    )
    rows = cut.select(
        "doc_id", "row", count.alias("n_blocks"), F.sha2("data", 256).alias("text_sha256"),
        F.posexplode(blocks).alias("pos", "block"),
    )
    h1, h2 = hashes(F.col("block"), seed)
    return rows.withColumns({"h1": h1, "h2": h2})


def _named(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with a ``name``: the number of their keys in the order of all keys.

    The numbers are a written table, so they stay the same when a task is repeated.
    Rows of a frequent key are many on one side of the join only, where adaptive
    execution splits them.
    """
    distinct = written(rows.select(*keys).distinct())
    ordered = distinct.repartitionByRange(*keys).sortWithinPartitions(*keys)
    names = written(ordered.withColumn("name", F.monotonically_increasing_id()))
    return rows.join(names, keys)


def text_identities(
    docs: DataFrame, block_bytes: int = BLOCK_BYTES, hashes: Callable = block_hashes
) -> DataFrame:
    """``row, doc_id, text_sha256, level, name`` of each row of ``doc_id, text``, as a
    written table. Rows with the same ``level`` and ``name`` have equal texts."""
    for seed in range(SEEDS):
        contents = written(
            _blocks(docs, block_bytes, seed, hashes)
            .groupBy("h1", "h2", "block")
            .agg(F.count(F.lit(1)).alias("n"))
            .select("h1", "h2", "n")
        )
        if contents.groupBy("h1", "h2").count().filter("count > 1").isEmpty():
            break
    else:
        raise ValueError(f"none of {SEEDS} seeds tells the blocks apart")

    blocks = written(
        _blocks(docs, block_bytes, seed, hashes)
        .withColumn("text_sha256", F.when(F.col("pos") == 0, F.col("text_sha256")))
        .drop("block")
    )
    most = blocks.agg(F.max("n_blocks")).first()[0] or 1
    names = written(
        _named(blocks.select("row", "pos", "n_blocks", "h1", "h2"), ["h1", "h2"]).select(
            "row", "pos", "n_blocks", "name"
        )
    )
    level = 0
    done = [names.filter("n_blocks = 1").select("row", F.lit(level).alias("level"), "name")]
    while most > 1:
        level, most = level + 1, (most + 1) // 2
        pairs = (
            names.filter("n_blocks > 1")
            .groupBy("row", "n_blocks", F.expr("pos div 2").cast("int").alias("pos"))
            .agg(
                F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
                F.coalesce(
                    F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)
                ).alias("right"),
            )
            .withColumn("n_blocks", F.expr("(n_blocks + 1) div 2").cast("int"))
        )
        names = written(
            _named(written(pairs), ["left", "right"]).select("row", "pos", "n_blocks", "name")
        )
        done.append(names.filter("n_blocks = 1").select("row", F.lit(level).alias("level"), "name"))
    identity = done[0]
    for one in done[1:]:
        identity = identity.unionByName(one)
    own = blocks.filter("pos = 0").select("row", "doc_id", "text_sha256")
    return written(own.join(identity, "row"))


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    hashes: Callable = block_hashes,
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after each run of ASCII white space has become one
    space. A null text is empty, and empty texts equal each other. Of equal texts the
    row with the smallest ``doc_id`` stays; a null id comes after all others, and of
    rows with the same id one stays. No rows give no rows.
    """
    members = text_identities(documents(docs, id_col, text_col), block_bytes, hashes)
    # Written, so that the join can split a group that holds many rows.
    groups = written(
        members.groupBy("level", "name").agg(
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("keep"),
            F.count(F.lit(1)).alias("group_size"),
        )
    )
    return members.join(groups, ["level", "name"]).select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("keep.row")).alias("kept"),
        "text_sha256",
    )
