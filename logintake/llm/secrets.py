"""Secret scans with ownership frequency over the corpus.

Three kinds of candidates are found in whole texts. Each candidate's value is hashed,
and for each hash the distinct owners and repositories that hold it are counted. A
value that many owners hold is a copied example; one that a single owner holds and
that looks random is a credential that may be live.

Column expressions only. Counting goes from (value, owner, repository) over (value,
owner) to value, each step combined before its shuffle, so a value that a third of
all rows hold is no more than one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logintake.session import written

# Kinds in their order: pattern, group of the value, least characters of the value.
KINDS = {
    "assign": (
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        1, 12,
    ),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
}

MIN_OWNERS = 3
MIN_REPOS = 5
RANDOM_CHARS = 8

# The same matches, where a failing one cannot hide a longer one behind it: runs
# below the least length need not be listed.
LISTED = {"access": r"AKIA[A-Z0-9]{14,}", "hex": r"[0-9a-f]{16,}"}


def _hits(kind: int, found: str, values: str, pieces: str, least: int) -> Column:
    """Matches of a kind with what lies before each, in characters.

    The lists are zipped, not indexed: an expression used inside a lambda would be
    computed again for each element.
    """

    def one(x: Column, i: Column) -> Column:
        value = x["value"]
        return F.struct(
            F.lit(kind).alias("kind"),
            i.alias("pos"),
            F.length(x["piece"]).cast("long").alias("gap"),
            F.length(x["match"]).cast("long").alias("len"),
            (F.length(value) >= least).alias("ok"),
            F.sha2(value, 256).alias("value_hash"),
            (
                (F.size(F.array_distinct(F.split(value, ""))) >= RANDOM_CHARS)
                & value.rlike("[0-9]") & value.rlike("[A-Za-z]")
            ).alias("random"),
        )

    zipped = F.arrays_zip(
        F.col(found).alias("match"), F.col(values).alias("value"), F.col(pieces).alias("piece")
    )
    return F.transform(zipped, one)


def candidates(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From ``doc_id, text, owner, repo``: the documents with a row number, and their
    spans ``row, kind, start, stop, value_hash, random, owner, repo``, both written.
    The text is read once."""
    scan = docs.withColumn("row", F.monotonically_increasing_id())
    lists = {}
    for kind, (pattern, group, _) in KINDS.items():
        pattern = F.lit(LISTED.get(kind, pattern))
        lists[f"m_{kind}"] = F.regexp_extract_all("text", pattern, F.lit(0))
        if group:
            lists[f"v_{kind}"] = F.regexp_extract_all("text", pattern, F.lit(group))
    scan = scan.withColumns(lists)
    scan = scan.withColumns({
        f"p_{kind}": F.when(
            F.size(f"m_{kind}") > 0,
            F.slice(F.split("text", LISTED.get(kind, pattern), -1), F.lit(1), F.size(f"m_{kind}")),
        ).otherwise(F.array().cast("array<string>"))
        for kind, (pattern, _, _) in KINDS.items()
    })
    hits = F.concat(*[
        _hits(i, f"m_{kind}", f"v_{kind}" if group else f"m_{kind}", f"p_{kind}", least)
        for i, (kind, (_, group, least)) in enumerate(KINDS.items())
    ])
    found = written(scan.select("row", "doc_id", "owner", "repo", hits.alias("hits")))
    along = Window.partitionBy("row", "kind").orderBy("pos")
    spans = (
        found.filter(F.size("hits") > 0)
        .select("row", "owner", "repo", F.explode("hits").alias("hit"))
        .select("row", "owner", "repo", "hit.*")
        .withColumn("stop", F.sum(F.col("gap") + F.col("len")).over(along))
        .withColumn("start", F.col("stop") - F.col("len"))
        .filter("ok")
        .select("row", "kind", "start", "stop", "value_hash", "random", "owner", "repo")
    )
    return found.select("row", "doc_id"), written(spans)


def ownership(spans: DataFrame) -> DataFrame:
    """``value_hash, spans, repos, owners`` of each value. A null owner or repository
    counts as one of its own; a repository belongs to its owner."""
    by_repo = spans.groupBy("value_hash", "owner", "repo").agg(F.count(F.lit(1)).alias("n"))
    by_owner = by_repo.groupBy("value_hash", "owner").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("repos")
    )
    return by_owner.groupBy("value_hash").agg(
        F.sum("n").alias("spans"), F.sum("repos").alias("repos"), F.count(F.lit(1)).alias("owners")
    )


def secret_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner: Column | str = "owner",
    repo: Column | str = "repo",
    min_owners: int = MIN_OWNERS,
    min_repos: int = MIN_REPOS,
) -> DataFrame:
    """One row per document: ``doc_id, found``, with ``found`` the array of its spans
    by start and kind: ``kind`` (name), ``start`` and ``stop`` in code points, the end
    exclusive, ``value_hash``, ``owners``, ``repos``, ``spans`` of that value in all
    documents, and ``status``.

    ``status`` is "example" for a value of at least ``min_owners`` owners or
    ``min_repos`` repositories, "live" for a random-looking value of one owner, else
    "unclear". A null or empty text has no spans, null ids and repeated rows stay rows
    of their own, and no rows give no rows.
    """
    column = lambda c: F.col(c) if isinstance(c, str) else c
    rows, spans = candidates(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
            column(owner).cast("string").alias("owner"),
            column(repo).cast("string").alias("repo"),
        )
    )
    # Written, so that the join can split a value that many rows hold.
    owned = written(ownership(spans))
    status = (
        F.when((F.col("owners") >= min_owners) | (F.col("repos") >= min_repos), "example")
        .when((F.col("owners") == 1) & F.col("random"), "live")
        .otherwise("unclear")
    )
    names = F.array(*[F.lit(kind) for kind in KINDS])
    judged = spans.drop("owner", "repo").join(owned, "value_hash")
    found = judged.groupBy("row").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    "start", F.col("kind").alias("rank"), "stop",
                    F.get(names, F.col("kind")).alias("kind"),
                    "value_hash", "owners", "repos", "spans", status.alias("status"),
                )
            )
        ).alias("found")
    )
    kept = ["kind", "start", "stop", "value_hash", "owners", "repos", "spans", "status"]
    listed = F.transform("found", lambda x: F.struct(*[x[c].alias(c) for c in kept]))
    empty = F.array().cast(
        "array<struct<kind:string,start:long,stop:long,value_hash:string,"
        "owners:long,repos:long,spans:long,status:string>>"
    )
    return rows.join(found, "row", "left").select(
        "doc_id", F.coalesce(listed, empty).alias("found")
    )
