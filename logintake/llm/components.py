"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logintake.session import written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for each node of the edges ``a, b`` (long, not null), the root being
    the smallest node of its component.

    Alternates large and small stars (Kiveris et al., 2014): each node hands its larger
    neighbours, then its smaller ones, to the smallest node it knows, until every node
    hangs on its root. Each half step is a written table. The smallest neighbour of a
    node is an aggregate of its own, joined back, so a node with very many neighbours is
    never in one task as a whole.
    """
    a, b = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = written(edges.filter("a <> b").select(a, b).distinct())
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("least")))
        large = written(
            both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()
        )
        least = written(large.groupBy("a").agg(F.min("b").alias("b")))
        small = (
            large.join(least.withColumnRenamed("b", "least"), "a")
            .filter("b <> least")
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
        )
        edges = written(small.unionByName(least).distinct())
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    own = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return written(roots.unionByName(own))
