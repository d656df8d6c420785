"""Connected components of a distributed edge table by alternating large-star and small-star steps.

Every step is an aggregate and joins on the node id, so a star with a very
large number of leaves is split by the skew join; nothing is gathered by node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Each neighbour above a node is linked to the node's least neighbour (the node itself included)."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.filter("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .filter("a <> b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """A node's neighbours below it, and the node itself, are linked to the least of them.  Needs a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, root)`` for every node that occurs in ``links``; root is the least node reachable.

    Self links are ignored.  Each round is written to the shared folder; the
    loop ends when a round leaves the edges as they were, which takes a number
    of rounds that grows with the logarithm of the longest path.
    """
    edges = written(
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct(), "edges"
    )
    state = None
    while True:
        new = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        if new == state or not new["n"]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        state = new
        edges = written(_small_star(_large_star(edges)), "edges")
