"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash, unstash


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node that can be reached.

    Links with a null end or with both ends equal are ignored, repeated links count once; an empty
    table gives an empty result.  Each step is a grouped minimum (with partial sums before the
    exchange) and an equi-join, so that a node with very many links is split like any skewed key.
    The lineage is cut after every step.
    """
    edges = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = stash(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        # large star: every larger neighbour of a node is linked to the node's smallest neighbour
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # small star: every smaller neighbour of a node, and the node, are linked to the smallest of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        after = stash(small.where("a <> b").distinct(), "links")
        unstash(edges)
        edges, state = after, _state(after)
        if state == before:
            break
        before = state
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
