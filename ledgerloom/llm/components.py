"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom.session import stage


def connected(edges: DataFrame, a: str, b: str, label: str) -> DataFrame:
    """Rows ``(node, root)`` for every node that has an edge to another; the root is the smallest node it can reach.

    Each round hangs the larger neighbours of a node on its smallest neighbour, then a node's smaller neighbours on the
    smallest of them; chains halve in length, so rounds grow with the logarithm of the longest one.  A node's smallest
    neighbour is found by an aggregate that combines on the map side, no list of neighbours is ever built.  Every round
    is a table in the shared folder.  Loops and null ends are ignored.
    """
    now = stage(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u != v").distinct(),
        label,
    )
    seen = None
    while (mark := _mark(now)) != seen:
        seen = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        now = stage(small.unionByName(down.select("u", F.col("m").alias("v"))).distinct(), label)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _mark(edges: DataFrame) -> tuple:
    """Count and order-free digest of a set of edges, one row."""
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count(F.lit(1)), digest).first())
