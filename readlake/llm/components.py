"""Connected components over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, spread_join


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has an edge to a different node.

    Nodes are of any type with an order. Alternating large-star and small-star steps: every step is a grouped minimum
    (combined before the shuffle) and a join of the edges with the minima of their nodes. A hub may have most of the
    edges, so each minimum comes with its node's count, and those of heavy nodes are joined by broadcast. Rounds grow
    with the logarithm of the longest chain. Only counts and a checksum come to the driver.
    """
    e = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    e = cut(e)
    seen, total = None, e.count()
    while total:
        both = cut(e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        low = cut(both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n"))
        large = spread_join(both.where("v > u"), low, "u", "n", 2 * total).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut(large)
        low = cut(large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")))
        small = spread_join(large, low, "u", "n", total).where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        total, check = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if (total, check) == seen:
            break
        seen = (total, check)
    leaves = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
