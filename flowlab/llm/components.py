"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from flowlab.llm.common import stored


def _fingerprint(edges: DataFrame) -> tuple:
    """Changes whenever the set of edges does (but for a chance of 2 to the -64)."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).head())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): each linked node with the smallest node it can reach.

    Large-star and small-star steps in turn: every step links the neighbours of a node
    to their smallest one, by an aggregation and a join, until only stars are left. Only
    two figures of each step come to the driver. Nodes without a link have no row."""
    edges = stored(
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    seen = _fingerprint(edges)
    while seen[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(small, "u")
        edges = stored(
            near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(small.select("u", F.col("m").alias("v"))).distinct())
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
