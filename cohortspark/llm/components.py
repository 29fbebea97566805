"""Connected components by alternating large-star and small-star steps on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node move to the smallest node around it."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return least.select("u", F.col("m").alias("v")).unionAll(moved).distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, comp (smallest node of its component) of every node that has a link.

    Every round is a written table, so a lost executor costs one round; hot nodes meet the
    aggregates as partial minima and the joins as rows that can be split."""
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    edges, before = materialize(edges, "cc-edges"), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before == tuple(state) or state[0] == 0:
            break
        before = tuple(state)
        edges = materialize(_small_star(_large_star(edges)), "cc-edges")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionAll(roots)
