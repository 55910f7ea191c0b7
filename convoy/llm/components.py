"""Connected components of a graph that is given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convoy.llm.common import cut


def connected(edges: DataFrame) -> DataFrame:
    """The smallest node reachable from every node of ``edges`` (u, v of any one type that has an order), as (node, root).

    Large and small stars in turn: each step hangs the neighbours of a node below the smallest of them, until the edges
    stay as they are and every tree is a star. A hub's neighbours are never gathered: minima are aggregated and joined
    back, and Spark can split that join. Loops and repeated edges are harmless; null ends are left out.
    """
    edges = edges.where("u IS NOT NULL AND v IS NOT NULL AND u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    )
    edges, mark = _settled(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
            .select("e.u", F.col("e.m").alias("v"))
        )
        edges, now = _settled(small.where("u <> v"))
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = now


def _settled(edges: DataFrame) -> tuple[DataFrame, tuple]:
    edges = cut(edges.distinct())
    wide = F.xxhash64("u", "v").cast("decimal(38,0)")
    return edges, tuple(edges.agg(F.count(F.lit(1)), F.sum(wide), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
