"""Connected components of an edge list, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storepulse.llm.scratch import stage


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """`node`, `root`: the smallest node reachable, for every node that has an edge.

    Each round points the larger neighbours of a node at its smallest neighbour, then
    the smaller ones; the edges end as one star per component, after a number of rounds
    that grows with the logarithm of the longest path. Every round is a written table.
    Neighbours are never gathered: a minimum per node is joined back to its edges.
    """
    links = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .filter("u <> v").distinct())
    links, before = stage(links, "links"), None
    while True:
        large = _star(links.select("u", "v").unionByName(links.select(F.col("v").alias("u"),
                                                                      F.col("u").alias("v"))), "v > u")
        small = _star(stage(large, "links"), "v < u")
        links = stage(small, "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _star(links: DataFrame, which: str) -> DataFrame:
    """Edges (u, v) with v on the side `which`, moved to the smallest neighbour of u."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    moved = links.filter(which).join(least, "u")
    kept = moved.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if which == "v < u":
        kept = kept.unionByName(least.select("u", F.col("m").alias("v")))
    return kept.filter("u <> v").select(F.greatest("u", "v").alias("u"),
                                        F.least("u", "v").alias("v")).distinct()
