"""Connected components of an edge table by alternating stars.

Every round hangs the larger neighbours of each node, then the smaller ones, on the node's smallest neighbour, until nothing changes: edges
become stars around the smallest node of each component. Minima are aggregated before the shuffle and no neighbour list is ever
collected, so a node may have any number of edges. Each round is written to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerlens.session import stage


def _hung(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step on edges (a, b); of both directions for the larger, of the downward one for the smaller neighbours."""
    up = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    if larger:
        both = up.unionByName(up.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        moved = both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        least = up.groupBy("u").agg(F.min("v").alias("m"))
        moved = up.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for every node that has an edge. ``edges`` has bigint a and b."""
    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = None
    while True:
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if mark == seen:
            break
        mark = seen
        now = stage(_hung(_hung(now, larger=True), larger=False))
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
