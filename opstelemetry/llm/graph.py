"""Connected components of a graph given as edges, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opstelemetry.functions.scale import settle


def _hung_lower(edges: DataFrame, near: DataFrame, keep_self: bool) -> DataFrame:
    """Move edges (u, v) from u to the least node that ``near`` knows around u."""
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = edges.join(least, "u")
    moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v"))
    if keep_self:
        moved = moved.unionByName(joined.select("u", F.col("m").alias("v")))
    return moved.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b): the smallest node that can be reached.

    Each round is two aggregations and two joins, so a hub's edges are pre-aggregated and its join
    partition can be split; no list of neighbours is ever built. The number of rounds grows with the
    logarithm of a component's size.
    """
    both = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    now, mark = settle(both), None
    while True:
        found = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if found == mark or not found[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        mark = found
        turned = now.select(F.col("v").alias("u"), F.col("u").alias("v"))
        large = _hung_lower(turned, now.unionByName(turned), keep_self=False)
        upward = _hung_lower(now, now, keep_self=False)
        large = large.unionByName(upward).where("u > v")
        now = settle(_hung_lower(large, large, keep_self=True))
