"""Connected components of an edge table by alternating large-star and small-star rounds.

A round replaces every edge by one to the smallest node that its end knows, until each
component is a star around its smallest node; their number grows with the logarithm of the
longest path. Minima are pre-aggregated before the shuffle and a node's minimum
is one row, so a node with a third of all edges is only a long side of a join, which
adaptive execution splits. Each round is cut off with ``checkpoint()``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _large_star(e: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node it knows."""
    both = e.union(e.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("v"), F.least("u", "m").alias("m"))
    return e.join(least, "v").select("u", F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours, and itself, to the smallest of them."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def _signature(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of an edge; component: the smallest node reachable.

    Edges may repeat, point either way or be loops; one with a null end is ignored. Nodes can be of
    any orderable type. A node without an edge to another is not in the result.
    """
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), (F.col(a) != F.col(b)).alias("real"))
         .filter("real").select("u", "v").distinct())
    e = checkpointed(e)
    seen = _signature(e)
    while True:
        e = checkpointed(_small_star(_large_star(e)))
        now = _signature(e)
        if now == seen:
            break
        seen = now
    stars = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())
