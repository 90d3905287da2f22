"""Connected components by alternating large-star and small-star.

Every step is aggregations and sort-merge joins on node ids: a node with very many neighbours is
combined before the shuffle or split by Spark, and no neighbour list is ever collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace

ROUNDS = 60


def large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the least of the node and its neighbours. Edges: (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # The larger neighbours of u: the edges in which it is the smaller end.
    up = edges.select(F.col("v").alias("u"), F.col("u").alias("far"))
    return up.join(least, "u").select(F.col("far").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the least of these."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


def components(ws: Workspace, edges: DataFrame) -> DataFrame:
    """(u, v): v the least node of u's component, for each node that isn't least itself. edges: (u, v), any direction."""
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
    mark = last = None
    for _ in range(ROUNDS):
        edges = ws.write(small_star(large_star(edges)), "stars")
        if last is not None:
            ws.done(last)
        last = edges
        new = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(new) == mark:
            return edges
        mark = tuple(new)
    raise RuntimeError(f"no fixed point after {ROUNDS} rounds")
