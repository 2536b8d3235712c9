"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link each node's larger (or no larger) neighbours, and for small stars the node, to the least of all of them.

    The least neighbour is found by partial minima and joined back, so a node with very many edges is never one group.
    """
    if large:
        both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        least = written(least, "least")  # a join with a table can be split where a node has very many edges
        return both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    least = written(least, "least")
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether each node has one edge down at most, and to a node that has none: then components are stars around their least."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("n")).unionByName(edges.select(F.col("b").alias("x"), F.lit(0).alias("n")))
    odd = ends.groupBy("x").agg(F.sum("n").alias("up"), F.min("n").alias("down")).filter("up > 1 OR (up = 1 AND down = 0)")
    return odd.isEmpty()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node``, ``root`` (the least node of its component) for every node of ``edges`` (a, b: long) that isn't a root."""
    now = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(rounds):
        if _settled(now):
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        now = written(_star(now, True), "stars")
        now = written(_star(now, False), "stars")
    raise RuntimeError(f"components did not settle in {rounds} rounds")
