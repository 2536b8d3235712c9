"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.files import stored


def _least_of(edges: DataFrame, at: str, to: str) -> DataFrame:
    """The least neighbour ``m`` of each node, by partial minima: a node with very many edges is never one group.

    It is a table, so that the join back to the edges can be split where such a node is, and it is merged, not broadcast:
    it grows with the edges, so it must not pass through the driver.
    """
    return stored(edges.groupBy(F.col(at).alias("a")).agg(F.min(to).alias("m")), "least").hint("merge")


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the least of the node and its neighbours."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least_of(both, "a", "b")
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node (edges go from the larger end to the smaller) and its smaller neighbours are linked to the least of them."""
    least = _least_of(edges, "a", "b")
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether each node has one edge to a smaller one at most, and none if it has edges from larger ones."""
    ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionAll(edges.select(F.col("b").alias("x"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    return ends.groupBy("x").agg(F.sum("down").alias("down"), F.max("up").alias("up")).filter("down > 1 OR (down = 1 AND up = 1)").isEmpty()


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """``node``, ``root`` for every node of ``edges`` (a, b: of any type with an order) but the roots, the least of each component.

    Alternating stars, whose rounds grow with the logarithm of a component's length. Each round is a table in the shared
    folder, so a lost executor costs one round at most. Nulls in ``a`` or ``b`` and edges from a node to itself don't
    count, repeated edges count once; an empty table gives none.
    """
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(rounds):
        if _stars(now):
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        now = stored(_small_star(stored(_large_star(now), "stars")), "stars")
    raise RuntimeError(f"components did not settle in {rounds} rounds")
