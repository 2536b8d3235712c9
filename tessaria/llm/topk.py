"""Exact top-k by inner product: KD-trees per shard, best-first traversal, and a kth score that is passed on."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ends_clean, from_key, key_as_long, order_key, partitions, written

#: Rows of a shard, on average; rows of a leaf.
SHARD, LEAF = 65_536, 128


class Tree:
    """Median splits along the widest side; each node has the tight box of its rows. Equal rows share one leaf."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(ids))
        self.lo: list[np.ndarray] = []
        self.hi: list[np.ndarray] = []
        self.children: list[tuple[int, int] | None] = []
        self.slices: list[tuple[int, int]] = []
        pending = [(0, len(ids), -1, 0)]
        while pending:
            a, b, parent, side = pending.pop()
            here = rows[order[a:b]]
            lo, hi = here.min(0), here.max(0)
            node = len(self.lo)
            self.lo.append(lo)
            self.hi.append(hi)
            self.children.append(None)
            self.slices.append((a, b))
            if parent >= 0:
                left, right = self.children[parent] or (0, 0)
                self.children[parent] = (node, right) if side == 0 else (left, node)
            wide = int(np.argmax(hi - lo)) if rows.shape[1] else 0
            if b - a > leaf and rows.shape[1] and hi[wide] > lo[wide]:
                mid = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(here[:, wide], mid)]
                self.children[node] = (0, 0)
                pending += [(a, a + mid, node, 0), (a + mid, b, node, 1)]
        self.ids, self.rows = ids[order], rows[order]
        self.lo, self.hi = np.array(self.lo), np.array(self.hi)  # type: ignore[assignment]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The greatest inner product that a row in each node's box can have."""
        return np.maximum(queries, 0) @ self.hi.T + np.minimum(queries, 0) @ self.lo.T

    def search(self, query: np.ndarray, own: int, bounds: np.ndarray, k: int, least: float | int) -> list[tuple]:
        """(-score, id) of the k best rows at or above ``least``, best first, own id left out, ties to the smaller id.

        In a tree of integers all scores and bounds, ``least`` too, are Python's own integers (or, at first, minus infinity).
        """
        best: list[tuple] = []
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < least:
                break
            if (pair := self.children[node]) is not None:
                for c in pair:
                    if bounds[c] >= least:
                        heapq.heappush(heap, (-bounds[c], c))
                continue
            a, b = self.slices[node]
            got = self.rows[a:b] @ query
            fit = np.flatnonzero((got >= least) & (self.ids[a:b] != own))
            if len(fit) > k and got.dtype != object:  # of one leaf no more than k can stay; ties at the kth may
                fit = fit[got[fit] >= np.partition(got[fit], -k)[-k]]
            best = heapq.nsmallest(k, [*best, *zip((-got[fit]).tolist(), self.ids[a:b][fit].tolist(), strict=True)])
            if len(best) == k:
                least = max(least, -best[-1][0])
        return best


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of whole numbers as rows of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _whole(rows: np.ndarray) -> np.ndarray:
    """The same as Python integers, for which products and sums of any size are exact."""
    return np.array([[int(x) for x in row] for row in rows.tolist()], dtype=object).reshape(rows.shape)


def _near(least: int) -> float:
    """A bound for scores that are doubles below 2**53 on either side: beyond these it need not be exact."""
    return float(max(-(2**60), min(2**60, least)))


class Shard:
    """The candidates of one shard. Its tree is of doubles where all products and sums stay exact, of integers else."""

    def __init__(self, parts: list[pa.RecordBatch]):
        table = pa.Table.from_batches(parts).combine_chunks()
        self.ids, self.rows = table.column("vec_id").to_numpy(), _matrix(table.column("v").combine_chunks())
        self.most = float(np.abs(self.rows).max(initial=0)) * max(1, self.rows.shape[1])
        self.trees: dict[bool, Tree] = {}

    def found(self, qids: np.ndarray, queries: np.ndarray, least: list[int | None], k: int) -> list[tuple]:
        """(query's id, id, score) of the k best of each query at or above its ``least``."""
        exact = self.most * float(np.abs(queries).max(initial=0)) >= 2.0**53
        if exact not in self.trees:
            self.trees[exact] = Tree(self.ids, _whole(self.rows) if exact else self.rows)
        tree, queries = self.trees[exact], _whole(queries) if exact else queries
        out = []
        step = max(1, 4_000_000 // len(tree.slices))
        for a in range(0, len(qids), step):
            bounds = tree.bounds(queries[a : a + step])
            for i in range(a, min(a + step, len(qids))):
                start = float("-inf") if least[i] is None else least[i] if exact else _near(least[i])
                out += [(int(qids[i]), v, -int(s)) for s, v in tree.search(queries[i], qids[i], bounds[i - a], k, start)]
        return out


def usable(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def floored(x: Column) -> Column:
    """The next lower whole number, as a double; from 2**52 on all doubles are whole."""
    x = F.least(F.greatest(x, F.lit(-1.7e308)), F.lit(1.7e308))
    return F.when(F.abs(x) < 2.0**52, F.floor(x).cast("double")).otherwise(x)


FOUND = "query_id long, vec_id long, key binary"


def _search(k: int):
    """Batches come sorted by shard, candidates first: a shard's tree is built once and then asked batch by batch."""
    types = (pa.int64(), pa.int64(), pa.binary())

    def search(it):
        now, held, shard = None, [], None
        for batch in it:
            places = [batch.column(c).to_numpy() for c in ("dim", "shard", "asked")]
            cuts = [0, *(np.flatnonzero(np.any([p[1:] != p[:-1] for p in places], axis=0)) + 1), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if now != (places[0][a], places[1][a]):
                    now, held, shard = (places[0][a], places[1][a]), [], None
                part = batch.slice(a, b - a)
                if not places[2][a]:
                    held.append(part)
                elif held:
                    shard = shard or Shard(held)
                    least = [None if x is None else from_key(x) for x in part.column("least").to_pylist()]
                    found = shard.found(part.column("vec_id").to_numpy(), _matrix(part.column("v")), least, k)
                    columns = [[r[0] for r in found], [r[1] for r in found], [order_key(r[2]) for r in found]]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["query_id", "vec_id", "key"])

    return search


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10, every: int = 100, scale: int = 1024, shard: int = SHARD) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: for each row whose id is divisible by ``every`` the k best others.

    A component x counts as floor(scale * x), whatever its size; the score is the inner product, exact; ties go to the
    smaller id. Scores of any size are ordered exactly; ``score`` itself stops at the ends of a long. Vectors
    that are null or hold null or non-finite components, and rows without an id, take no part; vectors are compared
    with those of their own length only; rows that have the query's id aren't its candidates; rows that repeat an id
    count as candidates each, and the first of them in order of components asks. An empty table gives no rows; other
    columns don't matter.

    Rows are dealt to shards by a hash of id and vector, so repeated ids spread too. Each query first searches the tree
    of one shard; its kth score then goes with it to every other shard, where boxes that can't reach it are left out. A
    task builds a shard's tree once and then reads the queries batch by batch.
    """
    spark = vectors.sparkSession
    vector = F.transform(F.col(vector_col), lambda x: floored(x.cast("double") * scale))
    rows = vectors.filter(F.col(id_col).isNotNull() & usable(F.col(vector_col))).select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("v"))
    n = rows.count()
    shards = max(1, math.ceil(n / shard), min(partitions(spark), n // 4096))
    rows = rows.select("*", F.size("v").alias("dim"), F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int").alias("shard"))
    none = F.lit(None).cast("binary")
    candidates = rows.withColumns({"least": none, "asked": F.lit(0)})

    def searched(asked: DataFrame) -> DataFrame:
        both = candidates.unionByName(asked).repartition(partitions(spark), "dim", "shard").sortWithinPartitions("dim", "shard", "asked")
        return both.mapInArrow(ends_clean(_search(k)), FOUND)

    asking = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("v", "dim", "shard")).alias("q")).select("vec_id", "q.*")
    homes = written(searched(asking.withColumns({"least": none, "asked": F.lit(1)})), "topk")
    kth = homes.groupBy(F.col("query_id").alias("vec_id")).agg(F.count("*").alias("__n"), F.min("key").alias("__kth"))
    near = asking.join(kth, "vec_id", "left").withColumn("least", F.when(F.col("__n") == k, F.col("__kth")))
    to = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != F.col("shard"))
    away = searched(near.select("vec_id", "v", "dim", F.explode(to).alias("shard"), "least", F.lit(1).alias("asked")))
    order = Window.partitionBy("query_id").orderBy(F.desc("key"), "vec_id")
    best = homes.unionByName(away).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", key_as_long(F.col("key")).alias("score"))
