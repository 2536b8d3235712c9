"""Hard negatives: for each anchor and positive the best rows of another label whose score lies in a band below the positive's."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LONG, ends_clean, from_key, key_as_long, named, order_key, partitions, written
from .topk import floored, usable

#: Candidates of a shard, on average, and candidates whose components share one wide integer.
SHARD, BLOCK = 65_536, 2_048


def whole(row: np.ndarray) -> list[int]:
    return [int(x) for x in row.tolist()]


class Block:
    """Up to BLOCK candidates. The same component of all of them is packed into one wide integer, a field each.

    Components are biased, so that no field is negative. An anchor multiplies each packed integer by its own component
    and adds the products up: each field then holds one score plus a known bias, exact, as a field is made wide enough
    for the largest sum that these candidates and the anchor allow.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray):
        self.ids, self.labels, self.rows = ids, labels, rows
        self.bias = int(np.abs(rows).max(initial=0))
        self.packs: dict[int, list[int]] = {}
        self.ones: dict[int, int] = {}

    def _packed(self, width: int) -> list[int]:
        if width not in self.packs:
            if width <= 8:
                biased = (self.rows.astype(np.int64) + self.bias).astype(f"<u{width}")
                self.packs[width] = [int.from_bytes(np.ascontiguousarray(biased[:, i]).tobytes(), "little") for i in range(self.rows.shape[1])]
            else:
                self.packs[width] = [int.from_bytes(b"".join((int(x) + self.bias).to_bytes(width, "little") for x in self.rows[:, i].tolist()), "little") for i in range(self.rows.shape[1])]
            self.ones[width] = int.from_bytes((b"\x01" + bytes(width - 1)) * len(self.ids), "little")
        return self.packs[width]

    def scores(self, anchor: list[int]) -> np.ndarray:
        """The inner products of all candidates with an anchor: as 64-bit integers where they fit, else as Python's."""
        if not self.bias or not any(anchor):
            return np.zeros(len(self.ids), np.int64)
        most = 2 * self.bias * sum(map(abs, anchor))  # no field, before ``lift``, lies beyond this on either side
        bits = (2 * most + 1).bit_length()
        width = 4 if bits <= 32 else 8 if bits <= 63 else -(-bits // 8)
        total = most * (self._packed(width), self.ones[width])[1]
        for a, pack in zip(anchor, self.packs[width], strict=True):
            if a:
                total += a * pack
        raw = total.to_bytes(width * len(self.ids), "little")
        lift = most + self.bias * sum(anchor)
        if width <= 8:
            return np.frombuffer(raw, f"<u{width}").astype(np.int64) - lift
        return np.array([int.from_bytes(raw[k : k + width], "little") - lift for k in range(0, len(raw), width)], dtype=object)


def best(scores: np.ndarray, ids: np.ndarray, some: np.ndarray, k: int) -> list[int]:
    """Of the candidates ``some`` the ``k`` of the greatest scores, ties to the smaller id."""
    if len(some) > 4 * k and scores.dtype != object:  # ties at the kth score stay
        some = some[scores[some] >= np.partition(scores[some], -k)[-k]]
    return sorted(some.tolist(), key=lambda i: (-scores[i], ids[i]))[:k]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Shard:
    """The candidates of one shard in blocks, ordered by label."""

    def __init__(self, parts: list[pa.RecordBatch]):
        table = pa.Table.from_batches(parts).combine_chunks()
        ids, labels, rows = table.column("vec_id").to_numpy(), table.column("label").to_numpy(), _matrix(table.column("v").combine_chunks())
        order = np.lexsort((ids, labels))
        self.blocks = [Block(ids[some], labels[some], rows[some]) for some in np.split(order, range(BLOCK, len(order), BLOCK))]

    def positives(self, own: int, label: int, anchor: list[int], k: int) -> list[tuple[int, int]]:
        """(id, score) of the anchor's best rows of its own label."""
        found = []
        for b in self.blocks:
            if b.labels[0] <= label <= b.labels[-1]:
                scores = b.scores(anchor)
                found += [(int(b.ids[i]), int(scores[i])) for i in best(scores, b.ids, np.flatnonzero((b.labels == label) & (b.ids != own)), k)]
        return sorted(found, key=lambda x: (-x[1], x[0]))[:k]

    def negatives(self, own: int, label: int, anchor: list[int], bands: list[tuple[int, int]], k: int) -> list[list[tuple[int, int]]]:
        """For each band of scores, ends included, (id, score) of the best rows of other labels in it."""
        found: list[list[tuple[int, int]]] = [[] for _ in bands]
        for b in self.blocks:
            if b.labels[0] == label == b.labels[-1]:
                continue
            scores = b.scores(anchor)
            other = (b.labels != label) & (b.ids != own)
            for got, (lo, hi) in zip(found, bands, strict=True):
                if scores.dtype != object:
                    lo, hi = max(lo, -LONG), min(hi, LONG - 1)
                some = np.flatnonzero(other & (scores >= lo) & (scores <= hi)) if lo <= hi else np.zeros(0, np.int64)
                got += [(int(b.ids[i]), int(scores[i])) for i in best(scores, b.ids, some, k)]
        return [sorted(got, key=lambda x: (-x[1], x[0]))[:k] for got in found]


FOUND = "anchor_id long, positive_rank int, vec_id long, key binary"


def _search(positives: int, negatives: int, low: tuple[int, int], high: tuple[int, int]):
    """Batches come sorted by shard, candidates first; an anchor without bands looks for positives, one with them for negatives."""

    def bands(keys: list[bytes]) -> list[tuple[int, int]]:
        return [(-(-low[0] * p // low[1]), high[0] * p // high[1]) for p in map(from_key, keys)]

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
                    continue
                if not held:
                    continue
                shard = shard or Shard(held)
                out: list[tuple] = []
                for own, label, v, keys in zip(part.column("vec_id").to_pylist(), part.column("label").to_pylist(), _matrix(part.column("v")), part.column("keys").to_pylist(), strict=True):
                    if keys is None:
                        out += [(own, 0, i, order_key(s)) for i, s in shard.positives(own, label, whole(v), positives)]
                    else:
                        got = shard.negatives(own, label, whole(v), bands(keys), negatives)
                        out += [(own, r + 1, i, order_key(s)) for r, some in enumerate(got) for i, s in some]
                columns = [[r[k] for r in out] for k in range(4)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.binary()), strict=True)], ["anchor_id", "positive_rank", "vec_id", "key"])

    return search


def hard_negatives(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    every: int = 50,
    positives: int = 5,
    negatives: int = 3,
    low: tuple[int, int] = (50, 100),
    high: tuple[int, int] = (95, 100),
    scale: int = 256,
    shard: int = SHARD,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``, ``positive_rank``.

    Anchors are rows whose id is divisible by ``every``. An anchor's positives are its best ``positives`` other rows of its
    label; each has the best ``negatives`` rows of other labels whose scores lie between ``low`` and ``high`` (fractions) of
    the positive's. A component x counts as floor(scale * x), the score is the exact inner product, whatever its size;
    higher scores come first, ties by smaller id. Scores beyond a long's ends are shown as these, but ordered exactly.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part; vectors are compared with
    those of their own length only. Rows that have the anchor's own id are none of its candidates; rows that repeat
    another id count each; of rows that repeat an anchor's id the first in order of components and label asks. An empty
    table gives no rows; other columns don't matter.

    Candidates are dealt to shards by a hash of id and vector, so a label or id that very many rows share is spread too.
    Anchors go to all shards twice: for positives, which are scored against blocks of their own label alone, and, with the
    bands that these give, for negatives. A shard returns so many rows for each anchor at most; these are merged by
    windows over anchors.
    """
    spark = vectors.sparkSession
    vector = F.transform(named(vector_col), lambda x: floored(x.cast("double") * scale))
    good = named(id_col).isNotNull() & named(label_col).isNotNull() & usable(named(vector_col))
    rows = vectors.filter(good).select(named(id_col).cast("long").alias("vec_id"), named(label_col).cast("long").alias("label"), vector.alias("v"))
    n = rows.count()
    shards = max(1, math.ceil(n / shard), min(partitions(spark), n // 4096))
    rows = rows.select("*", F.size("v").alias("dim"), F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int").alias("shard"))
    none = F.lit(None).cast("array<binary>")
    candidates = rows.withColumns({"keys": none, "asked": F.lit(0)})
    anchors = rows.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("v", "label", "dim")).alias("a")).select("vec_id", "a.*")

    def searched(asking: DataFrame) -> DataFrame:
        asked = asking.select("vec_id", "label", "v", "dim", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "keys", F.lit(1).alias("asked"))
        both = candidates.unionByName(asked).repartition(partitions(spark), "dim", "shard").sortWithinPartitions("dim", "shard", "asked")
        return both.mapInArrow(ends_clean(_search(positives, negatives, low, high)), FOUND)

    def first(found: DataFrame, by: list[str], k: int, name: str) -> DataFrame:
        order = Window.partitionBy(*by).orderBy(F.desc("key"), "vec_id")
        return found.withColumn(name, F.row_number().over(order)).filter(F.col(name) <= k)

    like = written(first(searched(anchors.withColumn("keys", none)).drop("positive_rank"), ["anchor_id"], positives, "positive_rank"), "positives")
    ranked = F.array_sort(F.collect_list(F.struct("positive_rank", "key")))  # ``positives`` rows at most
    bands = like.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.transform(ranked, lambda x: x["key"]).alias("keys"))
    unlike = first(searched(anchors.join(bands, "vec_id")), ["anchor_id", "positive_rank"], negatives, "rank")
    named_like = like.select("anchor_id", "positive_rank", F.col("vec_id").alias("positive_id"), key_as_long(F.col("key")).alias("positive_score"))
    shown = unlike.select("anchor_id", "positive_rank", "rank", F.col("vec_id").alias("negative_id"), key_as_long(F.col("key")).alias("negative_score"))
    return shown.join(named_like, ["anchor_id", "positive_rank"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "positive_rank")
