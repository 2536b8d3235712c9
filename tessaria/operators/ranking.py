"""Ranks, seeded orders and first-wins choices without a window over all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.files import stored


#: Multiplier of the generator, and the 31 bits that it keeps.
MULTIPLIER, LOW = 1103515245, 0x7FFFFFFF


def seeded_order(row_id: Column, seed: int) -> list[Column]:
    """Sort keys of a seeded order of 64-bit ids, no two of which share all keys; a null id comes first.

    The generator's value of the id's low 31 bits, from products that fit a long whatever the id. The other bits are
    folded into these by one round of a Feistel network, which can be undone, so with the id itself as second key ids
    that differ in high bits alone are spread over the whole order; ids from 0 to 2**31 - 1 keep the generator's own order.
    """
    whole = row_id.cast("long")
    high = F.shiftright(whole, 31)
    low = whole.bitwiseAND(LOW).bitwiseXOR(F.when(high == 0, F.lit(0).cast("long")).otherwise(F.xxhash64(F.lit(seed), high).bitwiseAND(LOW)))
    return [(low * MULTIPLIER + seed % (LOW + 1)).bitwiseAND(LOW), whole]


def md5_key(seed: int, *cols: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *(F.col(c).cast("string") for c in cols)))


def in_ranges(df: DataFrame, order: list[Column]) -> DataFrame:
    """A stored table of the rows plus ``__at``: above 33 bits the number of a range of ``order``, below the place inside.

    Spark's range exchange deals the rows to as many ranges as there are shuffle partitions, by cuts that it samples from
    the whole key. A random number is the key's last part, so rows that share all sort columns, however many, are split
    too. Each range is sorted by itself, and may spill.
    """
    keys = [*order, F.col("__salt")]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.withColumn("__salt", F.rand(11)).repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    return stored(placed.withColumn("__at", F.monotonically_increasing_id()).drop("__salt"), "ranges")


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """A global rank from 1 in ``order``, sort columns of any number and type, nulls where these put them.

    A row's rank is its place in its range plus the sizes of the ranges before. Rows that share all sort columns are
    ranked among each other by chance, so give a unique column last where that matters. All columns of ``df`` are written
    once: rank a wide table by its sort columns and an id, and join the rest.
    """
    rows, part = in_ranges(df, order), F.shiftright("__at", 33)
    sizes = rows.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))  # a row for each range
    before = sizes.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    met = rows.join(F.broadcast(before), part == F.col("__part"))
    return met.withColumn(name, (F.col("__before") + F.col("__at").bitwiseAND((1 << 33) - 1) + 1).cast("long")).drop("__at", "__part", "__n", "__before")


def shuffled_rank(df: DataFrame, key: str, seed: int, name: str = "rank") -> DataFrame:
    """The place of each row in a seeded shuffle."""
    return ranked(df.withColumn("__md5", md5_key(seed, key)), [F.col("__md5"), F.col(key)], name).drop("__md5")


def ranges(df: DataFrame, key: str, n: int | None = None) -> Column:
    """The number of a range of ``key``: ``n`` quantiles are the cuts, found in one pass.

    By default as many as twice the shuffle partitions, 256 at least and 1000 at most.
    """
    n = n or min(1000, max(256, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    found = df.agg(F.percentile_approx(key, [i / n for i in range(1, n)], 10_000)).first()[0] or []
    cuts = sorted(set(found))

    def at(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col(key) < cuts[mid], at(lo, mid)).otherwise(at(mid + 1, hi))

    return at(0, len(cuts))


def first_of(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row of each key, the first in ``order``."""
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("__rn = 1").drop("__rn")


def per_group(df: DataFrame, by: list[str], k: int, order: list[Column]) -> DataFrame:
    """Up to ``k`` rows of each group; null is a group."""
    return df.withColumn("__rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("__rn") <= k).drop("__rn")
