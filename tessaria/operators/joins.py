"""Lookups by key, by priority and by prefix; reports on what did not match."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.files import stored


def by_priority(wanted: DataFrame, key: str, candidates: list[tuple[str, DataFrame]]) -> DataFrame:
    """``wanted`` plus ``path`` and ``found_in``: of all candidates (key, path), those of the first source in the list, there the least path."""
    each = [df.select(key, "path", F.lit(i).alias("__p"), F.lit(name).alias("__s")) for i, (name, df) in enumerate(candidates)]
    best = reduce(DataFrame.unionByName, each).groupBy(key).agg(F.min(F.struct("__p", "path", "__s")).alias("__best"))
    joined = wanted.join(best, key, "left")
    return joined.withColumns({"path": F.col("__best.path"), "found_in": F.coalesce("__best.__s", F.lit("missing"))}).drop("__best")


def with_fallback(left: DataFrame, right: DataFrame, first: tuple[str, str], second: tuple[str, str], value: str) -> DataFrame:
    """``value`` by the first pair of keys, else by the second (of several the least); ``direct`` tells which."""
    a = right.groupBy(F.col(first[1]).alias("__a")).agg(F.min(value).alias("__va"))
    b = right.groupBy(F.col(second[1]).alias("__b")).agg(F.min(value).alias("__vb"))
    joined = left.join(a, F.col(first[0]) == F.col("__a"), "left").join(b, F.col(second[0]) == F.col("__b"), "left")
    return joined.withColumns({value: F.coalesce("__va", "__vb"), "direct": F.col("__va").isNotNull()}).drop("__a", "__va", "__b", "__vb")


def paired(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Each key of either side once, and on which sides it is."""
    sides = a.select(key, F.lit(1).alias("__s")).unionByName(b.select(key, F.lit(2).alias("__s"))).distinct()
    both = F.when(F.sum("__s") == 3, "paired").when(F.sum("__s") == 1, "no_mask").otherwise("no_image")
    return sides.groupBy(key).agg(both.alias("status"))


def reason(*tests: tuple[str, Column]) -> Column:
    """The name of the first test that holds, else ``ok``."""
    return reduce(lambda rest, t: F.when(t[1], t[0]).otherwise(rest), reversed(tests), F.lit("ok"))


#: A key that so many rows ask for is looked up by itself.
HOT = 100_000


def by_any_key(wanted: DataFrame, dim: DataFrame, keys: dict[str, tuple[Column, Callable[[Column], Column]]], entry: str) -> DataFrame:
    """``wanted`` (kind, key) plus the ``entry`` of the row of ``dim`` that has this key of this kind, of several the greatest.

    ``keys``: by kind, a column of ``dim`` and how a key of that kind is normalised on both sides. Keys that very many
    rows ask for (no more than one in HOT rows) are counted and broadcast; their rows, and those that ask for nothing,
    are dealt evenly, so no task of the join has all rows of such a key.
    """
    each = [dim.select(F.lit(kind).alias("__kind"), normal(c).alias("__key"), F.col(entry)) for kind, (c, normal) in keys.items()]
    known = reduce(DataFrame.unionByName, each).filter("__key is not null").groupBy("__kind", "__key").agg(F.max(entry).alias(entry))
    known = stored(known.withColumn("__none", F.lit(0).cast("long")), "known")  # read from a table, it stays a key of the join; a constant would not
    normal_key = reduce(lambda rest, k: F.when(F.col("kind") == k, keys[k][1](F.col("key"))).otherwise(rest), keys, F.lit(None).cast("string"))
    asked = wanted.withColumn("__wanted", normal_key)
    often = asked.filter("__wanted is not null").groupBy(F.col("kind").alias("__kind"), F.col("__wanted").alias("__key")).count().filter(F.col("count") >= HOT)
    hot = stored(often.drop("count").join(known, ["__kind", "__key"], "left").select(F.col("__kind").alias("__hot_kind"), F.col("__key").alias("__hot"), F.col(entry).alias("__hot_entry")), "hot")
    asked = asked.join(F.broadcast(hot), (F.col("kind") == F.col("__hot_kind")) & (F.col("__wanted") == F.col("__hot")), "left")
    # the place of a row that needs no lookup depends on the row and its task, so that a task which runs twice deals alike
    hashed = [F.col("`" + f.name.replace("`", "``") + "`") for f in wanted.schema if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    settled = F.col("__hot").isNotNull() | F.col("__wanted").isNull()
    asked = asked.withColumns({"__deal": F.when(settled, F.xxhash64(F.spark_partition_id(), *hashed)).otherwise(F.lit(0)), "__wanted": F.when(~settled, F.col("__wanted"))})
    known = known.select("__kind", "__key", "__none", F.col(entry).alias("__entry"))
    met = asked.join(known, (F.col("kind") == F.col("__kind")) & (F.col("__wanted") == F.col("__key")) & (F.col("__deal") == F.col("__none")), "left")
    return met.withColumn(entry, F.coalesce("__hot_entry", "__entry")).drop("__wanted", "__hot_kind", "__hot", "__hot_entry", "__deal", "__kind", "__key", "__none", "__entry")


def first_prefix(rows: DataFrame, text: str, listed: DataFrame, prefix: str, place: str, name: str) -> DataFrame:
    """``rows`` plus ``name``: the prefix of ``text`` that comes first in the list, by its ``place``; rows without one are left out.

    Each distinct text is cut only at the lengths that occur in the list, which are gathered into one row; a prefix of such a
    length is an equal key. Rows meet their text's prefix again at the end, so repeated rows stay, and columns of any type.
    """
    lengths = listed.agg(F.sort_array(F.collect_set(F.length(prefix))).alias("__lengths"))  # no more than the longest prefix has characters
    texts = rows.select(F.col(text).alias("__text")).filter("__text is not null").distinct().crossJoin(F.broadcast(lengths))
    fitting = F.filter("__lengths", lambda n: n <= F.length("__text"))
    cut = texts.select("__text", F.explode(F.transform(fitting, lambda n: F.left(F.col("__text"), n))).alias("__cut"))
    known = listed.select(F.col(prefix).alias("__cut"), F.col(place).alias("__place"))
    best = cut.join(known, "__cut").groupBy("__text").agg(F.min_by("__cut", F.struct("__place", "__cut")).alias(name))
    best = stored(best, "prefixes")  # a join with a table can be split where very many rows have one text
    return rows.join(best, F.col(text) == F.col("__text")).drop("__text")


def checked(found: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """``found`` (key, sha256, bytes) beside ``expected`` (key, expected_sha256): ok, mismatch, unlisted, or missing for those not found."""
    status = F.when(F.col("sha256").isNull(), "missing").when(F.col("expected_sha256").isNull(), "unlisted").when(F.col("sha256") == F.col("expected_sha256"), "ok").otherwise("mismatch")
    return found.join(expected, key, "full").withColumn("status", status)
