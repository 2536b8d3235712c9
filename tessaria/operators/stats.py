"""Aggregates that several statistics share."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.files import stored
from .ranking import ranges


def with_share(counts: DataFrame, name: str = "n") -> DataFrame:
    """``pct``: each row's share of the total, in per cent. ``counts`` has a row for each group, of which there may be many."""
    total = counts.agg(F.sum(name).alias("__total"))
    return counts.crossJoin(F.broadcast(total)).withColumn("pct", F.round(100.0 * F.col(name) / F.col("__total"), 4)).drop("__total")  # a single row


def top_and_other(counts: DataFrame, k: int) -> DataFrame:
    """The k largest groups under their names, all others under ``Other``. ``name`` is unique; null is a name."""
    top = counts.orderBy(F.desc("n"), "name").limit(k).select(F.col("name").alias("__top"), F.lit(True).alias("__in"))
    met = counts.join(F.broadcast(top), F.col("name").eqNullSafe(F.col("__top")), "left")  # k rows
    return met.withColumn("name", F.when(F.col("__in"), F.col("name")).otherwise("Other")).drop("__top", "__in")


#: A group of more values than this has its middle looked for by ranges; a smaller one's runs of equal values fit one task.
MANY_VALUES = 1_000_000


def value_counts(rows: DataFrame, by: list[str], value: str) -> DataFrame:
    """A stored table of how often (``k``) each group has each value, nulls left out: runs of equal values.

    Tasks count what they have first, so a value that very many rows share is a few rows of the shuffle.
    """
    counted = rows.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("k"))
    return stored(counted, "values")


def _same(by: list[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in by), F.lit(True))


def summaries(rows: DataFrame, by: list[str], value: str, *more: Column, name: str = "med") -> DataFrame:
    """A row for each group with the aggregates ``more`` and the exact median of ``value``, the mean of the two middle values.

    Nulls don't count; a group without values has a null median. Groups of up to MANY_VALUES values, which are counted first,
    take one shuffle: tasks merge runs of equal values by group, and the middle is chosen by their weights. Larger groups,
    and a whole table as one group, have their middle looked for by ranges of values, so no task holds all of these.
    """
    if not by:
        return rows.agg(*more).crossJoin(F.broadcast(_by_ranges(value_counts(rows, by, value), by, value, name))) if more else _by_ranges(value_counts(rows, by, value), by, value, name)
    merged = lambda some: some.groupBy(*by).agg(*more, F.percentile(value, F.lit(0.5)).alias(name))
    many = rows.groupBy(*by).agg(F.count(value).alias("__n")).filter(F.col("__n") > MANY_VALUES).select(*(F.col(c).alias(f"__b_{c}") for c in by))
    if many.isEmpty():
        return merged(rows)
    many = stored(many, "many")
    large = rows.join(many, _same(by, "__b_"), "left_semi")
    found = _by_ranges(value_counts(large, by, value), by, value, name).withColumnsRenamed({c: f"__m_{c}" for c in by})
    groups = large.groupBy(*by).agg(*more) if more else large.select(*by).distinct()
    whole = groups.join(found, _same(by, "__m_"), "left").drop(*(f"__m_{c}" for c in by))
    return merged(rows.join(many, _same(by, "__b_"), "left_anti")).unionByName(whole)


def _middle(met: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """From runs with the number of values ``__until`` their end and ``__n`` in all: the mean of both middle values."""
    here = lambda place: (F.col("__until") >= place) & (F.col("__until") - F.col("k") < place)
    lower, upper = F.floor((F.col("__n") + 1) / 2), F.floor((F.col("__n") + 2) / 2)
    ends = met.groupBy(*by).agg(F.max(F.when(here(lower), F.col(value))).alias("__lo"), F.max(F.when(here(upper), F.col(value))).alias("__hi"))
    return ends.select(*by, ((F.col("__lo") + F.col("__hi")) / 2).cast("double").alias(name))


def _by_ranges(counted: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """Counts by range of values tell in which range a group's middle lies, and only that range's values are looked at again.

    This is repeated until no range that holds a middle has more than MANY_VALUES values; those are put in order, a range
    in a task. Each turn keeps about a thousandth of the values.
    """
    total = counted.groupBy(*by).agg(F.sum("k").alias("__n")).withColumn("__before", F.lit(0).cast("long"))
    total = total.withColumnsRenamed({c: f"__t_{c}" for c in by})
    now = (counted.join(total, _same(by, "__t_")) if by else counted.crossJoin(F.broadcast(total))).drop(*(f"__t_{c}" for c in by))  # without groups a single row
    while True:
        ranged = now.withColumn("__b", ranges(now, value))
        inside = ranged.groupBy(*by, "__b", "__n", "__before").agg(F.sum("k").alias("__c"))
        order = Window.partitionBy(*by).orderBy("__b")  # a row for each range
        at = inside.withColumn("__start", F.col("__before") + F.sum("__c").over(order) - F.col("__c"))
        middle = at.filter((F.col("__start") + F.col("__c") >= F.floor((F.col("__n") + 1) / 2)) & (F.col("__start") < F.floor((F.col("__n") + 2) / 2)))
        middle = middle.select(*(F.col(c).alias(f"__m_{c}") for c in [*by, "__b"]), "__start")
        held = stored(ranged.join(middle, _same([*by, "__b"], "__m_")).drop(*(f"__m_{c}" for c in [*by, "__b"])), "middle")
        most = held.groupBy(*by, "__b").agg(F.count("*").alias("c")).agg(F.max("c")).first()[0] or 0
        before = now.count() if most > MANY_VALUES else 0
        if most <= MANY_VALUES or held.count() == before:
            break
        first = held.groupBy(*by).agg(F.min("__start").alias("__before")).withColumnsRenamed({c: f"__t_{c}" for c in by})
        rest = held.drop("__b", "__start", "__before")
        now = (rest.join(first, _same(by, "__t_")) if by else rest.crossJoin(F.broadcast(first))).drop(*(f"__t_{c}" for c in by))
    until = F.col("__start") + F.sum("k").over(Window.partitionBy(*by, "__b").orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    return _middle(held.withColumn("__until", until), by, value, name)


def stage_metrics(events: DataFrame) -> DataFrame:
    """Records processed, skipped and failed, and the mean time of those processed (0 without any)."""
    done = F.col("event_type") != "error"
    return events.agg(
        F.count_if(done).alias("processed"),
        F.count_if(F.col("event_type") == "view").alias("skipped"),
        F.count_if(~done).alias("failed"),
        F.round(F.coalesce(F.avg(F.when(done, F.col("value"))), F.lit(0.0)), 4).alias("avg_ms"),
    )


def overlap_scores(rows: DataFrame, predicted: str, truth: str) -> DataFrame:
    p, t = F.col(predicted) == 1, F.col(truth) == 1
    tp, fp, fn = F.count_if(p & t), F.count_if(p & ~t), F.count_if(~p & t)
    return rows.agg(F.round(tp / (tp + fp + fn), 6).alias("iou"), F.round(2 * tp / (2 * tp + fp + fn), 6).alias("dice"))


def cross_entropy(p: str, y: str) -> Column:
    return -(F.col(y) * F.log(F.col(p)) + (1 - F.col(y)) * F.log(1 - F.col(p)))


def richness(rows: DataFrame, state: str, species: str) -> DataFrame:
    """Species of a state as a share of all, times their evenness; and the state's most frequent one."""
    counts = rows.groupBy(F.col(state).alias("state"), F.col(species).alias("sp")).agg(F.count("*").alias("k"))
    every = counts.agg(F.countDistinct("sp").alias("every"))
    p = F.col("k") / F.sum("k").over(Window.partitionBy("state"))
    shares = counts.withColumn("p", p).crossJoin(F.broadcast(every))  # a single row
    return shares.groupBy("state").agg(
        F.count("*").alias("species"),
        F.round(F.count("*") / F.max("every") * (-F.sum(F.col("p") * F.log("p")) / F.log(F.count("*"))), 6).alias("richness"),
        F.min(F.struct((-F.col("k")).alias("k"), "sp"))["sp"].alias("dominant"),
    )


def tiers(rows: DataFrame, cuts: Mapping[str, tuple[float, float, float]]) -> DataFrame:
    """By metric, how many values fall into each of four bands; one pass over the rows."""
    bands = [F.when(F.col(c) < a, "excellent").when(F.col(c) < b, "good").when(F.col(c) < x, "fair").otherwise("poor").alias(c) for c, (a, b, x) in cuts.items()]
    counts = rows.select(*bands).unpivot([], list(cuts), "metric", "tier").groupBy("metric", "tier").agg(F.count("*").alias("n"))
    return counts.withColumn("pct", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("metric")), 4))


def funnel(rows: DataFrame, steps: Mapping[str, str]) -> DataFrame:
    """How many rows pass each step and all before it."""
    passed = [F.expr(test) for test in steps.values()]
    return rows.agg(*(F.count_if(reduce(lambda a, b: a & b, passed[: i + 1])).alias(name) for i, name in enumerate(steps)))
