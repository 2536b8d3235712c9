"""Mixing sources to target weights: hierarchical budgets over a tree of levels, filled from seeded epochs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import named, written

#: Hex digits of the order key that make a bin, and a bin within a bin; a leaf's running token sums are kept by bin.
BIN_DIGITS = (2, 4)


def words(text: Column) -> Column:
    """The number of runs of anything but ASCII white space."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def weight(level: Column, given: Mapping[str, float]) -> Column:
    """The weight of a node among its siblings; 1 where none is given."""
    found = F.lit(1.0)
    for name, w in given.items():
        found = F.when(level == name, F.lit(float(w))).otherwise(found)
    return found


def fill(nodes: DataFrame, parent: Sequence[str], name: str) -> DataFrame:
    """Give each node of one parent its share of ``parent_budget``: ``budget`` = least(cap, w * level).

    The water level is the greatest of (budget - caps of those filled) / (weights of the rest) over the siblings in
    order of cap / w, so what one node lacks goes to its siblings by weight, and only what all of them lack together
    stays with the parent's own siblings (their caps were counted above).
    """
    siblings = Window.partitionBy(*(parent or [F.lit(0)]))
    order = siblings.orderBy("__ratio", name)
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return (
        nodes.filter("w > 0")
        .withColumn("__ratio", F.col("cap") / F.col("w"))
        .withColumn("__level", (F.col("parent_budget") - before) / rest)
        .withColumn("budget", F.least(F.col("cap").cast("double"), F.col("w") * F.max("__level").over(siblings)))
        .drop("__ratio", "__level")
    )


def leaf_budgets(leaves: DataFrame, levels: Sequence[str], weights: Mapping[str, Mapping[str, float]], budget: Column, max_epochs: int) -> DataFrame:
    """``leaves`` (one row a leaf, with ``tokens``) plus ``budget`` in whole tokens. ``budget``: of ``__total`` tokens.

    A node's cap is ``max_epochs`` times the tokens below it; budgets go down the tree level by level. All frames here
    have a row for each node at most.
    """
    leaves = leaves.withColumn("cap", F.col("tokens") * max_epochs)
    above = leaves.agg(F.sum("tokens").alias("__total"), F.sum("cap").alias("__cap")).select(F.least(budget, F.col("__cap").cast("double")).alias("parent_budget"))
    path: list[str] = []
    for name in levels:
        nodes = leaves.groupBy(*path, name).agg(F.sum("cap").alias("cap"))
        nodes = nodes.join(above, path) if path else nodes.crossJoin(F.broadcast(above))  # above the top level: a single row
        filled = fill(nodes.withColumn("w", weight(F.col(name), weights.get(name, {}))), path, name)
        path.append(name)
        above = filled.select(*path, F.col("budget").alias("parent_budget"))
    whole = above.select(*path, F.floor(F.round("parent_budget", 4)).alias("budget"))
    return leaves.join(whole, path, "left").withColumn("budget", F.coalesce("budget", F.lit(0)))


def mix(
    docs: DataFrame,
    levels: Mapping[str, Column],
    weights: Mapping[str, Mapping[str, float]],
    budget_ratio: float = 1.0,
    budget_tokens: int | None = None,
    max_epochs: int = 2,
    seed: int = 42,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The chosen rows: ``__id``, ``__version`` (hash of the text), a column for each level, ``n_tokens``, ``epoch``.

    levels: names and expressions from the top of the tree down; a null value counts as an empty name. weights: by
    level, a node's weight among its siblings (default 1; 0: none). The budget is ``budget_tokens``, or
    ``budget_ratio`` of all tokens, but never more than ``max_epochs`` times all. Tokens are words. A leaf's documents
    are put in the order of md5(seed:epoch:id) anew for each epoch; whole epochs are taken while they fit, and then
    the longest prefix of the next that doesn't pass the budget. A document without words goes with its neighbours in
    that order. Rows of equal id and text are chosen together; an empty table gives no rows; very long texts count as
    wholes, and a leaf whose budget is smaller than its first document gets none, nor does one without words; other
    columns don't matter.

    Only (id, levels, tokens) travels. A prefix is found by sums over 256 bins of the order key, then over 256 within
    the one in which a leaf's budget ends, so that only a 65,536th of a leaf is ordered row by row.
    """
    text = named(text_col)
    tree = [F.coalesce(c.cast("string"), F.lit("")).alias(name) for name, c in levels.items()]
    rows = written(docs.select(named(id_col).alias("__id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("__version"), *tree, words(text).alias("n_tokens")), "mixing")
    names = list(levels)
    leaves = rows.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"))
    budget = F.lit(float(budget_tokens)) if budget_tokens is not None else F.col("__total") * F.lit(float(budget_ratio))
    plan = leaf_budgets(leaves, names, weights, budget, max_epochs)
    some = F.col("tokens") > 0
    plan = plan.select(*names, F.when(some, F.floor(F.col("budget") / F.col("tokens"))).otherwise(0).cast("int").alias("__full"), F.when(some, F.col("budget") % F.col("tokens")).otherwise(0).cast("long").alias("__rest"))
    plan = written(plan, "mixing-plan")  # a row for each leaf

    keyed = rows.join(plan, names).withColumn("__order", F.md5(F.concat_ws(":", F.lit(seed).cast("string"), (F.col("__full") + 1).cast("string"), F.coalesce(F.col("__id").cast("string"), F.lit("")))))
    cut = None
    for digits in BIN_DIGITS:
        here = keyed.withColumn("__base", F.lit(0).cast("long")) if cut is None else keyed.join(cut, names).filter(F.startswith("__order", "__bin")).drop("__bin")
        sums = here.groupBy(*names, "__rest", "__base", F.left("__order", F.lit(digits)).alias("__bin")).agg(F.sum("n_tokens").alias("__n"))
        sums = sums.withColumn("__until", F.col("__base") + F.sum("__n").over(Window.partitionBy(*names).orderBy("__bin")))
        ends = sums.filter(F.col("__until") > F.col("__rest")).groupBy(*names).agg(F.min(F.struct("__bin", (F.col("__until") - F.col("__n")).alias("__base"))).alias("__cut"))
        cut = written(ends.select(*names, "__cut.__bin", "__cut.__base"), "mixing-cut")
    placed = keyed.join(cut, names, "left").withColumn("__own", F.left("__order", F.lit(BIN_DIGITS[-1])))
    at = F.col("__bin")
    inside = placed.filter(F.col("__own") == at)
    run = Window.partitionBy(*names).orderBy("__order", "__id", "n_tokens", "__version").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("__in", F.col("__base") + F.sum("n_tokens").over(run) <= F.col("__rest"))
    rest = placed.filter(at.isNull() | (F.col("__own") != at)).withColumn("__in", at.isNull() | (F.col("__own") < at))
    chosen = inside.unionByName(rest).withColumn("__copies", F.col("__full") + F.when(F.col("__in") & (F.col("__rest") > 0), 1).otherwise(0))
    return chosen.filter("__copies > 0").select("__id", "__version", *names, "n_tokens", F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("epoch"))


def mixed_documents(docs: DataFrame, *args, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whatever their names, repeated as often as ``mix`` chose them.

    Null and empty texts, null ids, repeated rows, very long texts and empty tables are as in ``mix``: rows of equal id
    and text are chosen together, and each of them is repeated.
    """
    chosen = mix(docs, *args, id_col=id_col, text_col=text_col, **more)
    copies = chosen.groupBy("__id", "__version").agg(F.max("epoch").alias("__copies"))
    keyed = docs.withColumns({"__d_id": named(id_col), "__d_version": F.xxhash64(F.coalesce(named(text_col), F.lit("")))})
    met = keyed.join(copies, F.col("__d_id").eqNullSafe(F.col("__id")) & (F.col("__d_version") == F.col("__version")))
    return met.select(*map(named, docs.columns), F.explode(F.sequence(F.lit(1), F.col("__copies"))).alias("__epoch")).drop("__epoch")
