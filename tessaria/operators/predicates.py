"""Predicates as values: typed by the column they test, never by the look of the literal."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Longer value lists are joined instead of listed in the plan.
LONG_LIST = 1_000
_COMPARE = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    ">=": lambda a, b: a >= b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    "<": lambda a, b: a < b,
}


def typed(df: DataFrame, name: str, value: Any) -> Column:
    """A literal as the column's type; one that doesn't fit is null, which matches nothing."""
    kind = df.schema[name].dataType.simpleString()
    lit = F.lit(value)
    return lit if value is None or kind == "string" and isinstance(value, str) else lit.cast("string").try_cast(kind)


def compare(df: DataFrame, name: str, op: str, value: Any) -> Column:
    return _COMPARE[op](F.col(name), typed(df, name, value))


def between(df: DataFrame, name: str, low: Any, high: Any) -> Column:
    return F.col(name).between(typed(df, name, low), typed(df, name, high))


def unique(values: Iterable[Any]) -> list[Any]:
    """First of each value, letters in either case taken as equal."""
    seen: dict[Any, Any] = {}
    for v in values:
        seen.setdefault(v.lower() if isinstance(v, str) else v, v)
    return list(seen.values())


def one_of(df: DataFrame, name: str, values: Iterable[Any]) -> Column:
    return F.col(name).isin([typed(df, name, v) for v in unique(values)])


def truth(value: Any) -> bool:
    """Text such as ``0``, ``no`` and ``false`` is false."""
    return str(value).strip().lower() not in ("", "0", "false", "no", "none", "null", "f", "n")


def has_mask(mask: str, value: Any) -> Column:
    return F.col(mask).isNotNull() if truth(value) else F.col(mask).isNull()


def conjunction(parts: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def predicate(df: DataFrame, name: str, value: Any, mask: str | None = None) -> Column:
    """What ``filter(name=value)`` means.

    A list is membership, ``{"between": [a, b]}`` or ``{"in": [a, b]}`` a range, ``{"all": [...]}`` several of these that
    all hold, another mapping operators and operands, None never matches; a name may end in an operator (``area>=``).
    """
    name = name.strip()
    if isinstance(value, Mapping) and "all" in value:
        rest = {k: v for k, v in value.items() if k != "all"}
        return conjunction([predicate(df, name, v, mask) for v in [*value["all"], *([rest] if rest else [])]])
    for op in _COMPARE:
        if name.endswith(op):
            return compare(df, name[: -len(op)].strip(), op, value)
    if name in ("has_mask", "has_masks") and mask and name not in df.columns:
        return has_mask(mask, value)
    if isinstance(value, Mapping):
        return conjunction(between(df, name, *v) if op in ("between", "in") else compare(df, name, op, v) for op, v in value.items())
    if isinstance(value, list | tuple | set):
        return one_of(df, name, value)
    return compare(df, name, "==", value)


def semi_in(df: DataFrame, name: str, values: Iterable[Any]) -> DataFrame:
    """Rows whose value is in a list; a long one is joined (the list is the caller's, so its size is known)."""
    values = unique(values)
    if len(values) <= LONG_LIST:
        return df.filter(one_of(df, name, values))
    keys = df.sparkSession.createDataFrame([(str(v),) for v in values], "__key string")
    keys = keys.select(F.col("__key").try_cast(df.schema[name].dataType.simpleString()).alias("__key")).distinct()
    return df.join(keys, F.col(name) == F.col("__key"), "left_semi")


def present(c: Column) -> Column:
    """The value unless it is a token that stands for a missing one."""
    return F.when(~F.lower(F.trim(c)).isin("none", "null", ""), c)
