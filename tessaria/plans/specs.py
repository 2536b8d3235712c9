"""Query specs as data: logged, replayed, summarised and compared."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dataset import Dataset, Profile, from_spec
from ..operators.ranking import md5_key, seeded_order
from ..sources.versions import Versions

#: One row of the log; nested values are text, so that specs of any shape share a schema.
SCHEMA = "spec_id string, profile string, filters string, raw string, projection string, sort string, limit_n long, offset_n long, sample string"


def row(spec_id: str, spec: Mapping[str, Any]) -> tuple:
    text = lambda k: json.dumps(spec.get(k) or ({} if k in ("filters", "sample") else []), sort_keys=True)
    return (spec_id, spec["profile"], text("filters"), text("raw"), text("projection"), text("sort"), spec.get("limit"), spec.get("offset"), text("sample"))


def log(spark: SparkSession, specs: Mapping[str, Mapping[str, Any]], path: str) -> None:
    """Commit a row for each spec: all of them or, if the job is stopped, none."""
    Versions(spark, path).append(spark.createDataFrame([row(k, v) for k, v in specs.items()], SCHEMA))


def load(spark: SparkSession, path: str) -> DataFrame:
    """The log as it is now; empty before the first spec."""
    return Versions(spark, path).read(schema=T.StructType.fromDDL(SCHEMA))


def replay(source: DataFrame, profile: Profile, logged: Mapping[str, Any]) -> Dataset:
    """A Dataset from one row of the log."""
    spec = {k: json.loads(logged[k]) for k in ("filters", "raw", "projection", "sort", "sample")}
    return from_spec(source, profile, spec | {"limit": logged["limit_n"], "offset": logged["offset_n"]})


def summaries(log: DataFrame) -> DataFrame:
    parts = [
        F.when(F.col("filters") != "{}", F.concat(F.lit("filters="), F.col("filters"))),
        F.when(F.col("raw") != "[]", F.concat(F.lit("where="), F.col("raw"))),
        F.when(F.col("sample") != "{}", F.concat(F.lit("sample="), F.get_json_object("sample", "$.strategy"))),
        F.when(F.col("limit_n").isNotNull(), F.concat(F.lit("limit="), F.col("limit_n").cast("string"))),
    ]
    return log.select("spec_id", "profile", fingerprint().alias("fingerprint"), F.concat_ws("; ", *parts).alias("summary"))


def fingerprint():
    """Eight hex digits of what a spec asks for, whatever its name."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("profile", "filters", "raw", "projection", "sort", "limit_n", "offset_n", "sample")]
    return F.left(F.md5(F.concat_ws("|", *parts)), F.lit(8))


def differences(log: DataFrame) -> DataFrame:
    """For each two specs of a profile the parts in which they differ; nulls are equal to each other."""
    parts = ["filters", "raw", "sample", "limit_n", "sort"]
    flat = log.select("spec_id", "profile", *(F.col(p).cast("string").alias(p) for p in parts)).unpivot(["spec_id", "profile"], parts, "part", "value")
    a, b = flat.alias("a"), flat.alias("b")
    met = a.join(b, (F.col("a.profile") == F.col("b.profile")) & (F.col("a.part") == F.col("b.part")) & (F.col("a.spec_id") < F.col("b.spec_id")))
    return met.filter(~F.col("a.value").eqNullSafe(F.col("b.value"))).select(F.col("a.spec_id").alias("left_spec"), F.col("b.spec_id").alias("right_spec"), F.col("a.part").alias("part"), F.col("a.value").alias("left_value"), F.col("b.value").alias("right_value"))


#: Keys of a spec that say where and when it ran, not what it asks for; fixed values.
VOLATILE = ("working_dir", "runtime", "paths")


def nesting(text: Column) -> Column:
    """How deep objects and arrays of a JSON text lie in each other; brackets inside strings don't count."""
    brackets = F.regexp_replace(F.regexp_replace(text, r'"(\\.|[^"\\])*"', ""), r"[^\[\]{}]", "")
    start = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def deeper(at: Column, x: Column) -> Column:
        now = at["now"] + F.when(x.isin("[", "{"), 1).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(at["most"], now).alias("most"))

    return F.aggregate(F.filter(F.split(brackets, ""), lambda x: x != ""), start, deeper)["most"]


def canonical(value: Column, depth: int, without: Iterable[str] = VOLATILE) -> Column:
    """A variant as JSON in one form: keys of objects sorted, no spaces, and none of the keys ``without``, down to ``depth`` levels.

    A variant holds the fields of an object in the order of their names already.
    """
    if depth < 1:
        return F.to_json(value)
    name = lambda k: F.concat(F.btrim(F.to_json(F.array(k)), F.lit("[]")), F.lit(":"))  # noqa: E731  quoted and escaped

    def inside(held: Column) -> Column:
        fields = F.transform(F.filter(F.map_entries(held["fields"]), lambda e: ~e["key"].isin(*without)), lambda e: F.struct(name(e["key"]).alias("k"), e["value"].alias("v")))
        items = F.transform(held["items"], lambda x: F.struct(F.lit("").alias("k"), x.alias("v")))
        parts = F.array_join(F.transform(F.coalesce(fields, items), lambda e: F.concat(e["k"], canonical(e["v"], depth - 1, without))), ",")
        return F.when(held["fields"].isNotNull(), F.concat(F.lit("{"), parts, F.lit("}"))).when(held["items"].isNotNull(), F.concat(F.lit("["), parts, F.lit("]")))

    held = F.struct(F.try_variant_get(value, "$", "map<string,variant>").alias("fields"), F.try_variant_get(value, "$", "array<variant>").alias("items"))
    return F.coalesce(F.element_at(F.transform(F.array(held), inside), 1), F.to_json(value))  # bound by the array, it is made once


def with_fingerprints(rows: DataFrame, spec: str, name: str = "fingerprint", digits: int = 8) -> DataFrame:
    """``rows`` plus a fingerprint of what the JSON in ``spec`` asks for: volatile keys play no part, at any depth, nor does order.

    The texts' depth is found in a pass over them first, and the expression made for it. Numbers count by value (1.50 is
    1.5). Null where the text is null, is no JSON, or names a key twice in one object.
    """
    depth = rows.agg(F.max(nesting(F.col(spec))).alias("n")).first()["n"] or 0
    return rows.withColumn(name, F.left(F.md5(canonical(F.try_parse_json(spec), depth)), F.lit(digits)))


def _tagged(source: DataFrame, data: Mapping[str, Dataset]) -> DataFrame:
    """Each row once for each spec whose filters it passes, in one pass over the source."""
    tests = [F.when(d.condition() if d.filters or d.raw else F.lit(True), F.lit(k)) for k, d in data.items()]
    return source.withColumn("spec_id", F.explode(F.filter(F.array(*tests), lambda x: x.isNotNull())))


def _sized(d: Dataset) -> tuple[list[Column], list[tuple[Column, bool]], int, int]:
    """Groups, order (each with whether it descends), and how many rows of each group are skipped and taken."""
    how, key = d.sampling.get("strategy"), F.col(d.profile.id_col)
    if how in ("random", "seeded"):
        keys = [F.rand()] if how == "random" else seeded_order(key, d.sampling["seed"])
        return [], [(c, False) for c in keys], 0, d.sampling.get("n") or d.size or 100
    if how == "stratified":
        seed = d.sampling.get("seed")
        keys = [F.rand()] if seed is None else [md5_key(seed, d.profile.id_col), key]
        return [F.col(c) for c in d.sampling["by"]], [(c, False) for c in keys], 0, d.sampling["per_group"]
    return [], [*((F.col(c), way == "desc") for c, way in d.order), (key, False)], d.skip or 0, d.size


def _own(k: str, c: Column) -> Column:
    """An order or group that only rows of one spec have."""
    return F.when(F.col("spec_id") == k, c)


def batch(source: DataFrame, profile: Profile, specs: Mapping[str, Mapping[str, Any]]) -> DataFrame:
    """The rows of several specs, tagged by spec; columns that a spec didn't ask for are null.

    One pass tags the rows with all specs that have a sample or a limit and one window ranks them, of which each task
    keeps the first rows alone before the shuffle; one pass more gives those that take all that passes. Pages of a
    stratified sample, which need two orders, and offsets without a limit are made one by one.
    """
    data = {k: from_spec(source, profile, s) for k, s in specs.items()}
    paged = {k: d for k, d in data.items() if (d.size is not None or d.skip) and d.sampling.get("strategy") == "stratified" or d.skip and d.size is None and not d.sampling}
    sized = {k: d for k, d in data.items() if k not in paged and (d.sampling or d.size is not None)}
    whole = {k: d for k, d in data.items() if k not in paged and k not in sized}
    wanted = {k: [profile.id_col, *d.columns] if d.columns else source.columns for k, d in data.items()}
    names = [c for c in source.columns if any(c in w for w in wanted.values())]
    parts = []
    if sized:
        groups, order, limits, most = [F.col("spec_id")], [], F.lit(False), 0
        for k, d in sized.items():
            by, keys, skip, size = _sized(d)
            groups += [_own(k, c) for c in by]
            order += [_own(k, c).desc_nulls_last() if down else _own(k, c).asc_nulls_first() for c, down in keys]
            limits = limits | ((F.col("spec_id") == k) & (F.col("__rank") > skip) & (F.col("__rank") <= skip + size))
            most = max(most, skip + size)
        ranked = _tagged(source, sized).withColumn("__rank", F.row_number().over(Window.partitionBy(*groups).orderBy(*order)))
        parts.append(ranked.filter(F.col("__rank") <= most).filter(limits))
    if whole:
        parts.append(_tagged(source, whole))
    parts += [d.all().withColumn("spec_id", F.lit(k)) for k, d in paged.items()]
    held = lambda df: df.select(*(F.when(F.col("spec_id").isin([k for k, w in wanted.items() if c in w]), F.col(c)).alias(c) for c in names if c in df.columns), "spec_id")
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), map(held, parts))
