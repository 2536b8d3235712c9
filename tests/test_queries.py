"""Every registered query of the engine against its SQL on the small tables, and invariants where there is none."""

from __future__ import annotations

import math
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tessaria import plans

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(rows) -> list[str]:
    def value(v):
        if v is None or v != v:
            return None
        if isinstance(v, bool):
            return v
        if isinstance(v, int | float):
            return round(float(v), 6) + 0.0
        return str(v)

    return sorted(str(tuple(value(v) for v in r)) for r in rows)


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_against_sql(name, spark, duck):
    got = plans.QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    want = duck.sql(plans.SQL[name])
    assert columns == sorted(want.columns)
    rows = got.select(*(f"`{c}`" for c in columns)).collect()
    assert plain(rows) == plain(want.project(", ".join(f'"{c}"' for c in columns)).fetchall())


def test_random_and_stratified_samples(spark):
    orders = spark.read.parquet(f"{DATA}/orders.parquet")
    some = plans.QUERIES["sample_random"](spark, DATA).collect()
    assert len(some) == min(100, orders.filter("o_orderstatus = 'O'").count()) and all(r.o_orderstatus == "O" for r in some)
    groups = plans.QUERIES["sample_stratified"](spark, DATA).groupBy("o_orderpriority").count().collect()
    assert all(r["count"] == 10 for r in groups)


def test_manifest_append(spark):
    rows = plans.QUERIES["manifest_append"](spark, DATA)
    assert rows.count() == rows.select("record_id").distinct().count() == spark.read.parquet(f"{DATA}/labels.parquet").count()


def test_listing_and_images(spark):
    assert plans.QUERIES["list_files"](spark, DATA).count() == spark.read.parquet(f"{DATA}/embeddings.parquet").count()


def test_specs_in_one_pass_equal_specs_one_by_one(spark):
    from tessaria.plans import specs
    from tessaria.plans.selecting import SPECIMEN, specimens

    s = specimens(spark, DATA)
    asked = {
        "page": s.filter(o_orderstatus="F").sort("o_totalprice", "desc").offset(5).limit(7).spec(),
        "skip": s.filter({"o_orderkey<": 300}).offset(20).spec(),
        "seeded": s.sample_seeded(11, seed=3).spec(),
        "strata": s.select("o_orderstatus").sample_stratified(["o_orderstatus", "o_orderpriority"], 2, seed=4).spec(),
        "paged strata": s.sample_stratified(["o_orderstatus"], 9, seed=4).offset(3).limit(12).spec(),
        "all": s.where("o_totalprice > 300000").select("o_totalprice").spec(),
        "none": s.filter(o_orderstatus="nothing").limit(3).spec(),
    }
    found = specs.batch(s.source, SPECIMEN, asked).collect()
    for name, spec in asked.items():
        want = specs.from_spec(s.source, SPECIMEN, spec).all()
        assert plain([tuple(r[c] for c in want.columns) for r in found if r.spec_id == name]) == plain(want.collect()), name
        assert all(r[c] is None for r in found if r.spec_id == name for c in r.asDict() if c not in (*want.columns, "spec_id"))


def test_fingerprints_of_specs(spark):
    import hashlib
    import json

    from pyspark.sql import functions as F

    from tessaria.plans import specs

    def plain(x):
        if isinstance(x, dict):
            return {k: plain(v) for k, v in x.items() if k not in specs.VOLATILE}
        return [plain(v) for v in x] if isinstance(x, list) else x

    known = [
        {"runtime": {"at": 1}, "query": {"limit": 3, "paths": ["x"], "by": ["b", "a"]}, "working_dir": "/a"},
        {"query": {"by": ["b", "a"], "limit": 3}},
        {"query": {"by": ["a", "b"], "limit": 3}},
        {"deep": [[{"a": [1, {"runtime": 2, "b": [], "c": {}, "paths": {"d": 1}}]}, "]}{[", 'q"\\'], None, True], "é": "ü {", 'k"': None},
        [],
        {},
        [{"runtime": 1}, 5, "text"],
        "text",
        7,
    ]
    texts = [json.dumps(x, indent=k % 3) for k, x in enumerate(known)]
    df = spark.createDataFrame([*enumerate(texts), (100, None), (101, "{bad"), (102, '{"a":1,"a":2}')], "i int, spec string").repartition(3)
    found = specs.with_fingerprints(df, "spec")
    assert "Python" not in found._jdf.queryExecution().toString() and "Arrow" not in found._jdf.queryExecution().toString()
    got = {r.i: r.fingerprint for r in found.collect()}
    want = {i: hashlib.md5(json.dumps(plain(x), sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()[:8] for i, x in enumerate(known)}
    assert got == want | {100: None, 101: None, 102: None}
    assert got[0] == got[1] != got[2]
    assert [r.n for r in spark.createDataFrame([('{"a":[[]]}',), ('"[[["',), ('{"\\"{":[1]}',), ("3",)], "t string").select(specs.nesting(F.col("t")).alias("n")).collect()] == [3, 0, 2, 0]
    assert specs.with_fingerprints(df.limit(0), "spec").count() == 0


def test_keys_that_very_many_ask_for_are_dealt_evenly(spark, monkeypatch):
    """Rows of a hot key and rows without a key don't meet in one task; each row comes back once, with the greatest entry."""
    from tessaria.operators import joins as j

    monkeypatch.setattr(j, "HOT", 500)
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        dim = spark.createDataFrame([(1, "a"), (2, "A"), (3, "b"), (4, None)], "e long, name string")
        key = F.when(F.col("id") % 10 < 4, "a").when(F.col("id") % 10 < 5, "nobody").when(F.col("id") % 10 < 6, F.col("id").cast("string")).when(F.col("id") % 1000 == 9, "B")
        wanted = spark.range(0, 8000, 1, 8).select("id", F.when(F.col("id") % 10 == 8, "other").otherwise("name").alias("kind"), key.alias("key"), F.create_map(F.lit("m"), "id").alias("map"))
        met = j.by_any_key(wanted, dim, {"name": (F.col("name"), F.upper)}, "e")
        tasks = met.groupBy(F.spark_partition_id().alias("p")).count().collect()
        got = {r.id: (r.e, r.kind, r.key) for r in met.collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert met.columns == ["id", "kind", "key", "map", "e"] and sum(r["count"] for r in tasks) == len(got) == 8000
    assert got == {r.id: ({"a": 2, "B": 3}.get(r.key) if r.kind == "name" else None, r.kind, r.key) for r in wanted.collect()}
    assert max(r["count"] for r in tasks) < 2000


def test_medians(spark, monkeypatch):
    import statistics as st

    import numpy as np

    from tessaria.operators import stats

    rng = np.random.default_rng(5)
    rows = [(g, float(v)) for g, n in (("a", 1000), ("b", 1), ("c", 2), (None, 7), ("d", 501)) for v in rng.choice([rng.normal(), 3.0, 3.0, rng.normal() * 50], n)]
    rows += [("e", None), ("a", None), *(("many", float(v)) for v in rng.normal(size=800))]
    df = spark.createDataFrame(rows, "g string, v double")
    values = {g: [v for k, v in rows if k == g and v is not None] for g in ("a", "b", "c", None, "d", "many", "e")}
    want = {g: (st.median(vs) if vs else None, len(vs)) for g, vs in values.items()}
    from pyspark.sql import functions as F

    for most in (10**6, 500, 2, 1):  # all by merged runs, the large groups by ranges, by ranges within ranges
        monkeypatch.setattr(stats, "MANY_VALUES", most)
        got = {r.g: (r.med, r.n) for r in stats.summaries(df, ["g"], "v", F.count("v").alias("n")).collect()}
        assert got.keys() == want.keys() and all(got[g][1] == n and got[g][0] == (None if m is None else pytest.approx(m)) for g, (m, n) in want.items())
        assert stats.summaries(df, [], "v").first().med == pytest.approx(st.median([v for _, v in rows if v is not None]))
    assert [r.med for r in stats.summaries(df.filter("g = 'e'"), ["g"], "v").collect()] == [None]
    assert stats.summaries(df.limit(0), ["g"], "v").count() == 0


@pytest.mark.parametrize("value,want", [("the art of war", "The Art of War"), ("what for", "What For"), ("l. (AND) x", "L. (and) X"), ("o'neil  to-day", "O'Neil To-Day")])
def test_titles(spark, value, want):
    from pyspark.sql import functions as F

    from tessaria.functions.text import title

    assert spark.createDataFrame([(value,)], "t string").select(title(F.col("t")).alias("x")).first().x == want


def test_specs(spark):
    log = {r.spec_id: r for r in plans.QUERIES["spec_log"](spark, DATA).collect()}
    assert set(log) == {"a", "b", "c"} and log["b"].n_rows == min(30, log["b"].n_rows)
    assert plans.QUERIES["spec_summary"](spark, DATA).count() == 3
    parts = {(r.left_spec, r.right_spec, r.part) for r in plans.QUERIES["spec_compare"](spark, DATA).collect()}
    assert ("a", "b", "limit_n") in parts and ("a", "b", "sample") in parts


def test_pages_make_up_the_whole(spark):
    from tessaria.plans.selecting import specimens

    s = specimens(spark, DATA).sort("o_totalprice", "desc")
    pages = [r.o_orderkey for k in range(0, 200, 50) for r in s.offset(k).limit(50).all().collect()]
    assert pages == [r.o_orderkey for r in s.limit(200).all().collect()]
    assert s.count() == s.all().count()


def test_builder_is_immutable(spark):
    from tessaria.operators.dataset import from_spec
    from tessaria.plans.selecting import SPECIMEN, specimens

    base = specimens(spark, DATA).filter(o_orderstatus="F")
    more = base.filter(o_orderstatus="O").select("o_totalprice")
    assert base.filters == (("o_orderstatus", "F"),) and dict(more.filters)["o_orderstatus"] == ["F", "O"]
    again = from_spec(base.source, SPECIMEN, more.to_json())
    assert again.to_json() == more.to_json() and again.count() == more.count()
    with pytest.raises(ValueError):
        base.sort("nope")


def test_literals_take_the_type_of_the_column(spark):
    from tessaria.operators.dataset import Dataset, Profile

    df = spark.createDataFrame([(1, "NC", 1.0), (2, "007", None), (3, "7", 2.0), (4, None, 3.0), (5, "a,b", 4.0), (6, "x in y", 5.0)], "id int, t string, v double")
    d = Dataset(df, Profile("t", "id"))
    ids = lambda x: sorted(r.id for r in x.all().collect())
    assert ids(d.filter(t="007")) == [2] and ids(d.filter(t=7)) == [3] and ids(d.filter(t=None)) == []
    assert ids(d.filter(v="abc")) == [] and ids(d.filter({"v>=": "2"})) == [3, 4, 5, 6]
    assert ids(d.filter(t="x in y")) == [6] and ids(d.filter(t=["nc", "NC", "a,b"])) == [5]
    assert ids(d.filter(v={"between": [2, 3]})) == [3, 4]


@pytest.mark.parametrize("value,want", [("[245, 180, 120, 95]", [245, 180, 120, 95]), ("(1,2.5,3.5,4)", [1, 2, 4, 4]), ("[1,2,3]", [0] * 4), ("junk", [0] * 4), (None, [0] * 4)])
def test_boxes(spark, value, want):
    from pyspark.sql import functions as F

    from tessaria.functions.text import box

    assert spark.createDataFrame([(value,)], "b string").select(box(F.col("b")).alias("x")).first().x == want


def test_sizes_and_tiles(spark):
    from pyspark.sql import functions as F

    from tessaria.functions import raster

    sizes = [(1500, 1000), (2048, 2048), (3000, 2000), (5120, 100), (8000, 6000)]
    df = spark.createDataFrame(sizes, "w int, h int")
    assert [r.c for r in df.select(raster.size_class(F.col("w"), F.col("h")).alias("c")).collect()] == ["pad", "resize", "pad", "pad", "grid"]
    tiles = raster.overlap_tiles(df.withColumn("image", F.col("w")), 512, 0.25).groupBy("w", "h").agg(F.count("*").alias("n"), F.max("x1").alias("x"), F.max("y1").alias("y")).collect()
    for r in tiles:
        assert r.n == (1 + math.ceil(max(r.w - 512, 0) / 384)) * (1 + math.ceil(max(r.h - 512, 0) / 384)) and r.x >= r.w and r.y >= r.h


def test_ranks_cover_each_place_once(spark):
    from tessaria.operators.ranking import shuffled_rank

    df = spark.range(5000).toDF("id")
    got = sorted(r.rank for r in shuffled_rank(df, "id", 3).collect())
    assert got == list(range(1, 5001))
