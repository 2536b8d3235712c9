"""Ranks, seeded orders, natural order and prefixes on rows that the given tables don't have."""

from __future__ import annotations

import random
import re
from functools import cmp_to_key

import pytest
from pyspark.sql import functions as F

from tessaria.functions.text import natural_key
from tessaria.operators.dataset import Dataset, Profile
from tessaria.operators.joins import first_prefix
from tessaria.operators.ranking import in_ranges, ranked, seeded_order


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(4)
    pick = lambda *values: rng.choice(values)
    rows = [
        (i, pick("PA", "PB", "QX", "P", "", None, "Ä", "pa"), pick(None, float("nan"), float("inf"), -float("inf"), -0.0, 0.0, round(rng.gauss(0, 1), 1)), pick(None, -3, 2**40, -(2**62), 7), pick(None, True, False), f"201{rng.randrange(9)}-0{rng.randrange(1, 9)}-11")
        for i in range(3000)
    ]
    return spark.createDataFrame(rows, "id long, status string, price double, n long, flag boolean, day string").withColumn("day", F.col("day").cast("date")).repartition(7)


@pytest.mark.parametrize(
    "order, sql",
    [
        (lambda: [F.desc_nulls_last("status"), F.asc_nulls_first("price"), F.asc("id")], "status DESC NULLS LAST, price ASC NULLS FIRST, id"),
        (lambda: [F.asc_nulls_last("price"), F.desc_nulls_first("n"), F.desc_nulls_last("flag"), F.asc("status"), F.asc("day"), F.desc("id")], "price ASC NULLS LAST, n DESC NULLS FIRST, flag DESC NULLS LAST, status NULLS FIRST, day, id DESC"),
        (lambda: [F.asc_nulls_first("n"), F.desc("day"), F.asc("id")], "n NULLS FIRST, day DESC, id"),
    ],
)
def test_ranks_over_any_columns(spark, mixed, order, sql):
    import duckdb

    rows = mixed.toPandas()
    # of two zeros neither is less, and NaN is a value
    con = duckdb.connect()
    con.execute("CREATE TABLE t (id BIGINT, status VARCHAR, price DOUBLE, n BIGINT, flag BOOLEAN, day DATE)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?, ?, ?, ?)", [list(r) for r in mixed.collect()])
    want = dict(con.sql(f"SELECT id, row_number() OVER (ORDER BY {sql}) FROM t").fetchall())
    assert {r.id: r.rank for r in ranked(mixed, order()).collect()} == want and len(want) == len(rows)


def test_second_letters_count(spark):
    df = spark.createDataFrame([(1, "PA", 10.0), (2, "PB", 20.0), (3, "PA", 30.0), (4, "PB", 40.0), (5, "QX", 5.0)], "id long, s string, p double")
    assert [r.s for r in ranked(df, [F.desc("s"), F.asc("p")]).orderBy("rank").collect()] == ["QX", "PB", "PB", "PA", "PA"]
    null = spark.createDataFrame([(None,), (1,), (2,), (3,), (4,)], "v long")
    assert [r.v for r in ranked(null, [F.asc("v")]).orderBy("rank").collect()] == [None, 1, 2, 3, 4]
    assert ranked(null.limit(0), [F.asc("v")]).count() == 0


def test_ranges_are_even_even_if_one_key_has_most_rows(spark):
    rows = spark.range(60_000).select("id", F.when(F.col("id") % 5 < 3, F.lit("ZZ")).otherwise(F.col("id").cast("string")).alias("key"), F.lit(None).cast("long").alias("none"))
    for order in ([F.asc("key")], [F.desc("none")], [F.asc("none"), F.desc("key"), F.asc("id")]):
        sizes = sorted(r["count"] for r in in_ranges(rows, order).groupBy(F.shiftright("__at", 33)).count().collect())
        assert len(sizes) == 4 and sizes[-1] <= 3 * sizes[len(sizes) // 2]
    got = ranked(rows, [F.asc("key")])
    assert got.select("rank").distinct().count() == 60_000 == got.agg(F.max("rank")).first()[0]
    assert got.filter("key = 'ZZ'").agg(F.min("rank")).first()[0] == 24_001


def test_seeded_order_of_any_id(spark):
    low = spark.range(2000).select((F.col("id") * 104_729).alias("id"))
    k, own = seeded_order(F.col("id"), 42)
    assert all(r.k == (r.id * 1103515245 + 42) & 0x7FFFFFFF for r in low.select("id", k.alias("k")).collect())
    ids = [9_000_000_000, 2**31, 2**31 + 5, 5, 2**62, 2**63 - 1, -1, -(2**63), 2**33 + 5, 0]
    high = spark.createDataFrame([(i,) for i in ids], "id long")
    got = high.select("id", k.alias("k")).collect()
    assert all(0 <= r.k < 2**31 for r in got) and len({(r.k, r.id) for r in got}) == len(ids)
    # ids with equal low bits don't stay together
    far = spark.range(4000).select((F.col("id") * 2**31 + 77).alias("id"))
    assert far.select(k.alias("k")).distinct().count() > 3990
    chosen = far.orderBy(k, own).limit(400).agg(F.avg(F.col("id") / 2**31)).first()[0]
    assert 1600 < chosen < 2400
    d = Dataset(high, Profile("t", "id"))
    assert d.sample_seeded(4, seed=-7).all().count() == 4 and [r.id for r in d.sample_seeded(4, seed=3).all().collect()] == [r.id for r in d.sample_seeded(4, seed=3).all().collect()]


NAMES = ["s1234567890129", "s1234567890121", "a1", "a b1", "a01", "a1b", "A2", "a10", "a", "", "7", "07x", "10", "x" + "9" * 30, "x1" + "0" * 30, "x" + "9" * 29 + "8", "x\0" + "1", "x\0", "x", "é2", "é10", "v1.10.2", "v1.9.3", "v1.9", "00", "0"]


def test_natural_order(spark):
    parts = lambda s: [int(p) if k % 2 else p.encode() for k, p in enumerate(re.split("([0-9]+)", s.lower()))]
    less = lambda a, b: (parts(a) > parts(b)) - (parts(a) < parts(b)) or (a > b) - (a < b)
    rows = spark.createDataFrame([(n,) for n in NAMES * 2], "name string").withColumn("key", natural_key(F.col("name")))
    got = [r.name for r in ranked(rows, [F.col("key"), F.col("name")]).orderBy("rank").collect()]
    assert got == sorted(NAMES * 2, key=cmp_to_key(less))


def test_prefixes(spark):
    rows = spark.createDataFrame([(1, "task_a_001", {"x": 1}), (1, "task_a_001", {"x": 1}), (2, "task_ab", None), (3, "none", None), (4, "", None), (5, None, None), (6, "task_a", None)], "id int, stem string, more map<string,int>")
    listed = spark.createDataFrame([("task_a", 3), ("task_ab", 9), ("task_a_0", 1), ("zz", 0), ("task_a", 7)], "prefix string, place int")
    got = first_prefix(rows, "stem", listed, "prefix", "place", "task")
    assert sorted((r.id, r.task) for r in got.collect()) == [(1, "task_a_0"), (1, "task_a_0"), (2, "task_a"), (6, "task_a")]
    assert got.columns == ["id", "stem", "more", "task"]
    every = listed.unionByName(spark.createDataFrame([("", 2)], "prefix string, place int"))
    assert sorted((r.id, r.task) for r in first_prefix(rows, "stem", every, "prefix", "place", "task").collect()) == [(1, "task_a_0"), (1, "task_a_0"), (2, ""), (3, ""), (4, ""), (6, "")]


def test_filters_on_one_key_all_count(spark):
    df = spark.createDataFrame([(i, i * 10) for i in range(20)], "id int, area int")
    d = Dataset(df, Profile("t", "id"))
    ids = lambda x: sorted(r.id for r in x.all().collect())
    two = d.filter(area={"between": [20, 100]}).filter(area={"between": [80, 150]})
    assert ids(two) == [8, 9, 10]
    assert ids(two.filter(area=[80, 20])) == [8] and ids(d.filter(area=[80, 20]).filter(area={">": 20})) == [8]
    assert ids(d.filter(area=10).filter(area=20)) == [1, 2]
    from tessaria.operators.dataset import from_spec

    again = from_spec(df, d.profile, two.filter(area={"<": 100}).to_json())
    assert ids(again) == [8, 9]
