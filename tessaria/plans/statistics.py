"""Queries on counts, metrics and the published statistics."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.text import season
from ..operators import stats as s

from .registry import query, table
from .selecting import BINS, size_bin, specimens



def n(name: str = "n") -> Column:
    return F.count("*").alias(name)


@query("SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 200000")
def count_filtered(spark, d):
    wanted = specimens(spark, d).filter({"o_orderstatus": "F", "o_totalprice>": 200000})
    return wanted.source.filter(wanted.condition()).agg(n())


@query("SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_totalprice > 100000 GROUP BY 1")
def count_by_group(spark, d):
    return specimens(spark, d).filter({"o_totalprice>": 100000}).all().groupBy("o_orderpriority").agg(n())


@query("SELECT count(*) AS scanned, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS returned, CAST(sum(CASE WHEN o_totalprice < 1000 THEN 1 ELSE 0 END) AS BIGINT) AS invalid FROM orders")
def query_counters(spark, d):
    """Counters come with the one pass that reads the rows."""
    seen = Observation("query")
    rows = table(spark, d, "orders").observe(seen, F.count("*").alias("scanned"), F.count_if(F.col("o_orderstatus") == "F").alias("returned"), F.count_if(F.col("o_totalprice") < 1000).alias("invalid"))
    rows.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([tuple(seen.get[k] for k in ("scanned", "returned", "invalid"))], "scanned long, returned long, invalid long")


@query("""SELECT coalesce(lang, 'total') AS task, count(*) AS files, CAST(sum(CASE WHEN n_chars < 500 THEN 1 ELSE 0 END) AS BIGINT) AS skipped, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY ROLLUP (lang)""")
def task_stats(spark, d):
    docs = table(spark, d, "documents").rollup("lang").agg(n("files"), F.count_if(F.col("n_chars") < 500).alias("skipped"), F.sum("n_chars").alias("chars"))
    return docs.select(F.coalesce("lang", F.lit("total")).alias("task"), "files", "skipped", "chars")


METRICS_SQL = "SELECT count(*) FILTER (event_type <> 'error') AS processed, count(*) FILTER (event_type = 'view') AS skipped, count(*) FILTER (event_type = 'error') AS failed, round(coalesce(avg(value) FILTER (event_type <> 'error'), 0), 4) AS avg_ms FROM events"


@query(METRICS_SQL)
def stage_metrics(spark, d):
    return s.stage_metrics(table(spark, d, "events"))


@query("SELECT lang AS status, count(*) AS tasks, count(DISTINCT source) AS projects, max(n_chars) AS largest FROM documents GROUP BY 1")
def task_outcomes(spark, d):
    return table(spark, d, "documents").groupBy(F.col("lang").alias("status")).agg(n("tasks"), F.countDistinct("source").alias("projects"), F.max("n_chars").alias("largest"))


@query("""WITH c AS (SELECT sum(CASE WHEN quality = 1 AND toxic = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END) AS fp, sum(CASE WHEN quality = 0 AND toxic = 1 THEN 1 ELSE 0 END) AS fn FROM labels)
SELECT round(tp / (tp + fp + fn)::DOUBLE, 6) AS iou, round(2 * tp / (2 * tp + fp + fn)::DOUBLE, 6) AS dice FROM c""")
def iou_dice(spark, d):
    return s.overlap_scores(table(spark, d, "labels"), "quality", "toxic")


@query("""WITH x AS (SELECT 1 / (1 + exp(-unnest(embedding)::DOUBLE)) AS p, (label % 2)::DOUBLE AS y FROM embeddings) SELECT round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 6) AS bce FROM x""")
def bce_loss(spark, d):
    """Each component is a pixel's logit, all pixels of an image have the class of its label."""
    logits = table(spark, d, "embeddings").select(F.explode(F.col("embedding").cast("array<double>")).alias("z"), (F.col("label") % 2).cast("double").alias("y"))
    return logits.select((1 / (1 + F.exp(-F.col("z")))).alias("p"), "y").agg(F.round(F.avg(s.cross_entropy("p", "y")), 6).alias("bce"))


@query("""SELECT count(*) AS records, count(DISTINCT o_custkey) AS images, count(DISTINCT o_orderpriority) AS species, count(DISTINCT o_orderstatus) AS states,
round(100.0 * count(*) FILTER (o_orderstatus <> 'F') / count(*), 2)::DOUBLE AS pct_masked, CAST(min(o_orderdate) AS DATE)::VARCHAR AS first_day, CAST(max(o_orderdate) AS DATE)::VARCHAR AS last_day FROM orders""")
def stats_overview(spark, d):
    day = lambda c: F.date_format(c, "yyyy-MM-dd")
    return table(spark, d, "orders").agg(
        n("records"),
        F.countDistinct("o_custkey").alias("images"),
        F.countDistinct("o_orderpriority").alias("species"),
        F.countDistinct("o_orderstatus").alias("states"),
        F.round(100.0 * F.count_if(F.col("o_orderstatus") != "F") / F.count("*"), 2).alias("pct_masked"),
        day(F.min("o_orderdate")).alias("first_day"),
        day(F.max("o_orderdate")).alias("last_day"),
    )


@query("SELECT p_type, count(DISTINCT p_name) AS species, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 4)::DOUBLE AS pct FROM part GROUP BY 1")
def stats_category_pct(spark, d):
    return s.with_share(table(spark, d, "part").groupBy("p_type").agg(F.countDistinct("p_name").alias("species"), n()))


TOP_SQL = """WITH c AS (SELECT {key} AS name, count(*) AS n, {more} FROM {t} GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, name) AS rk FROM c)
SELECT CASE WHEN rk <= {k} THEN name ELSE 'Other' END AS name, CAST(sum(n) AS BIGINT) AS n, {agg}, count(*) AS members FROM r GROUP BY 1"""


@query(TOP_SQL.format(key="p_name", t="part", k=20, more="max(p_size) AS m", agg="max(m) AS m"))
def stats_topn_other(spark, d):
    counts = table(spark, d, "part").groupBy(F.col("p_name").alias("name")).agg(n(), F.max("p_size").alias("m"))
    return s.top_and_other(counts, 20).groupBy("name").agg(F.sum("n").alias("n"), F.max("m").alias("m"), n("members"))


@query("SELECT round(min(o_totalprice), 2) AS lo, round(avg(o_totalprice), 2) AS mean, round(median(o_totalprice), 2) AS med, round(max(o_totalprice), 2) AS hi FROM orders")
def stats_area_summary(spark, d):
    c, rows = "o_totalprice", table(spark, d, "orders").select("o_totalprice")
    whole = s.summaries(rows, [], c, F.round(F.min(c), 2).alias("lo"), F.round(F.avg(c), 2).alias("mean"), F.round(F.max(c), 2).alias("hi"))
    return whole.select("lo", "mean", F.round("med", 2).alias("med"), "hi")


@query(f"SELECT {BINS} AS bin, count(*) AS n, round(avg(o_totalprice), 2) AS mean, round(100.0 * count(*) / sum(count(*)) OVER (), 4)::DOUBLE AS pct FROM orders GROUP BY 1")
def stats_size_bins(spark, d):
    binned = table(spark, d, "orders").groupBy(size_bin().alias("bin")).agg(n(), F.round(F.avg("o_totalprice"), 2).alias("mean"))
    return s.with_share(binned)


@query("SELECT p_type, round(avg(l_quantity), 4) AS mean, median(l_quantity) AS med, round(stddev_samp(l_quantity), 4) AS std FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def stats_area_by_category(spark, d):
    joined = lines_with_part(spark, d).select("p_type", "l_quantity")
    found = s.summaries(joined, ["p_type"], "l_quantity", F.round(F.avg("l_quantity"), 4).alias("mean"), F.round(F.stddev_samp("l_quantity"), 4).alias("std"))
    return found.select("p_type", "mean", "med", "std")


def lines_with_part(spark, d) -> DataFrame:
    part = table(spark, d, "part")
    return table(spark, d, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))


@query("""WITH j AS (SELECT p_name, l_quantity, CASE WHEN l_quantity < 15 THEN 'small' WHEN l_quantity < 35 THEN 'medium' ELSE 'large' END AS bin FROM lineitem JOIN part ON l_partkey = p_partkey),
b AS (SELECT p_name, bin, row_number() OVER (PARTITION BY p_name ORDER BY count(*) DESC, bin) AS rk FROM j GROUP BY 1, 2)
SELECT p_name, count(*) AS n, round(avg(l_quantity), 4) AS mean, median(l_quantity) AS med, min(l_quantity) AS lo, max(l_quantity) AS hi, any_value(b.bin) AS modal FROM j JOIN b USING (p_name) WHERE b.rk = 1 GROUP BY 1""")
def stats_species_sizes(spark, d):
    """The most frequent of three sizes (of equals the first by name) comes from three counts, so one shuffle does for all."""
    q, rows = F.col("l_quantity"), lines_with_part(spark, d).select("p_name", "l_quantity")
    bins = {"large": q >= 35, "medium": (q >= 15) & (q < 35), "small": q < 15}
    sizes = F.array(*(F.struct((-F.count_if(test)).alias("k"), F.lit(name).alias("bin")) for name, test in bins.items()))
    return s.summaries(rows, ["p_name"], "l_quantity", n(), F.round(F.avg(q), 4).alias("mean"), F.min(q).alias("lo"), F.max(q).alias("hi"), F.array_min(sizes)["bin"].alias("modal"))


@query("""WITH c AS (SELECT o_orderstatus AS state, o_orderpriority AS sp, count(*) AS k FROM orders GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY state ORDER BY k DESC, sp) AS rk FROM c)
SELECT state, CAST(sum(k) AS BIGINT) AS n, round(100.0 * sum(k) / sum(sum(k)) OVER (), 4)::DOUBLE AS pct, string_agg(sp, '|' ORDER BY rk) FILTER (rk <= 3) AS top3 FROM r GROUP BY 1""")
def stats_state_top3(spark, d):
    counts = table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("state"), F.col("o_orderpriority").alias("sp")).agg(n("k"))
    rk = F.row_number().over(Window.partitionBy("state").orderBy(F.desc("k"), "sp"))
    top = F.array_sort(F.collect_list(F.when(F.col("rk") <= 3, F.struct("rk", "sp"))))
    states = counts.withColumn("rk", rk).groupBy("state").agg(F.sum("k").alias("n"), F.array_join(F.transform(top, lambda x: x["sp"]), "|").alias("top3"))
    return s.with_share(states).select("state", "n", "pct", "top3")


@query("""WITH c AS (SELECT o_orderstatus AS state, o_orderpriority AS sp, count(*) AS k FROM orders GROUP BY 1, 2), t AS (SELECT state, sum(k) AS total FROM c GROUP BY 1), a AS (SELECT count(DISTINCT o_orderpriority) AS every FROM orders),
p AS (SELECT state, sp, k, k / total::DOUBLE AS p FROM c JOIN t USING (state))
SELECT state, count(*) AS species, round(count(*) / any_value(every)::DOUBLE * (-sum(p * ln(p)) / ln(count(*))), 6) AS richness, arg_max(sp, k * 1000 - ascii(sp)) AS dominant FROM p, a GROUP BY 1""")
def stats_richness(spark, d):
    return s.richness(table(spark, d, "orders"), "o_orderstatus", "o_orderpriority")


TIERS = {"l_discount": (0.02, 0.05, 0.08), "l_tax": (0.02, 0.04, 0.06), "l_quantity": (10, 25, 40)}


@query("WITH t AS (" + " UNION ALL ".join(f"SELECT '{c}' AS metric, CASE WHEN {c} < {a} THEN 'excellent' WHEN {c} < {b} THEN 'good' WHEN {c} < {x} THEN 'fair' ELSE 'poor' END AS tier FROM lineitem" for c, (a, b, x) in TIERS.items()) + ") SELECT metric, tier, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (PARTITION BY metric), 4)::DOUBLE AS pct FROM t GROUP BY 1, 2")
def stats_quality_tiers(spark, d):
    return s.tiers(table(spark, d, "lineitem"), TIERS)


@query("SELECT l_linenumber >= 6 AS border, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 4)::DOUBLE AS pct, round(avg(l_quantity), 4) AS mean FROM lineitem GROUP BY 1")
def stats_border(spark, d):
    flags = table(spark, d, "lineitem").groupBy((F.col("l_linenumber") >= 6).alias("border")).agg(n(), F.round(F.avg("l_quantity"), 4).alias("mean"))
    return s.with_share(flags)


@query("SELECT CASE WHEN month(l_shipdate) IN (12, 1, 2) THEN 'winter' WHEN month(l_shipdate) IN (3, 4, 5) THEN 'spring' WHEN month(l_shipdate) IN (6, 7, 8) THEN 'summer' ELSE 'fall' END AS season, count(*) AS n FROM lineitem GROUP BY 1")
def stats_season(spark, d):
    return table(spark, d, "lineitem").groupBy(season(F.month("l_shipdate")).alias("season")).agg(n())


YEARS = list(range(1992, 2002))


@query("WITH c AS (SELECT month(o_orderdate) AS m, o_orderpriority AS sp, count(*) AS k FROM orders GROUP BY 1, 2), pk AS (SELECT m, sp AS peak FROM (SELECT *, row_number() OVER (PARTITION BY m ORDER BY k DESC, sp) AS rk FROM c) WHERE rk = 1) SELECT month(o_orderdate) AS m, " + ", ".join(f"count(*) FILTER (year(o_orderdate) = {y}) AS y{y}" for y in YEARS) + ", count(*) AS total, any_value(peak) AS peak FROM orders JOIN pk ON pk.m = month(o_orderdate) GROUP BY 1")
def stats_month_year(spark, d):
    rows = table(spark, d, "orders").select(F.month("o_orderdate").cast("long").alias("m"), F.year("o_orderdate").alias("y"), F.col("o_orderpriority").alias("sp"))
    years = rows.groupBy("m").pivot("y", YEARS).count().na.fill(0)
    for y in YEARS:
        years = years.withColumnRenamed(str(y), f"y{y}")
    peak = rows.groupBy("m", "sp").agg(n("k")).groupBy("m").agg(F.sum("k").alias("total"), F.min(F.struct((-F.col("k")).alias("k"), "sp")).alias("b")).select("m", "total", F.col("b.sp").alias("peak"))
    return years.join(peak, "m")


@query(TOP_SQL.format(key="p_brand", t="part", k=10, more="round(sum(p_retailprice), 2) AS v", agg="round(sum(v), 2) AS v"))
def stats_family(spark, d):
    counts = table(spark, d, "part").groupBy(F.col("p_brand").alias("name")).agg(n(), F.round(F.sum("p_retailprice"), 2).alias("v"))
    return s.top_and_other(counts, 10).groupBy("name").agg(F.sum("n").alias("n"), F.round(F.sum("v"), 2).alias("v"), n("members"))


@query("SELECT p_type AS habit, count(*) AS n FROM part GROUP BY 1")
def stats_habit(spark, d):
    return table(spark, d, "part").groupBy(F.col("p_type").alias("habit")).agg(n())


@query("SELECT p_size % 3 AS duration, count(*) AS n FROM part GROUP BY 1")
def stats_duration(spark, d):
    return table(spark, d, "part").groupBy((F.col("p_size") % 3).alias("duration")).agg(n())


@query("WITH i AS (SELECT l_orderkey, count(*) - 1 AS k FROM lineitem GROUP BY 1) SELECT k > 0 AS overlapping, count(*) AS images, round(avg(k), 4) AS mean FROM i GROUP BY 1")
def stats_overlap(spark, d):
    k = table(spark, d, "lineitem").groupBy("l_orderkey").agg((F.count("*") - 1).alias("k"))
    return k.groupBy((F.col("k") > 0).alias("overlapping")).agg(n("images"), F.round(F.avg("k"), 4).alias("mean"))


@query("SELECT count(*) FILTER (l_linenumber = 1) AS primary_n, count(*) AS n, round(100.0 * count(*) FILTER (l_linenumber = 1) / count(*), 4)::DOUBLE AS pct FROM lineitem")
def stats_primary(spark, d):
    first = F.count_if(F.col("l_linenumber") == 1)
    return table(spark, d, "lineitem").agg(first.alias("primary_n"), n(), F.round(100.0 * first / F.count("*"), 4).alias("pct"))


@query("SELECT round(avg(CASE WHEN l_quantity >= 10 AND l_discount <= 0.05 THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS share FROM lineitem")
def stats_quality_share(spark, d):
    return table(spark, d, "lineitem").agg(F.round(F.avg(F.expr("cast(l_quantity >= 10 and l_discount <= 0.05 as int)")), 6).alias("share"))


@query("""WITH u AS (SELECT 'specimen' AS db, o_orderpriority AS species, o_orderstatus AS state FROM orders UNION ALL SELECT 'observation', event_type, left(event_type, 1) FROM events)
SELECT coalesce(db, 'all') AS db, count(*) AS n, count(DISTINCT species) AS species, count(DISTINCT state) AS states FROM u GROUP BY ROLLUP (db)""")
def stats_cross_db(spark, d):
    a = table(spark, d, "orders").select(F.lit("specimen").alias("db"), F.col("o_orderpriority").alias("species"), F.col("o_orderstatus").alias("state"))
    b = table(spark, d, "events").select(F.lit("observation").alias("db"), F.col("event_type").alias("species"), F.left("event_type", F.lit(1)).alias("state"))
    rolled = a.unionByName(b, allowMissingColumns=True).rollup("db").agg(n(), F.countDistinct("species").alias("species"), F.countDistinct("state").alias("states"))
    return rolled.select(F.coalesce("db", F.lit("all")).alias("db"), "n", "species", "states")


@query("""WITH a AS (SELECT 'type' AS attr, event_type AS val FROM events UNION ALL SELECT 'user', CAST(user_id % 5 AS VARCHAR) FROM events UNION ALL SELECT 'day', CAST(CAST(ts AS DATE) AS VARCHAR) FROM events) SELECT attr, val, count(*) AS n FROM a GROUP BY 1, 2""")
def stats_attribute_counts(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("type"), (F.col("user_id") % 5).cast("string").alias("user"), F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return e.unpivot([], ["type", "user", "day"], "attr", "val").groupBy("attr", "val").agg(n())


@query("""WITH g AS (SELECT event_type, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events)
SELECT event_type, round(avg(gap) / 1e6, 3) AS mean_s, round(quantile_cont(gap, 0.5) / 1e6, 3) AS median_s, count(gap) AS n FROM g GROUP BY 1""")
def stats_latency(spark, d):
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    before = F.lag(us).over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    gaps = table(spark, d, "events").select("event_type", (us - before).alias("gap"))
    found = s.summaries(gaps, ["event_type"], "gap", F.round(F.avg("gap") / 1e6, 3).alias("mean_s"), F.count("gap").alias("n"))
    return found.select("event_type", "mean_s", F.round(F.col("med") / 1e6, 3).alias("median_s"), "n")


@query("""SELECT count(*) AS captured, count(*) FILTER (value >= 5) AS detected, count(*) FILTER (value >= 5 AND event_type <> 'error') AS masked, count(*) FILTER (value >= 20 AND event_type <> 'error') AS reviewed,
count(*) FILTER (value >= 20 AND event_type = 'purchase') AS published FROM events""")
def stats_qc_funnel(spark, d):
    tests = ["true", "value >= 5", "event_type <> 'error'", "value >= 20", "event_type = 'purchase'"]
    return s.funnel(table(spark, d, "events"), dict(zip(("captured", "detected", "masked", "reviewed", "published"), tests, strict=True)))


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_quantity / max(l_quantity) OVER (PARTITION BY l_orderkey) AS alpha FROM lineitem")
def alpha_scale(spark, d):
    most = F.max("l_quantity").over(Window.partitionBy("l_orderkey"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", (F.col("l_quantity") / most).alias("alpha"))
