"""Queries on projections, filters, order, pages, samples and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import predicates as p
from ..operators.dataset import Dataset, Profile
from ..operators.ranking import first_of, md5_key, per_group, ranked, shuffled_rank
from .registry import query, table

SPECIMEN = Profile("specimen", "o_orderkey", "o_custkey")
OBSERVATION = Profile("observation", "event_id", "user_id")
NULLABLE = Profile("nullable", "doc_id", mask_col="quality")


def specimens(spark, d) -> Dataset:
    return Dataset(table(spark, d, "orders"), SPECIMEN)


def observations(spark, d) -> Dataset:
    return Dataset(table(spark, d, "events"), OBSERVATION)


def nullable(spark, d) -> Dataset:
    """Documents, of which some have a label."""
    docs = table(spark, d, "documents").select("doc_id", "source", "lang", "n_chars")
    return Dataset(docs.join(table(spark, d, "labels").select("doc_id", F.col("quality").cast("double"), F.col("toxic").cast("double")), "doc_id", "left"), NULLABLE)


NULLABLE_SQL = "(SELECT d.doc_id, d.source, d.lang, d.n_chars, CAST(l.quality AS DOUBLE) AS quality, CAST(l.toxic AS DOUBLE) AS toxic FROM documents d LEFT JOIN labels l USING (doc_id))"


@query("SELECT * FROM orders")
def scan_all(spark, d) -> DataFrame:
    return specimens(spark, d).all()


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def project_columns(spark, d):
    return specimens(spark, d).select("o_orderstatus").select("o_totalprice", "o_orderkey").all()


@query("SELECT o_totalprice, o_orderpriority, o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders")
def project_reorder(spark, d):
    df, first = table(spark, d, "orders"), ["o_totalprice", "o_orderpriority"]
    return df.select(*first, *(c for c in df.columns if c not in first))


@query("SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'")
def filter_eq(spark, d):
    return specimens(spark, d).filter(o_orderpriority="1-URGENT").all()


@query("SELECT * FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def filter_merge_in(spark, d):
    return specimens(spark, d).filter(o_orderpriority="1-URGENT").filter(o_orderpriority="5-LOW").filter(o_orderpriority="1-urgent").all()


@query("SELECT * FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus IN ('F', 'O')")
def filter_in_list(spark, d):
    return specimens(spark, d).filter(o_orderpriority=["1-URGENT", "2-HIGH"], o_orderstatus=["F", "O"]).all()


@query("SELECT * FROM lineitem WHERE l_partkey IN (SELECT i * 7 FROM range(0, 3000) t(i))")
def filter_in_large(spark, d):
    return p.semi_in(table(spark, d, "lineitem"), "l_partkey", [i * 7 for i in range(3000)])


@query("SELECT * FROM orders WHERE o_orderpriority IN ('1-URGENT', '3-MEDIUM', '5-LOW')")
def filter_in_csv(spark, d):
    return specimens(spark, d).filter(o_orderpriority=[v.strip() for v in "1-URGENT, 3-MEDIUM,5-LOW".split(",")]).all()


@query("SELECT * FROM orders WHERE o_totalprice BETWEEN 50000 AND 200000")
def filter_between(spark, d):
    return specimens(spark, d).filter(o_totalprice={"between": [50000, 200000]}).all()


@query("SELECT * FROM orders WHERE o_totalprice BETWEEN 1000 AND 50000")
def filter_between_and(spark, d):
    return specimens(spark, d).where("o_totalprice between 1000 and 50000").all()


@query("SELECT * FROM orders WHERE o_custkey BETWEEN 10 AND 400 AND o_totalprice > 1000")
def filter_dict_range(spark, d):
    return specimens(spark, d).filter({"o_custkey": {"in": [10, 400]}, "o_totalprice": {">": 1000}}).all()


@query("SELECT * FROM orders WHERE o_totalprice >= 1000 AND o_totalprice < 300000 AND o_custkey <= 900 AND o_custkey > 5 AND o_orderstatus = 'O'")
def filter_cmp(spark, d):
    return specimens(spark, d).where("o_totalprice>=1000", "o_totalprice<300000", "o_custkey<=900", "o_custkey>5", "o_orderstatus=='O'").all()


@query("SELECT * FROM orders WHERE o_totalprice >= 250000.5 AND o_custkey < 700")
def filter_key_op(spark, d):
    return specimens(spark, d).filter({"o_totalprice>=": 250000.5, "o_custkey <": "700"}).all()


@query(f"SELECT * FROM {NULLABLE_SQL} WHERE quality IS NULL")
def filter_null(spark, d):
    return nullable(spark, d).where("quality is null").all()


@query(f"SELECT * FROM {NULLABLE_SQL} WHERE quality IS NOT NULL")
def filter_not_null(spark, d):
    return nullable(spark, d).where("quality is not null").all()


@query(f"SELECT * FROM {NULLABLE_SQL} WHERE quality IS NULL")
def filter_has_mask(spark, d):
    return nullable(spark, d).filter(has_mask="0").all()


@query("SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice BETWEEN 100000 AND 400000 AND o_custkey >= 100")
def filter_conjunction(spark, d):
    return specimens(spark, d).filter({"o_orderstatus": "F", "o_orderpriority": ["1-URGENT", "2-HIGH"], "o_totalprice": {"between": [100000, 400000]}, "o_custkey>=": 100}).all()


@query("SELECT * FROM orders WHERE o_totalprice / 2 > 100000 AND length(o_orderpriority) > 5")
def filter_raw_multi(spark, d):
    return specimens(spark, d).where("o_totalprice / 2 > 100000").where("length(o_orderpriority) > 5").all()


@query("SELECT * FROM orders WHERE (o_totalprice > 400000 OR o_custkey < 50) AND NOT o_orderstatus = 'P'")
def filter_bool_logic(spark, d):
    return specimens(spark, d).where("(o_totalprice > 400000 OR o_custkey < 50) AND NOT o_orderstatus = 'P'").all()


@query("SELECT * FROM part WHERE p_name ILIKE '%RED%'")
def filter_like(spark, d):
    return table(spark, d, "part").filter(F.col("p_name").ilike("%RED%"))


@query("SELECT * FROM orders WHERE o_orderstatus = 'O' AND o_totalprice < 150000 AND o_custkey > 30")
def filter_and_list(spark, d):
    return specimens(spark, d).filter({"o_orderstatus": "O", "o_totalprice<": 150000, "o_custkey>": 30}).all()


@query("SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1997-07-01'")
def filter_date_range(spark, d):
    return specimens(spark, d).filter({"o_orderdate>=": "1996-01-01", "o_orderdate<": "1997-07-01"}).all()


BOX_SQL = "(SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_returnflag = 'R' THEN '' ELSE '[' || (l_partkey % 1000) || ', ' || (l_suppkey % 1000) || ', ' || CAST(l_quantity AS INT) || ', ' || (l_linenumber * 10) || ']' END AS bbox FROM lineitem)"


def boxed(spark, d) -> DataFrame:
    """Lines with a box as text; some have none, some an empty one."""
    n = lambda e: F.expr(e).cast("string")
    box = F.concat(F.lit("["), n("l_partkey % 1000"), F.lit(", "), n("l_suppkey % 1000"), F.lit(", "), n("cast(l_quantity as int)"), F.lit(", "), n("l_linenumber * 10"), F.lit("]"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_returnflag") == "A", box).when(F.col("l_returnflag") == "R", "").alias("bbox"))


@query(f"SELECT * FROM {BOX_SQL} WHERE bbox IS NOT NULL AND bbox <> ''")
def filter_nonempty(spark, d):
    return boxed(spark, d).filter(F.col("bbox").isNotNull() & (F.col("bbox") != ""))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN NULL WHEN 'P' THEN NULL ELSE o_orderpriority END AS path FROM orders")
def null_token_normalise(spark, d):
    path = F.when(F.col("o_orderstatus") == "F", "None").when(F.col("o_orderstatus") == "P", " null").otherwise(F.col("o_orderpriority"))
    return table(spark, d, "orders").select("o_orderkey", p.present(path).alias("path"))


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem WHERE l_quantity BETWEEN 5 AND 45 AND l_discount <= 0.05 AND l_linenumber <= 4 AND l_tax < 0.06 AND l_returnflag <> 'R' AND l_linestatus = 'F'")
def filter_quality_subset(spark, d):
    tests = ["l_quantity between 5 and 45", "l_discount <= 0.05", "l_linenumber <= 4", "l_tax < 0.06", "l_returnflag <> 'R'", "l_linestatus = 'F'"]
    return Dataset(table(spark, d, "lineitem"), Profile("line", "l_orderkey")).where(*tests).select("l_linenumber", "l_quantity", "l_discount").all()


@query("SELECT doc_id, source, lang FROM documents WHERE source IN ('src1', 'src2', 'src5') AND lang = 'en'")
def filter_tasks(spark, d):
    tasks = Dataset(table(spark, d, "documents").select("doc_id", "source", "lang"), Profile("task", "doc_id"))
    return tasks.filter(source=["src1", "src2", "src5"]).filter(lang="en").all()


@query("SELECT doc_id, source FROM documents WHERE lower(source) IN ('src3', 'src7')")
def filter_task_names(spark, d):
    return named_tasks(table(spark, d, "documents").select("doc_id", "source"), "source", ["SRC3", "src7 ", "Src3"])


def named_tasks(df: DataFrame, name: str, wanted: list[str]) -> DataFrame:
    """Rows of the named tasks, letters in either case; an error if no row has such a name."""
    found = df.filter(F.lower(name).isin(p.unique(w.strip().lower() for w in wanted)))
    if found.isEmpty():
        raise ValueError(f"no task is called {', '.join(wanted)}")
    return found


@query("SELECT event_id, event_type, value FROM events WHERE event_type IN ('click', 'view', 'purchase') AND value >= 20 AND CAST(json_extract(props, '$.k') AS INT) >= 10 AND user_id IS NOT NULL")
def filter_field_quality(spark, d):
    return observations(spark, d).filter(event_type=["click", "view", "purchase"]).filter({"value>=": 20}).where("get_json_object(props, '$.k') >= 10", "user_id is not null").select("event_type", "value").all()


@query("SELECT * FROM orders WHERE o_orderkey = 77")
def get_by_id(spark, d):
    return specimens(spark, d).get("77")


@query("SELECT * FROM orders WHERE o_custkey = (SELECT min(o_custkey) FROM orders) ORDER BY o_orderkey LIMIT 1")
def get_by_image_id(spark, d):
    least = table(spark, d, "orders").agg(F.min("o_custkey")).first()[0]
    return specimens(spark, d).get_by_image_id(least)


@query("SELECT o_orderkey, o_orderstatus, o_totalprice, row_number() OVER (ORDER BY o_orderstatus DESC, o_totalprice ASC, o_orderkey) AS rank FROM orders")
def sort_multi(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return ranked(rows, [F.desc("o_orderstatus"), F.asc("o_totalprice"), F.asc("o_orderkey")])


@query("SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS rank FROM orders")
def sort_default(spark, d):
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return ranked(rows, [F.asc("o_orderkey")])


@query("SELECT * FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderkey LIMIT 25")
def limit_n(spark, d):
    return specimens(spark, d).filter(o_orderstatus="O").limit(25).all()


@query("SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 40")
def page_offset(spark, d):
    return specimens(spark, d).sort("o_totalprice", "desc").offset(40).limit(20).all()


@query("SELECT * FROM orders WHERE o_orderkey > 5000 ORDER BY o_orderkey LIMIT 50")
def page_keyset(spark, d):
    return specimens(spark, d).filter({"o_orderkey>": 5000}).limit(50).all()


@query("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def topk_area(spark, d):
    return specimens(spark, d).sort("o_totalprice", "desc").limit(10).select("o_orderpriority", "o_totalprice").all()


@query("SELECT * FROM orders WHERE o_orderpriority = '2-HIGH' ORDER BY o_orderkey LIMIT 1")
def first_record(spark, d):
    return specimens(spark, d).filter(o_orderpriority="2-HIGH").first()


@query("""SELECT page_id, CASE WHEN length(url) > 40 THEN '...' || right(url, 37) ELSE url END AS url, CASE WHEN length(html) > 50 THEN left(html, 47) || '...' ELSE html END AS html
FROM pages ORDER BY page_id LIMIT 5""")
def preview_rows(spark, d):
    from ..functions.text import clip_head, clip_tail

    shown = Dataset(table(spark, d, "pages"), Profile("page", "page_id")).limit(50).preview(5)
    return shown.select("page_id", clip_tail(F.col("url"), 40).alias("url"), clip_head(F.col("html"), 50).alias("html"))


@query("""WITH k AS (SELECT DISTINCT source, CAST(regexp_extract(source, '(\\d+)$', 1) AS INT) AS n FROM documents)
SELECT source, row_number() OVER (ORDER BY regexp_replace(source, '\\d+$', ''), n) AS rank FROM k""")
def sort_natural(spark, d):
    from ..functions.text import natural_key

    names = table(spark, d, "documents").select("source").distinct().withColumn("key", natural_key(F.col("source")))
    return ranked(names, [F.col("key"), F.col("source")]).select("source", "rank")


@query("SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1")
def argmax_row(spark, d):
    df = table(spark, d, "orders")
    best = df.agg(F.max_by(F.struct(*df.columns), F.struct("o_totalprice", (-F.col("o_orderkey")).alias("k"))).alias("x"))
    return best.select("x.*")


@query("SELECT doc_id, source, row_number() OVER (ORDER BY doc_id) - 1 AS frame_idx FROM documents WHERE lang <> 'es'")
def frame_index(spark, d):
    rows = table(spark, d, "documents").filter("lang <> 'es'").select("doc_id", "source")
    return ranked(rows, [F.asc("doc_id")], "n").select("doc_id", "source", (F.col("n") - 1).alias("frame_idx"))


@query()
def sample_random(spark, d):
    return specimens(spark, d).filter(o_orderstatus="O").sample_random(100).all()


@query("SELECT least(count(*), 100) AS n, least(count(*), 100) AS distinct_n, least(count(*), 100) AS fitting FROM orders WHERE o_orderstatus = 'O'")
def sample_random_counts(spark, d):
    """What holds of every random sample: its size, no row twice, all rows from among those that pass."""
    some = specimens(spark, d).filter(o_orderstatus="O").sample_random(100).all()
    known = table(spark, d, "orders").filter("o_orderstatus = 'O'").select("o_orderkey", F.lit(True).alias("known"))
    return some.join(known, "o_orderkey", "left").agg(F.count("*").alias("n"), F.countDistinct("o_orderkey").alias("distinct_n"), F.count("known").alias("fitting"))


@query("SELECT * FROM orders ORDER BY (o_orderkey * 1103515245 + 42) & 2147483647 LIMIT 200")
def sample_seeded(spark, d):
    return specimens(spark, d).sample_seeded(200, seed=42).all()


@query()
def sample_stratified(spark, d):
    return specimens(spark, d).sample_stratified(["o_orderpriority"], 10).all()


@query("SELECT o_orderpriority, least(count(*), 700) AS n FROM orders GROUP BY 1")
def sample_stratified_counts(spark, d):
    return specimens(spark, d).sample_stratified(["o_orderpriority"], 700).all().groupBy("o_orderpriority").agg(F.count("*").alias("n"))


STRATA = "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY md5('{seed}:' || {id}), {id}) AS rn FROM {t}) WHERE rn <= {k}"


@query(STRATA.format(by="quality, lang", seed=7, id="doc_id", t=NULLABLE_SQL, k=5))
def sample_stratified_seeded(spark, d):
    return nullable(spark, d).sample_stratified(["quality", "lang"], 5, seed=7).all()


@query(STRATA.format(by="o_orderpriority, o_orderstatus", seed=42, id="o_orderkey", t="orders", k=20))
def sample_stratified_multi(spark, d):
    return specimens(spark, d).sample_stratified(["o_orderpriority", "o_orderstatus"], 20, seed=42).all()


@query(STRATA.format(by="o_orderpriority", seed=42, id="o_orderkey", t="orders", k=20) + " ORDER BY o_orderkey LIMIT 30 OFFSET 10")
def sample_stratified_page(spark, d):
    return specimens(spark, d).sample_stratified(["o_orderpriority"], 20, seed=42).limit(30).offset(10).all()


@query("SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000 ORDER BY (o_orderkey * 1103515245 + 9) & 2147483647 LIMIT 50")
def filter_then_sample(spark, d):
    return specimens(spark, d).filter({"o_orderstatus": "F", "o_totalprice>": 100000}).sample_seeded(50, seed=9).all()


@query("""WITH g AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1), t AS (SELECT p_brand FROM g ORDER BY n DESC, p_brand LIMIT 5),
r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY md5('1:' || p_partkey), p_partkey) AS rn FROM part)
SELECT p_partkey, p_brand FROM r WHERE rn <= 30 OR p_brand NOT IN (SELECT p_brand FROM t)""")
def sample_topn_cap(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_brand")
    top = part.groupBy("p_brand").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "p_brand").limit(5).select(F.col("p_brand").alias("b"))
    marked = part.join(F.broadcast(top), F.col("p_brand") == F.col("b"), "left")  # five rows
    capped = per_group(marked.filter("b is not null"), ["p_brand"], 30, [md5_key(1, "p_partkey"), F.col("p_partkey")])
    return capped.unionByName(marked.filter("b is null")).drop("b")


BINS = "CASE WHEN o_totalprice < 100000 THEN 'small' WHEN o_totalprice < 250000 THEN 'medium' WHEN o_totalprice < 400000 THEN 'large' ELSE 'extra_large' END"


def size_bin(name: str = "o_totalprice"):
    c = F.col(name)
    return F.when(c < 100000, "small").when(c < 250000, "medium").when(c < 400000, "large").otherwise("extra_large")


@query(f"SELECT o_orderkey, bin FROM (SELECT *, row_number() OVER (PARTITION BY bin ORDER BY md5('3:' || o_orderkey), o_orderkey) AS rn FROM (SELECT *, {BINS} AS bin FROM orders)) WHERE rn <= 40")
def sample_balanced_bins(spark, d):
    binned = table(spark, d, "orders").select("o_orderkey", size_bin().alias("bin"))
    return Dataset(binned, SPECIMEN).sample_stratified(["bin"], 40, seed=3).all()


@query(STRATA.format(by="o_orderstatus", seed=5, id="o_orderkey", t="orders", k=60))
def sample_balanced_state(spark, d):
    return specimens(spark, d).sample_stratified(["o_orderstatus"], 60, seed=5).all()


@query("SELECT l_orderkey, l_partkey, l_linenumber, l_discount, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_discount DESC, l_orderkey, l_linenumber, l_suppkey, l_extendedprice, l_shipdate) AS rn FROM lineitem) WHERE rn <= 2")
def sample_quality_first(spark, d):
    order = [F.desc("l_discount"), *map(F.col, ("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_shipdate"))]
    return per_group(table(spark, d, "lineitem"), ["l_partkey"], 2, order).select("l_orderkey", "l_partkey", "l_linenumber", "l_discount", "l_suppkey")


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('42:' || o_orderkey), o_orderkey) AS rn FROM orders)
SELECT * EXCLUDE (rn) FROM r WHERE rn > 20 AND rn <= 50""")
def sample_growth_delta(spark, d):
    small, large = (specimens(spark, d).sample_stratified(["o_orderpriority"], k, seed=42).all() for k in (20, 50))
    return large.join(small.select("o_orderkey"), "o_orderkey", "left_anti")


@query("""WITH s AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus IN ('F', 'O') THEN 'train' ELSE 'test' END AS split FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY split ORDER BY md5('11:' || o_orderkey), o_orderkey) AS rn FROM s) SELECT o_orderkey, o_orderstatus, split FROM r WHERE rn <= 300""")
def split_geographic(spark, d):
    split = F.when(F.col("o_orderstatus").isin("F", "O"), "train").otherwise("test")
    rows = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", split.alias("split"))
    return per_group(rows, ["split"], 300, [md5_key(11, "o_orderkey"), F.col("o_orderkey")])


@query("SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'train' ELSE 'val' END AS split FROM orders")
def split_temporal(spark, d):
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    return table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderdate") < cut, "train").otherwise("val").alias("split"))


SPLIT_SQL = """WITH n AS (SELECT count(*) AS n FROM documents), r AS (SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS rk FROM documents),
s AS (SELECT doc_id, CASE WHEN rk <= floor(0.7::DOUBLE * n) THEN 'train' WHEN rk <= floor(0.7::DOUBLE * n) + floor(0.15::DOUBLE * n) THEN 'val' ELSE 'test' END AS split FROM r, n) """


def split_names(rows: DataFrame, key: str, train: float = 0.7, val: float = 0.15, seed: int = 42) -> DataFrame:
    """``split`` of each row: a seeded shuffle cut at whole numbers of rows, the remainder for test."""
    n = rows.count()
    first, second = int(train * n), int(val * n)
    split = F.when(F.col("rank") <= first, "train").when(F.col("rank") <= first + second, "val").otherwise("test")
    return shuffled_rank(rows, key, seed).withColumn("split", split).drop("rank")


@query(SPLIT_SQL + "SELECT * FROM s")
def split_train_val_test(spark, d):
    return split_names(table(spark, d, "documents").select("doc_id"), "doc_id")


@query(SPLIT_SQL + "SELECT split, count(*) AS n FROM s GROUP BY 1")
def split_counts(spark, d):
    return split_names(table(spark, d, "documents").select("doc_id"), "doc_id").groupBy("split").agg(F.count("*").alias("n"))


@query(SPLIT_SQL + "SELECT * FROM s WHERE doc_id IN (SELECT doc_id FROM labels)")
def split_paired_only(spark, d):
    return split_names(table(spark, d, "documents").select("doc_id"), "doc_id").join(table(spark, d, "labels"), "doc_id", "left_semi")


@query("SELECT doc_id, source, md5(source || lang) AS tag FROM (SELECT *, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
def dedupe_first_wins(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source", "lang")
    return first_of(docs, ["source", "lang"], [F.col("doc_id")]).select("doc_id", "source", F.md5(F.concat("source", "lang")).alias("tag"))


@query("SELECT doc_id, row_number() OVER (ORDER BY md5('13:' || doc_id), doc_id) AS rank FROM documents")
def global_rank(spark, d):
    return shuffled_rank(table(spark, d, "documents").select("doc_id"), "doc_id", 13)
