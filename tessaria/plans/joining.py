"""Queries on record shapes, joins, lookups, unions and staging plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import joins as j
from ..operators.ranking import first_of
from .registry import query, table
from .selecting import boxed, nullable, NULLABLE_SQL


def paths(spark, d) -> DataFrame:
    """Orders with path columns of which some are missing."""
    o = table(spark, d, "orders")
    return o.select(
        "o_orderkey",
        F.when(F.col("o_custkey") % 3 != 0, F.concat(F.lit("/img/"), F.col("o_custkey").cast("string"), F.lit(".jpg"))).otherwise("").alias("image_path"),
        F.when(F.col("o_orderstatus") != "F", F.concat(F.lit("mask/"), F.col("o_orderkey").cast("string"), F.lit("_mask.png"))).alias("mask_path"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("crop/"), F.col("o_orderkey").cast("string"))).when(F.col("o_orderpriority") == "5-LOW", "None").alias("cropout_path"),
    )


PATHS_SQL = """(SELECT o_orderkey, CASE WHEN o_custkey % 3 <> 0 THEN '/img/' || o_custkey || '.jpg' ELSE '' END AS image_path,
CASE WHEN o_orderstatus <> 'F' THEN 'mask/' || o_orderkey || '_mask.png' END AS mask_path,
CASE WHEN o_orderpriority = '1-URGENT' THEN 'crop/' || o_orderkey WHEN o_orderpriority = '5-LOW' THEN 'None' END AS cropout_path FROM orders)"""


@query(f"""SELECT o_orderkey, nullif(image_path, '') AS image, mask_path AS mask,
concat_ws(';', CASE WHEN cropout_path <> '' THEN 'cropout=' || cropout_path END, CASE WHEN mask_path <> '' THEN 'mask=' || mask_path END) AS aux FROM {PATHS_SQL}""")
def record_cutout_aux(spark, d):
    aux = F.map_filter(F.create_map(F.lit("cropout"), F.col("cropout_path"), F.lit("mask"), F.col("mask_path")), lambda k, v: v.isNotNull() & (v != ""))
    flat = F.array_join(F.array_sort(F.transform(F.map_entries(aux), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")
    return paths(spark, d).select("o_orderkey", F.nullif("image_path", F.lit("")).alias("image"), F.col("mask_path").alias("mask"), flat.alias("aux"))


@query(f"SELECT o_orderkey, coalesce(nullif(cropout_path, ''), nullif(image_path, ''), nullif(mask_path, '')) AS best FROM {PATHS_SQL}")
def record_field_best_path(spark, d):
    best = F.coalesce(*(F.nullif(c, F.lit("")) for c in ("cropout_path", "image_path", "mask_path")))
    return paths(spark, d).select("o_orderkey", best.alias("best"))


@query(f"SELECT o_orderkey, 'root' || image_path AS image_path, mask_path, cropout_path, mask_path IS NOT NULL AS has_mask FROM {PATHS_SQL}")
def record_flatten(spark, d):
    return paths(spark, d).withColumns({"image_path": F.concat(F.lit("root"), F.col("image_path")), "has_mask": F.col("mask_path").isNotNull()})


def valid(c: str):
    return F.col(c).isNotNull() & ~F.lower(F.trim(c)).isin("none", "null", "")


@query(f"""SELECT o_orderkey, CASE WHEN cropout_path IS NOT NULL AND lower(trim(cropout_path)) NOT IN ('none', 'null', '') THEN cropout_path ELSE image_path END AS path,
NOT (cropout_path IS NOT NULL AND lower(trim(cropout_path)) NOT IN ('none', 'null', '')) AS crop FROM {PATHS_SQL}""")
def image_path_plan(spark, d):
    return paths(spark, d).select("o_orderkey", F.when(valid("cropout_path"), F.col("cropout_path")).otherwise(F.col("image_path")).alias("path"), (~valid("cropout_path")).alias("crop"))


@query(f"""SELECT p.o_orderkey, coalesce(CASE WHEN lower(trim(cropout_path)) NOT IN ('none', 'null', '') THEN cropout_path END, CASE WHEN l.doc_id IS NOT NULL THEN 'run/' || p.o_orderkey END,
nullif(image_path, ''), mask_path) AS path FROM {PATHS_SQL} p LEFT JOIN labels l ON l.doc_id = p.o_orderkey""")
def upload_path_plan(spark, d):
    there = table(spark, d, "labels").select(F.col("doc_id").alias("o_orderkey"), F.concat(F.lit("run/"), F.col("doc_id").cast("string")).alias("run_path"))
    found = F.coalesce(F.when(valid("cropout_path"), F.col("cropout_path")), "run_path", F.nullif("image_path", F.lit("")), "mask_path")
    return paths(spark, d).join(there, "o_orderkey", "left").select("o_orderkey", found.alias("path"))


@query(f"""SELECT o_orderkey AS record_id, CASE WHEN mask_path IS NULL THEN 'full_image' ELSE 'cutout' END AS image_mode, mask_path, replace(mask_path, '_mask.png', '_cutout.png') AS cutout_path,
CASE WHEN mask_path IS NOT NULL THEN 'viz/' || o_orderkey || '.png' END AS viz_path FROM {PATHS_SQL}""")
def manifest_rows(spark, d):
    viz = F.when(F.col("mask_path").isNotNull(), F.concat(F.lit("viz/"), F.col("o_orderkey").cast("string"), F.lit(".png")))
    mode = F.when(F.col("mask_path").isNull(), "full_image").otherwise("cutout")
    return paths(spark, d).select(F.col("o_orderkey").alias("record_id"), mode.alias("image_mode"), "mask_path", F.replace("mask_path", F.lit("_mask.png"), F.lit("_cutout.png")).alias("cutout_path"), viz.alias("viz_path"))


@query("SELECT * FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 400000)")
def semi_join_images(spark, d):
    o = table(spark, d, "orders")
    some = o.filter("o_orderpriority = '1-URGENT' and o_totalprice > 400000").select("o_custkey").distinct()
    return o.join(some, "o_custkey", "left_semi").select(*o.columns)


@query("SELECT * FROM orders WHERE o_custkey = (SELECT o_custkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1)")
def rows_of_argmax_image(spark, d):
    o = table(spark, d, "orders")
    best = o.agg(F.max_by("o_custkey", F.struct("o_totalprice", (-F.col("o_orderkey")).alias("k"))).alias("o_custkey"))
    return o.join(F.broadcast(best), "o_custkey", "left_semi").select(*o.columns)  # one row


@query("SELECT d.doc_id, d.source, l.quality, l.toxic FROM documents d JOIN labels l USING (doc_id)")
def join_manifest_records(spark, d):
    return table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels"), "doc_id")


REASON_SQL = """CASE WHEN d.n_chars < 100 THEN 'image_missing' WHEN l.doc_id IS NULL THEN 'mask_missing' WHEN l.toxic = 1 THEN 'record_missing' ELSE 'ok' END"""


@query(f"SELECT {REASON_SQL} AS reason, count(*) AS n FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1")
def join_skip_reasons(spark, d):
    rows = nullable(spark, d).source
    why = j.reason(("image_missing", F.col("n_chars") < 100), ("mask_missing", F.col("quality").isNull()), ("record_missing", F.col("toxic") == 1))
    return rows.groupBy(why.alias("reason")).agg(F.count("*").alias("n"))


RESOLVED_SQL = """(SELECT o_orderkey, CASE WHEN l.doc_id IS NOT NULL THEN 'run/' || o_orderkey WHEN o_orderstatus = 'O' AND o_totalprice > 200000 THEN 'task/' || o_orderkey WHEN p.p_partkey IS NOT NULL THEN 'any/' || o_orderkey WHEN o_orderstatus = 'F' THEN 'db/' || o_orderkey END AS path,
CASE WHEN l.doc_id IS NOT NULL THEN 'run' WHEN o_orderstatus = 'O' AND o_totalprice > 200000 THEN 'same_task' WHEN p.p_partkey IS NOT NULL THEN 'any_task' WHEN o_orderstatus = 'F' THEN 'database' ELSE 'missing' END AS found_in
FROM orders o LEFT JOIN labels l ON l.doc_id = o_orderkey LEFT JOIN part p ON p.p_partkey = o_orderkey)"""


def candidates(spark, d) -> list[tuple[str, DataFrame]]:
    o = table(spark, d, "orders")
    at = lambda df, key, root: df.select(F.col(key).alias("o_orderkey"), F.concat(F.lit(root), F.col(key).cast("string")).alias("path"))
    return [
        ("run", at(table(spark, d, "labels"), "doc_id", "run/")),
        ("same_task", at(o.filter("o_orderstatus = 'O' and o_totalprice > 200000"), "o_orderkey", "task/")),
        ("any_task", at(table(spark, d, "part"), "p_partkey", "any/")),
        ("database", at(o.filter("o_orderstatus = 'F'"), "o_orderkey", "db/")),
    ]


@query(f"SELECT * FROM {RESOLVED_SQL}")
def resolve_priority(spark, d):
    return j.by_priority(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", candidates(spark, d))


@query(f"SELECT found_in, count(*) AS n FROM {RESOLVED_SQL} GROUP BY 1")
def resolution_stats(spark, d):
    return resolve_priority(spark, d).groupBy("found_in").agg(F.count("*").alias("n"))


@query("SELECT r.o_orderkey, CASE WHEN o_totalprice < 50000 THEN 'custom/' || r.o_orderkey ELSE path END AS path, CASE WHEN o_totalprice < 50000 THEN 'custom' ELSE found_in END AS found_in FROM " + RESOLVED_SQL + " r JOIN orders USING (o_orderkey)")
def resolve_custom_source(spark, d):
    own = table(spark, d, "orders").filter("o_totalprice < 50000").select("o_orderkey", F.concat(F.lit("custom/"), F.col("o_orderkey").cast("string")).alias("path"))
    return j.by_priority(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", [("custom", own), *candidates(spark, d)])


@query("""WITH a AS (SELECT o_orderkey AS k, min(o_totalprice) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT o_custkey AS k, min(o_totalprice) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)
SELECT doc_id, coalesce(a.v, b.v) AS o_totalprice, a.v IS NOT NULL AS direct FROM documents LEFT JOIN a ON a.k = doc_id LEFT JOIN b ON b.k = doc_id""")
def lookup_fallback(spark, d):
    records = table(spark, d, "orders").filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_totalprice")
    return j.with_fallback(table(spark, d, "documents").select("doc_id"), records, ("doc_id", "o_orderkey"), ("doc_id", "o_custkey"), "o_totalprice")


@query(f"""SELECT o_orderkey, CASE WHEN lower(trim(coalesce(cropout_path, ''))) NOT IN ('none', 'null', '') THEN 'cropout' WHEN image_path <> '' AND mask_path IS NOT NULL THEN 'crop_from_full' WHEN image_path <> '' THEN 'full' ELSE 'missing' END AS how FROM {PATHS_SQL}""")
def resolve_case(spark, d):
    how = F.when(valid("cropout_path"), "cropout").when((F.col("image_path") != "") & F.col("mask_path").isNotNull(), "crop_from_full").when(F.col("image_path") != "", "full").otherwise("missing")
    return paths(spark, d).select("o_orderkey", how.alias("how"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, upper(p_brand) AS symbol, lower(p_name) AS common_name FROM lineitem LEFT JOIN part ON l_partkey = p_partkey")
def species_lookup(spark, d):
    part = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), F.upper("p_brand").alias("symbol"), F.lower("p_name").alias("common_name"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey").join(part, "l_partkey", "left").select("l_orderkey", "l_linenumber", "l_partkey", "symbol", "common_name")


@query("""WITH k AS (SELECT 'class_id' AS kind, CAST(p_partkey AS VARCHAR) AS key, p_partkey AS class_id FROM part UNION ALL SELECT 'symbol', upper(p_brand), max(p_partkey) FROM part GROUP BY 2 UNION ALL SELECT 'common_name', lower(p_name), max(p_partkey) FROM part GROUP BY 2),
r AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN 'class_id' WHEN 1 THEN 'symbol' WHEN 2 THEN 'common_name' ELSE 'other' END AS kind,
CASE l_linenumber % 4 WHEN 0 THEN CAST(l_partkey * 2 AS VARCHAR) WHEN 1 THEN lower(p_brand) ELSE upper(p_name) END AS key FROM lineitem JOIN part ON l_partkey = p_partkey)
SELECT r.l_orderkey, r.l_linenumber, r.kind, r.key, k.class_id FROM r LEFT JOIN k ON k.kind = r.kind AND k.key = CASE r.kind WHEN 'symbol' THEN upper(r.key) WHEN 'common_name' THEN lower(r.key) ELSE r.key END""")
def species_lookup_keys(spark, d):
    """By class id, by symbol in any case, by common name in any case; an unknown kind of key finds nothing."""
    part = table(spark, d, "part").select("p_partkey", "p_brand", "p_name")
    way = F.col("l_linenumber") % 4
    kind = F.when(way == 0, "class_id").when(way == 1, "symbol").when(way == 2, "common_name").otherwise("other")
    key = F.when(way == 0, (F.col("l_partkey") * 2).cast("string")).when(way == 1, F.lower("p_brand")).otherwise(F.upper("p_name"))
    asked = table(spark, d, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select("l_orderkey", "l_linenumber", kind.alias("kind"), key.alias("key"))
    same = lambda c: c
    keys = {"class_id": (F.col("p_partkey").cast("string"), same), "symbol": (F.col("p_brand"), F.upper), "common_name": (F.col("p_name"), F.lower)}
    return j.by_any_key(asked, part, keys, "p_partkey").withColumnRenamed("p_partkey", "class_id")


@query("SELECT l_orderkey, string_agg(DISTINCT p_name, '|' ORDER BY p_name) AS categories FROM lineitem LEFT JOIN part ON l_partkey = p_partkey AND p_size > 10 GROUP BY 1")
def annotation_categories(spark, d):
    part = table(spark, d, "part").filter("p_size > 10").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    named = table(spark, d, "lineitem").select("l_orderkey", "l_partkey").join(part, "l_partkey", "left").groupBy("l_orderkey").agg(F.array_sort(F.collect_set("p_name")).alias("c"))
    return named.select("l_orderkey", F.when(F.size("c") > 0, F.array_join("c", "|")).alias("categories"))


@query("SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0))")
def coco_semi_filter(spark, d):
    frames = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"))
    images = table(spark, d, "orders").join(frames, "o_custkey", "left_semi").select(F.col("o_orderkey").alias("l_orderkey"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber").join(images, "l_orderkey", "left_semi")


@query("""WITH a AS (SELECT DISTINCT o_custkey AS k FROM orders), b AS (SELECT DISTINCT user_id AS k FROM events)
SELECT coalesce(a.k, b.k) AS stem, CASE WHEN a.k IS NULL THEN 'no_image' WHEN b.k IS NULL THEN 'no_mask' ELSE 'paired' END AS status FROM a FULL JOIN b ON a.k = b.k""")
def pair_status(spark, d):
    return j.paired(table(spark, d, "orders").select(F.col("o_custkey").alias("stem")), table(spark, d, "events").select(F.col("user_id").alias("stem")), "stem")


@query("SELECT n_name, '/mnt/' || lower(r_name) || '/' || lower(n_name) AS path, r_name IS NOT NULL AS known FROM nation LEFT JOIN region ON n_regionkey = r_regionkey AND r_name <> 'ASIA'")
def resolve_roots(spark, d):
    roots = table(spark, d, "region").filter("r_name <> 'ASIA'").select(F.col("r_regionkey").alias("n_regionkey"), F.concat(F.lit("/mnt/"), F.lower("r_name")).alias("root"))
    joined = table(spark, d, "nation").join(roots, "n_regionkey", "left")
    return joined.select("n_name", F.when(F.col("root").isNotNull(), t.path(F.col("root"), F.lower("n_name"))).alias("path"), F.col("root").isNotNull().alias("known"))


@query("""SELECT label, count(*) AS n FROM (SELECT CASE WHEN toxic = 1 THEN 'toxic' WHEN quality IS NOT NULL THEN 'plant-' || CAST(CAST(quality AS INT) AS VARCHAR) ELSE 'plant' END AS label FROM %s) WHERE label IN ('toxic', 'plant-1', 'plant') GROUP BY 1""" % NULLABLE_SQL)
def label_map(spark, d):
    rows = nullable(spark, d).source
    name = F.coalesce(F.when(F.col("toxic") == 1, "toxic"), F.concat(F.lit("plant-"), F.col("quality").cast("int").cast("string")), F.lit("plant"))
    return rows.select(name.alias("label")).filter(F.col("label").isin("toxic", "plant-1", "plant")).groupBy("label").agg(F.count("*").alias("n"))


@query("""WITH k AS (SELECT page_id, regexp_replace(regexp_replace(url, '^https?://', ''), '\\..*$', '') AS host FROM pages), n AS (SELECT prefix, min(place) AS place FROM (SELECT left(host, 3) AS prefix, 2 * page_id + 1 AS place FROM k UNION ALL SELECT left(host, 5), 2 * page_id FROM k) GROUP BY 1)
SELECT page_id, host, arg_min(prefix, place) AS task FROM k JOIN n ON starts_with(host, prefix) GROUP BY 1, 2""")
def prefix_join_first(spark, d):
    host = F.regexp_replace(F.regexp_replace("url", "^https?://", ""), r"\..*$", "")
    pages = table(spark, d, "pages").select("page_id", host.alias("host"))
    named = lambda n, extra: pages.select(F.left("host", F.lit(n)).alias("prefix"), (2 * F.col("page_id") + extra).alias("place"))
    names = named(3, 1).unionByName(named(5, 0)).groupBy("prefix").agg(F.min("place").alias("place"))  # a list of names in order of appearance
    return j.first_prefix(pages, "host", names, "prefix", "place", "task")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT doc_id FROM documents)")
def anti_already_done(spark, d):
    done = table(spark, d, "documents").select(F.col("doc_id").alias("o_orderkey"))
    return table(spark, d, "orders").select("o_orderkey", "o_custkey").join(done, "o_orderkey", "left_anti")


@query("SELECT l_orderkey, l_linenumber, p_name, p_type, o_orderstatus FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN orders ON l_orderkey = o_orderkey")
def expand_category(spark, d):
    part = table(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", "p_type")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    return table(spark, d, "lineitem").join(part, "l_partkey", "left").join(o, "l_orderkey", "left").select("l_orderkey", "l_linenumber", "p_name", "p_type", "o_orderstatus")


BOXES_SQL = "(SELECT l_orderkey AS image, l_linenumber * 1000000 + l_partkey AS id, l_partkey % 1000 AS x, l_suppkey % 1000 AS y, CAST(l_quantity AS INT) AS w, l_linenumber * 10 AS h FROM lineitem)"


def boxes(spark, d) -> DataFrame:
    e = ["l_orderkey as image", "l_linenumber * 1000000 + l_partkey as id", "l_partkey % 1000 as x", "l_suppkey % 1000 as y", "cast(l_quantity as int) as w", "l_linenumber * 10 as h"]
    return table(spark, d, "lineitem").selectExpr(*e)


@query(f"SELECT a.image, a.id AS id_a, b.id AS id_b FROM {BOXES_SQL} a JOIN {BOXES_SQL} b ON a.image = b.image AND a.id < b.id AND a.x < b.x + b.w AND b.x < a.x + a.w AND a.y < b.y + b.h AND b.y < a.y + a.h")
def overlap_pairs(spark, d):
    """Boxes of an image lie in few cells of a grid; only boxes that share a cell are compared, in the first cell both touch."""
    cell = 128
    b = boxes(spark, d)
    at = lambda v, size: F.sequence(F.floor(F.col(v) / cell), F.floor((F.col(v) + F.greatest(F.col(size) - 1, F.lit(0))) / cell))
    dealt = b.withColumn("cx", F.explode(at("x", "w"))).withColumn("cy", F.explode(at("y", "h")))
    left, right = (dealt.select("image", "cx", "cy", *(F.col(c).alias(f"{c}_{s}") for c in ("id", "x", "y", "w", "h"))) for s in "ab")
    met = left.join(right, ["image", "cx", "cy"]).filter("id_a < id_b and x_a < x_b + w_b and x_b < x_a + w_a and y_a < y_b + h_b and y_b < y_a + h_a")
    first = (F.col("cx") == F.floor(F.greatest("x_a", "x_b") / cell)) & (F.col("cy") == F.floor(F.greatest("y_a", "y_b") / cell))
    return met.filter(first).select("image", "id_a", "id_b")


@query("SELECT l_orderkey, string_agg(l_linenumber || ':' || l_partkey, ',' ORDER BY l_linenumber, l_partkey) AS boxes FROM lineitem GROUP BY 1")
def boxes_per_image(spark, d):
    found = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("b"))
    return found.select("l_orderkey", F.array_join(F.transform("b", lambda x: F.concat_ws(":", x["l_linenumber"].cast("string"), x["l_partkey"].cast("string"))), ",").alias("boxes"))


@query("""WITH u AS (SELECT lang AS task, 0 AS ord, source AS name, doc_id FROM documents WHERE lang = 'en' UNION ALL SELECT lang, 1, source, doc_id FROM documents WHERE lang = 'de' UNION ALL SELECT lang, 2, source, doc_id FROM documents WHERE lang = 'fr')
SELECT task, name, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY ord, doc_id) AS rn FROM u) WHERE rn = 1""")
def union_tasks(spark, d):
    return first_of(tasks_in_order(spark, d), ["name"], [F.col("ord"), F.col("doc_id")]).select("task", "name", "doc_id")


def tasks_in_order(spark, d) -> DataFrame:
    docs = table(spark, d, "documents")
    each = [docs.filter(F.col("lang") == n).select(F.col("lang").alias("task"), F.lit(i).alias("ord"), F.col("source").alias("name"), "doc_id") for i, n in enumerate(("en", "de", "fr"))]
    return each[0].unionByName(each[1]).unionByName(each[2])


@query("SELECT task || '_' || name AS name, min(doc_id) AS doc_id, count(*) AS n FROM (SELECT lang AS task, source AS name, doc_id FROM documents WHERE lang IN ('en', 'de', 'fr')) GROUP BY 1")
def union_tasks_prefixed(spark, d):
    return tasks_in_order(spark, d).groupBy(F.concat_ws("_", "task", "name").alias("name")).agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("n"))


@query("SELECT DISTINCT o_custkey FROM orders")
def distinct_images(spark, d):
    return table(spark, d, "orders").select("o_custkey").distinct()


@query("SELECT page_id, url FROM pages WHERE lower(url) LIKE '%x' OR lower(url) LIKE '%.html'")
def filter_extension(spark, d):
    return table(spark, d, "pages").select("page_id", "url").filter(F.lower("url").endswith("x") | F.lower("url").endswith(".html"))


@query("SELECT doc_id || '.jpg,' || doc_id || '_mask.png' AS line FROM documents JOIN labels USING (doc_id)")
def pair_manifest(spark, d):
    name = F.col("doc_id").cast("string")
    both = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").select("doc_id"), "doc_id")
    return both.select(F.concat_ws(",", F.concat(name, F.lit(".jpg")), F.concat(name, F.lit("_mask.png"))).alias("line"))


STAGE_SQL = f"""(SELECT o_orderkey, 'image' AS kind, image_path AS src FROM {PATHS_SQL} UNION ALL SELECT o_orderkey, 'mask', mask_path FROM {PATHS_SQL} UNION ALL SELECT o_orderkey, 'cropout', cropout_path FROM {PATHS_SQL})"""


def artifacts(spark, d) -> DataFrame:
    """A row for each artifact that a record names."""
    p = paths(spark, d).select("o_orderkey", *(F.col(f"{k}_path").alias(k) for k in ("image", "mask", "cropout")))
    return p.unpivot("o_orderkey", ["image", "mask", "cropout"], "kind", "src").filter(F.col("src").isNotNull() & ~F.lower("src").isin("", "none", "null"))


KEPT = "src IS NOT NULL AND lower(src) NOT IN ('', 'none', 'null')"


@query(f"SELECT o_orderkey, kind, src, kind || '/' || (o_orderkey % 16) || '/' || o_orderkey AS dst FROM {STAGE_SQL} WHERE {KEPT}")
def stage_plan(spark, d):
    dst = F.concat_ws("/", "kind", (F.col("o_orderkey") % 16).cast("string"), F.col("o_orderkey").cast("string"))
    return artifacts(spark, d).select("o_orderkey", "kind", "src", dst.alias("dst"))


@query("SELECT o_orderkey, 'flat/' || o_orderkey AS flat, 'batch_' || (o_custkey % 10) || '/' || o_orderkey AS by_batch, replace(lower(o_orderpriority), ' ', '_') || '/' || o_orderkey AS by_species FROM orders")
def stage_layout(spark, d):
    o, key = table(spark, d, "orders"), F.col("o_orderkey").cast("string")
    batch = F.concat(F.lit("batch_"), (F.col("o_custkey") % 10).cast("string"))
    return o.select("o_orderkey", F.concat_ws("/", F.lit("flat"), key).alias("flat"), F.concat_ws("/", batch, key).alias("by_batch"), F.concat_ws("/", F.replace(F.lower("o_orderpriority"), F.lit(" "), F.lit("_")), key).alias("by_species"))


CHECKED_SQL = """(SELECT doc_id, sha256(text) AS sha256, strlen(text) AS bytes, length(text) = n_chars AS as_listed, sha256(text || CASE WHEN l.quality = 0 THEN '!' ELSE '' END) AS listed,
CASE WHEN l.doc_id IS NULL THEN 'unlisted' WHEN l.quality = 0 THEN 'mismatch' ELSE 'ok' END AS status FROM documents LEFT JOIN labels l USING (doc_id))"""


def staged_texts(spark, d) -> DataFrame:
    """Checksums of what lies there beside those listed for labelled documents, some of which were listed for another text."""
    docs = table(spark, d, "documents").select("doc_id", "text", "n_chars")
    found = docs.select("doc_id", F.sha2("text", 256).alias("sha256"), F.octet_length("text").cast("long").alias("bytes"), (F.length("text") == F.col("n_chars")).alias("as_listed"))
    text = F.concat("text", F.when(F.col("quality") == 0, "!").otherwise(""))
    expected = docs.join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id").select("doc_id", F.sha2(text, 256).alias("expected_sha256"))
    return j.checked(found, expected, "doc_id")


@query(f"SELECT doc_id, sha256, bytes, as_listed, status FROM {CHECKED_SQL}")
def stage_checksums(spark, d):
    return staged_texts(spark, d).select("doc_id", "sha256", "bytes", "as_listed", "status")


@query(f"SELECT doc_id, sha256, listed AS expected_sha256 FROM {CHECKED_SQL} WHERE status = 'mismatch'")
def stage_mismatches(spark, d):
    return staged_texts(spark, d).filter("status = 'mismatch'").select("doc_id", "sha256", "expected_sha256")


STATUS_SQL = f"""(SELECT o_orderkey, kind, CASE WHEN d.doc_id IS NOT NULL THEN 'skipped_cached' WHEN kind = 'cropout' THEN 'skipped_missing' WHEN o_orderkey % 11 = 0 THEN 'failed' ELSE 'copied' END AS status,
CASE WHEN d.doc_id IS NULL AND kind <> 'cropout' AND o_orderkey % 11 <> 0 THEN 100 * length(src) ELSE 0 END AS bytes FROM {STAGE_SQL} LEFT JOIN documents d ON d.doc_id = o_orderkey WHERE {KEPT})"""


@query(f"SELECT o_orderkey, kind, status FROM {STATUS_SQL}")
def stage_status(spark, d):
    return staged(spark, d).select("o_orderkey", "kind", "status")


def staged(spark, d) -> DataFrame:
    """What became of each artifact, and the bytes moved for it."""
    before = table(spark, d, "documents").select(F.col("doc_id").alias("o_orderkey"), F.lit(True).alias("done"))
    status = F.when(F.col("done"), "skipped_cached").when(F.col("kind") == "cropout", "skipped_missing").when(F.col("o_orderkey") % 11 == 0, "failed").otherwise("copied")
    rows = artifacts(spark, d).join(before, "o_orderkey", "left").withColumn("status", status)
    return rows.withColumn("bytes", F.when(F.col("status") == "copied", 100 * F.length("src")).otherwise(0))


@query(f"SELECT coalesce(status, 'requested') AS status, count(*) AS files, count(DISTINCT o_orderkey) AS records, CAST(sum(bytes) AS BIGINT) AS bytes FROM {STATUS_SQL} GROUP BY ROLLUP (status)")
def stage_report(spark, d):
    """Files, records and bytes by what became of them; ``requested`` is the total."""
    rows = staged(spark, d).rollup("status").agg(F.count("*").alias("files"), F.countDistinct("o_orderkey").alias("records"), F.sum("bytes").alias("bytes"))
    return rows.select(F.coalesce("status", F.lit("requested")).alias("status"), "files", "records", "bytes")


# Scalar functions over columns of text.


@query("""WITH b AS (SELECT l_orderkey, l_linenumber, l_returnflag, l_partkey % 1000 AS x, l_suppkey % 1000 AS y, CAST(l_quantity AS INT) AS w, l_linenumber * 10 AS h FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN x || ',' || y || ',' || w || ',' || h ELSE '0,0,0,0' END AS box FROM b""")
def bbox_parse(spark, d):
    return boxed(spark, d).select("l_orderkey", "l_linenumber", F.array_join(t.box(F.col("bbox")).cast("array<string>"), ",").alias("box"))


@query("SELECT l_orderkey, l_linenumber, greatest(0, x) AS x0, greatest(0, y) AS y0, greatest(0, x) + w AS x1, greatest(0, y) + h AS y1 FROM (SELECT l_orderkey, l_linenumber, l_partkey % 1000 - 500 AS x, l_suppkey % 1000 - 50 AS y, CAST(l_quantity AS INT) AS w, l_linenumber * 10 AS h FROM lineitem)")
def bbox_crop_rect(spark, d):
    b = table(spark, d, "lineitem").selectExpr("l_orderkey", "l_linenumber", "l_partkey % 1000 - 500 as x", "l_suppkey % 1000 - 50 as y", "cast(l_quantity as int) as w", "l_linenumber * 10 as h")
    x, y = F.greatest(F.lit(0), F.col("x")), F.greatest(F.lit(0), F.col("y"))
    return b.select("l_orderkey", "l_linenumber", x.alias("x0"), y.alias("y0"), (x + F.col("w")).alias("x1"), (y + F.col("h")).alias("y1"))


@query("SELECT l_returnflag AS flag, count(*) AS n, CAST(sum(CASE WHEN l_returnflag = 'A' THEN l_partkey % 1000 + CAST(l_quantity AS INT) ELSE 0 END) AS BIGINT) AS x1_sum, CAST(sum(CASE WHEN l_returnflag = 'A' THEN 0 ELSE 1 END) AS BIGINT) AS failed FROM lineitem GROUP BY 1")
def bbox_xyxy(spark, d):
    b = boxed(spark, d).withColumn("a", t.box(F.col("bbox")))
    flag = F.when(F.col("bbox").isNull(), "N").when(F.col("bbox") == "", "R").otherwise("A")
    bad = F.forall("a", lambda v: v == 0).cast("int")
    return b.groupBy(flag.alias("flag")).agg(F.count("*").alias("n"), F.sum(F.get("a", F.lit(0)) + F.get("a", F.lit(2))).alias("x1_sum"), F.sum(bad).alias("failed"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN '76,127,255' WHEN p_size % 3 = 1 THEN '10,20,' || p_size ELSE '0,255,0' END AS rgb FROM part")
def rgb_normalise(spark, d):
    c = F.when(F.col("p_size") % 3 == 0, "(0.3, 0.5, 1.0)").when(F.col("p_size") % 3 == 1, F.concat(F.lit("[10, 20, "), F.col("p_size").cast("string"), F.lit("]"))).otherwise("green")
    return table(spark, d, "part").select("p_partkey", F.array_join(t.rgb(c).cast("array<string>"), ",").alias("rgb"))


@query("SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN p_type WHEN p_size % 4 = 1 THEN p_brand ELSE 'default' END AS rgb FROM part")
def rgb_fallback(spark, d):
    first, second = F.when(F.col("p_size") % 4 == 0, F.col("p_type")).otherwise(""), F.when(F.col("p_size") % 4 == 1, F.col("p_brand"))
    return table(spark, d, "part").select("p_partkey", F.coalesce(F.nullif(first, F.lit("")), F.nullif(second, F.lit("")), F.lit("default")).alias("rgb"))


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN '#AABB0' || '0' WHEN p_size % 3 = 1 THEN '#4CAF50' ELSE '#xyz' END AS hex FROM part")
def hex_normalise(spark, d):
    c = F.when(F.col("p_size") % 3 == 0, "ab0").when(F.col("p_size") % 3 == 1, " #4caf50").otherwise("#xyz")
    return table(spark, d, "part").select("p_partkey", t.hex_colour(c).alias("hex"))


@query("SELECT p_partkey, least(255, greatest(0, p_size * 20 - 100)) || ',' || least(255, greatest(0, 300 - p_size)) || ',' || 20 AS rgb FROM part")
def rgb_clamp(spark, d):
    a = F.array(F.col("p_size") * 20 - 100, F.lit(300) - F.col("p_size"), F.lit(20))
    return table(spark, d, "part").select("p_partkey", F.array_join(t.rgb_clamped(a).cast("array<string>"), ",").alias("rgb"))


@query("SELECT p_partkey, CASE WHEN p_brand = p_type THEN p_brand ELSE p_brand || '|' || p_type END AS alias FROM part")
def alias_dedupe(spark, d):
    a = F.array(F.concat(F.lit(" "), F.col("p_brand")), F.lit(" "), F.col("p_type"), F.concat(F.col("p_brand"), F.lit(" ")), F.lit(None).cast("string"))
    return table(spark, d, "part").select("p_partkey", F.array_join(t.aliases(a), "|").alias("alias"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_name END AS name FROM part")
def trim_null(spark, d):
    c = F.when(F.col("p_size") % 2 == 0, F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))).otherwise("   ")
    return table(spark, d, "part").select("p_partkey", t.trim_null(c).alias("name"))


@query("""SELECT p_partkey, upper(p_brand) AS up, lower(p_type) AS low, upper(left(p_type, 1)) || lower(substr(p_type, 2)) AS cap,
upper(left(p_type, 1)) || lower(substr(p_type, 2)) || ' of ' || array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ') || ' (and) With The' AS title FROM part""")
def case_rules(spark, d):
    name = F.concat(F.concat_ws(" of ", "p_type", "p_name"), F.lit("  (AND) with the"))
    return table(spark, d, "part").select("p_partkey", F.upper("p_brand").alias("up"), F.lower("p_type").alias("low"), t.capitalise(F.col("p_type")).alias("cap"), t.title(name).alias("title"))


@query("SELECT p_partkey, p_name || ', ' || p_type || '/' || p_brand || ' perennial' AS name FROM part")
def separator_normalise(spark, d):
    raw = F.concat(F.lit(" "), F.col("p_name"), F.lit(" ,"), F.col("p_type"), F.lit("  /  "), F.col("p_brand"), F.lit("   perenial"))
    return table(spark, d, "part").select("p_partkey", t.typos(t.separators(raw)).alias("name"))


@query("""SELECT p_partkey, upper(p_brand) AS symbol, lower(p_name) AS common_name, upper(left(p_type, 1)) || lower(substr(p_type, 2)) AS grp, '#' || upper(right('00000' || to_hex(p_partkey % 16777216), 6)) AS hex, p_brand || '|' || p_name AS alias FROM part""")
def species_clean(spark, d):
    return cleaned_species(table(spark, d, "part"))


def cleaned_species(part: DataFrame) -> DataFrame:
    """The species dimension in its normal form."""
    colour = F.lower(F.lpad(F.hex(F.col("p_partkey") % 16777216), 6, "0"))
    return part.select(
        "p_partkey",
        t.trim_null(F.upper("p_brand")).alias("symbol"),
        t.trim_null(F.lower(t.separators(F.col("p_name")))).alias("common_name"),
        t.capitalise(F.col("p_type")).alias("grp"),
        t.hex_colour(colour).alias("hex"),
        F.array_join(t.aliases(F.array("p_brand", "p_name", "p_brand")), "|").alias("alias"),
    )


@query(r"""SELECT page_id, coalesce(nullif(left(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(url)), '\s+', '_', 'g'), '[^a-z0-9._-]', '_', 'g'), '_+', '_', 'g'), '^[_.]+|[_.]+$', '', 'g'), 200), ''), 'unnamed') AS name FROM pages""")
def sanitize_name(spark, d):
    return table(spark, d, "pages").select("page_id", t.safe_name(F.col("url")).alias("name"))


@query("SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN 'MD_' || (1000000 + o_orderkey) || '_' || o_custkey WHEN o_custkey % 3 = 1 THEN 'IMG_20240515_' || (100000 + o_orderkey % 900000) ELSE CAST(10000 + o_orderkey AS VARCHAR) END AS id FROM orders")
def extract_id(spark, d):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    name = F.when(c % 3 == 0, F.concat_ws("_", F.lit("barley_MD"), (k + 1000000).cast("string"), c.cast("string"), F.lit("mask"))).when(c % 3 == 1, F.concat(F.lit("task_IMG_20240515_"), (k % 900000 + 100000).cast("string"))).otherwise(F.concat(F.lit("wheat-"), (k + 10000).cast("string")))
    return table(spark, d, "orders").select("o_orderkey", t.record_id(name).alias("id"))


@query("SELECT o_orderkey, 'x' || o_orderkey AS stem FROM orders")
def stem_strip(spark, d):
    file = F.concat(F.lit("/a/b.c/x"), F.col("o_orderkey").cast("string"), F.lit("_mask.png"))
    return table(spark, d, "orders").select("o_orderkey", t.without_mask(t.stem(file)).alias("stem"))


@query("SELECT n_nationkey, '/mnt/store/' || n_name || '/' || n_regionkey AS path FROM nation")
def path_join(spark, d):
    return table(spark, d, "nation").select("n_nationkey", t.path(F.lit("/mnt/store/"), F.concat(F.lit("/"), F.col("n_name")), F.col("n_regionkey").cast("string")).alias("path"))


@query("SELECT p_partkey, replace(lower(p_name), ' ', '_') AS slug FROM part")
def slug(spark, d):
    return table(spark, d, "part").select("p_partkey", t.slug(F.col("p_name")).alias("slug"))


@query("SELECT page_id, CASE WHEN length(url) > 60 THEN '...' || right(url, 57) ELSE url END AS path, CASE WHEN length(html) > 50 THEN left(html, 47) || '...' ELSE html END AS text FROM pages")
def clip_text(spark, d):
    return table(spark, d, "pages").select("page_id", t.clip_tail(F.col("url")).alias("path"), t.clip_head(F.col("html")).alias("text"))


@query("SELECT p_name, '#' || upper(right('00000' || to_hex(min(p_partkey)), 6)) AS hex, replace(lower(p_name), ' ', '_') AS label FROM part GROUP BY p_name")
def label_table(spark, d):
    least = table(spark, d, "part").groupBy("p_name").agg(F.min("p_partkey").alias("k"))
    return least.select("p_name", t.hex_colour(F.lpad(F.hex("k"), 6, "0")).alias("hex"), t.slug(F.col("p_name")).alias("label"))


@query("""SELECT o_orderkey, year(o_orderdate) AS y, month(o_orderdate) AS m, CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'winter' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'spring' WHEN month(o_orderdate) IN (6, 7, 8) THEN 'summer' ELSE 'fall' END AS season FROM orders""")
def date_parts(spark, d):
    at = F.to_timestamp(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), "yyyy-MM-dd HH:mm:ss")
    return table(spark, d, "orders").select("o_orderkey", F.year(at).cast("long").alias("y"), F.month(at).cast("long").alias("m"), t.season(F.month(at)).alias("season"))


