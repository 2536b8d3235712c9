"""Queries on sources and sinks, streams and specs."""

from __future__ import annotations

import json
import struct

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import checked
from ..sources import files, python
from ..sources.versions import Versions
from ..streaming import incremental
from . import specs
from .registry import query, table
from .selecting import SPECIMEN, specimens
from .statistics import METRICS_SQL


@query("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE o_totalprice > 100000")
def reload_csv_results(spark, d):
    rows = specimens(spark, d).filter({"o_totalprice>": 100000}).select("o_orderpriority", "o_totalprice").all()
    files.write_csv(rows, at := files.scratch(spark, "csv"))
    return files.read_csv(spark, at, rows.schema)


@query("SELECT o_orderkey, o_orderstatus, o_custkey FROM orders WHERE o_orderstatus = 'P'")
def reload_json_results(spark, d):
    rows = specimens(spark, d).filter(o_orderstatus="P").select("o_orderstatus", "o_custkey").all()
    files.write_json_arrays(rows, at := files.scratch(spark, "json"))
    return files.read_json_array(spark, at, rows.schema)


@query("SELECT doc_id, text, lang FROM documents")
def sink_csv_roundtrip(spark, d):
    """Texts with line breaks keep them: fields in quotes may span lines."""
    rows = table(spark, d, "documents").select("doc_id", "text", "lang")
    files.write_csv(rows, at := files.scratch(spark, "csv"))
    return spark.read.schema(rows.schema).option("header", True).option("escape", "\\").option("multiLine", True).csv(at)


@query("SELECT p_partkey, p_name, p_type FROM part")
def sink_parquet_roundtrip(spark, d):
    files.write_parquet(table(spark, d, "part").select("p_partkey", "p_name", "p_type"), at := files.scratch(spark, "parquet"), ["p_type"])
    return spark.read.parquet(at)


@query("SELECT event_id, event_type, props FROM events")
def sink_json_roundtrip(spark, d):
    rows = table(spark, d, "events").select("event_id", "event_type", "props")
    files.write_json(rows, at := files.scratch(spark, "json"))
    return spark.read.schema(rows.schema).json(at)


@query("SELECT p_partkey AS class_id, 'c' || p_partkey AS code, p_brand AS USDA_symbol, p_name AS common_name, p_type AS \"group\" FROM part")
def species_dim(spark, d):
    part = table(spark, d, "part")
    entry = F.struct(F.col("p_partkey").alias("class_id"), F.col("p_brand").alias("USDA_symbol"), F.col("p_name").alias("common_name"), F.col("p_type").alias("group"))
    each = part.select(F.floor(F.col("p_partkey") / 500).alias("file"), F.struct(F.concat(F.lit("c"), F.col("p_partkey").cast("string")).alias("key"), entry.alias("value")).alias("e"))
    text = each.groupBy("file").agg(F.to_json(F.struct(F.map_from_entries(F.collect_list("e")).alias("species"))).alias("value"))
    text.select("value").write.option("maxRecordsPerFile", 1).text(at := files.scratch(spark, "species"))
    return files.species(spark, at)


@query("SELECT conv_id AS image_id, turn, role FROM conversations")
def coco_explode(spark, d):
    nested = table(spark, d, "conversations").groupBy("conv_id").agg(F.collect_list(F.struct("turn", "role")).alias("annotations"))
    nested.select(F.struct(F.col("conv_id").alias("id")).alias("image"), "annotations").write.json(at := files.scratch(spark, "coco"))
    python.register(spark)
    read = spark.read.format("tessaria_annotations").schema("image_id long, annotation string").load(at)
    return read.select("image_id", F.from_json("annotation", "turn bigint, role string").alias("a")).select("image_id", "a.turn", "a.role")


def bitmap(grey: list[int], side: int = 8) -> bytes:
    """An uncompressed image of 24 bits a pixel; rows go upwards."""
    rows = [bytes(v for x in grey[y * side : (y + 1) * side] for v in (x, x, x)).ljust((3 * side + 3) // 4 * 4, b"\0") for y in range(len(grey) // side)]
    data = b"".join(reversed(rows))
    return struct.pack("<2sIHHIIiiHHIIiiII", b"BM", 54 + len(data), 0, 0, 54, 40, side, len(rows), 1, 24, 0, len(data), 0, 0, 0, 0) + data


def written_images(spark, d) -> tuple[str, DataFrame]:
    """Each vector as a grey image of eight by eight, written by the executors: the folder, and what was written."""
    grey = F.transform("embedding", lambda x: F.greatest(F.lit(0), F.least(F.lit(255), F.floor((x.cast("double") + 1) * 100))).cast("int"))
    rows = table(spark, d, "embeddings").select(F.concat(F.lit("v"), F.col("vec_id").cast("string"), F.lit(".bmp")).alias("name"), grey.alias("grey"))

    def drawn(it):
        for batch in it:
            yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array([bitmap(g) for g in batch.column("grey").to_pylist()], pa.binary())], ["name", "content"])

    at = files.scratch(spark, "images")
    done = files.write_files(rows.mapInArrow(drawn, "name string, content binary"), at)
    return at, files.stored(done, "images-log")


@query("SELECT 'v' || vec_id || '.bmp' AS name, 246 AS length FROM embeddings")
def list_files(spark, d):
    """Files of a folder by name pattern, from the listing alone; one for each vector was written there."""
    at, _ = written_images(spark, d)
    return files.listing(spark, at, "*.bmp").select("name", "length")


GREY_SQL = "list_sum(list_transform(embedding, lambda x: greatest(0, least(255, CAST(floor((CAST(x AS DOUBLE) + 1) * 100) AS BIGINT)))))"


@query(f"SELECT 'v' || vec_id || '.bmp' AS name, 8 AS height, 8 AS width, 3 AS \"nChannels\", 192 AS bytes, CAST(3 * {GREY_SQL} AS BIGINT) AS total FROM embeddings")
def image_scan(spark, d):
    """A folder of image files, one for each vector, read as images: size, channels and the sum of all bytes."""
    at, _ = written_images(spark, d)
    python.register(spark)
    read = spark.read.format("tessaria_images").schema("name string, height int, width int, channels int, size long, total long").load(at)
    return read.withColumnsRenamed({"channels": "nChannels", "size": "bytes"})


@query(f"SELECT 'v' || vec_id || '.bmp' AS name, CAST(3 * {GREY_SQL} AS BIGINT) AS total FROM embeddings WHERE starts_with('v' || vec_id, 'v1')")
def image_scan_by_name(spark, d):
    """Only files whose names begin so are opened: the source gets the filter."""
    at, _ = written_images(spark, d)
    python.register(spark)
    return spark.read.format("tessaria_images").schema("name string, total long").load(at).filter(F.col("name").startswith("v1"))


@query("SELECT 'v' || vec_id || '.bmp' AS name, 246 AS length, 'ok' AS status FROM embeddings")
def file_checksums(spark, d):
    """Files as they lie in the folder against what should have been written."""
    at, expected = written_images(spark, d)
    found = files.checksums(spark, at, "*.bmp")
    return checked(found, expected, "name").select("name", "length", "status")


@query("SELECT doc_id AS record_id, quality FROM labels")
def manifest_append(spark, d):
    """What is in the manifest isn't appended again."""
    rows = table(spark, d, "labels").select(F.col("doc_id").alias("record_id"), "quality")
    at = files.scratch(spark, "manifest")
    files.append_manifest(rows.filter("quality = 1"), at)
    files.append_manifest(rows, at)
    return Versions(spark, at).read()


@query("SELECT p_partkey, 'p_brand' AS key, p_brand AS value FROM part UNION ALL SELECT p_partkey, 'p_size', CAST(p_size AS VARCHAR) FROM part UNION ALL SELECT p_partkey, 'nested', '{\"name\":\"' || p_name || '\",\"type\":\"' || p_type || '\"}' FROM part")
def metadata_unpivot(spark, d):
    nested = F.to_json(F.struct(F.col("p_name").alias("name"), F.col("p_type").alias("type")))
    part = table(spark, d, "part").select("p_partkey", "p_brand", F.col("p_size").cast("string").alias("p_size"), nested.alias("nested"))
    return part.unpivot("p_partkey", ["p_brand", "p_size", "nested"], "key", "value")


@query("SELECT event_id, user_id, event_type, value FROM events")
def stream_manifest(spark, d):
    """Each record twice in the stream, once in the manifest."""
    events = incremental.source(spark, d, "events").select("event_id", "ts", "user_id", "event_type", "value")
    twice = events.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("copy")).drop("copy")
    incremental.manifest(twice, "event_id", at := files.scratch(spark, "manifest"))
    return spark.read.parquet(at).select("event_id", "user_id", "event_type", "value")


@query(METRICS_SQL)
def stream_metrics(spark, d):
    incremental.metrics(incremental.source(spark, d, "events"), at := files.scratch(spark, "metrics"))
    return incremental.running(spark, at)


def example_specs(spark, d) -> dict:
    s = specimens(spark, d)
    urgent = s.filter(o_orderpriority="1-URGENT").select("o_totalprice")
    return {
        "a": urgent.filter({"o_totalprice>=": 100000}).sort("o_totalprice", "desc").limit(20).spec(),
        "b": urgent.sample_seeded(30, seed=7).spec(),
        "c": s.select("o_totalprice").where("o_custkey > 100").sample_stratified(["o_orderstatus"], 5, seed=1).spec(),
    }


def logged(spark, d) -> str:
    at = files.scratch(spark, "specs")
    specs.log(spark, example_specs(spark, d), at)
    return at


SPEC_A = "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice >= 100000 ORDER BY o_totalprice DESC, o_orderkey LIMIT 20"
SPEC_B = "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT' ORDER BY (o_orderkey * 1103515245 + 7) & 2147483647 LIMIT 30"
SPEC_C = "SELECT o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY md5('1:' || o_orderkey), o_orderkey) AS rn FROM orders WHERE o_custkey > 100) WHERE rn <= 5"


URGENT = '"o_orderpriority": "1-URGENT"'
LOG_SQL = f"""(SELECT 'a' AS spec_id, 'specimen' AS profile, '{{{URGENT}, "o_totalprice>=": 100000}}' AS filters, '[]' AS raw, '["o_totalprice"]' AS projection, '[["o_totalprice", "desc"]]' AS sort,
CAST(20 AS BIGINT) AS limit_n, CAST(NULL AS BIGINT) AS offset_n, '{{}}' AS sample, (SELECT count(*) FROM ({SPEC_A})) AS n_rows
UNION ALL SELECT 'b', 'specimen', '{{{URGENT}}}', '[]', '["o_totalprice"]', '[]', NULL, NULL, '{{"n": 30, "seed": 7, "strategy": "seeded"}}', (SELECT count(*) FROM ({SPEC_B}))
UNION ALL SELECT 'c', 'specimen', '{{}}', '["o_custkey > 100"]', '["o_totalprice"]', '[]', NULL, NULL, '{{"by": ["o_orderstatus"], "per_group": 5, "seed": 1, "strategy": "stratified"}}', (SELECT count(*) FROM ({SPEC_C})))"""
SUMMARY_SQL = f"""SELECT spec_id, profile, left(md5(concat_ws('|', profile, filters, raw, projection, sort, coalesce(CAST(limit_n AS VARCHAR), ''), coalesce(CAST(offset_n AS VARCHAR), ''), sample)), 8) AS fingerprint,
concat_ws('; ', CASE WHEN filters <> '{{}}' THEN 'filters=' || filters END, CASE WHEN raw <> '[]' THEN 'where=' || raw END, CASE WHEN sample <> '{{}}' THEN 'sample=' || json_extract_string(sample, '$.strategy') END, CASE WHEN limit_n IS NOT NULL THEN 'limit=' || limit_n END) AS summary, n_rows FROM {LOG_SQL}"""
PARTS_SQL = " UNION ALL ".join(f"SELECT spec_id, n_rows, '{p}' AS part, CAST({p} AS VARCHAR) AS value FROM {LOG_SQL}" for p in ("filters", "raw", "sample", "limit_n", "sort"))
COMPARE_SQL = f"""WITH p AS ({PARTS_SQL}) SELECT a.spec_id AS left_spec, b.spec_id AS right_spec, a.part, a.value AS left_value, b.value AS right_value, a.n_rows AS left_rows, b.n_rows AS right_rows
FROM p a JOIN p b ON a.part = b.part AND a.spec_id < b.spec_id WHERE a.value IS DISTINCT FROM b.value"""


def with_rows(spark, d, log):
    """A log joined with the number of rows that each of its specs gives now."""
    counts = specs.batch(table(spark, d, "orders"), SPECIMEN, example_specs(spark, d)).groupBy("spec_id").agg(F.count("*").alias("n_rows"))
    return log.join(counts, "spec_id")


@query(f"SELECT * FROM {LOG_SQL}")
def spec_log(spark, d):
    return with_rows(spark, d, specs.load(spark, logged(spark, d)))


@query(SPEC_A)
def spec_replay(spark, d):
    row = specs.load(spark, logged(spark, d)).filter("spec_id = 'a'").first()
    return specs.replay(table(spark, d, "orders"), SPECIMEN, row.asDict()).all()


@query(SUMMARY_SQL)
def spec_summary(spark, d):
    return with_rows(spark, d, specs.summaries(specs.load(spark, logged(spark, d))))


@query(COMPARE_SQL)
def spec_compare(spark, d):
    found = specs.differences(specs.load(spark, logged(spark, d)))
    counts = with_rows(spark, d, specs.load(spark, logged(spark, d))).select("spec_id", "n_rows")
    left = found.join(counts.withColumnsRenamed({"spec_id": "left_spec", "n_rows": "left_rows"}), "left_spec")
    return left.join(counts.withColumnsRenamed({"spec_id": "right_spec", "n_rows": "right_rows"}), "right_spec")


@query(f"SELECT *, 'a' AS spec_id FROM ({SPEC_A}) UNION ALL SELECT *, 'b' FROM ({SPEC_B}) UNION ALL SELECT *, 'c' FROM ({SPEC_C})")
def spec_batch(spark, d):
    return specs.batch(table(spark, d, "orders"), SPECIMEN, example_specs(spark, d))


#: A record of a run as JSON: what it asks for, and where and when it ran.
@query("""SELECT event_id, left(md5('{"filters":{"event_type":"' || event_type || '","user":' || user_id || '},"limit":' || (event_id % 7) || '}'), 8) AS fingerprint FROM events""")
def spec_fingerprint(spark, d):
    """Volatile keys of a record play no part, at any depth, nor does the order of the others."""
    e = table(spark, d, "events").select("event_id", "event_type", "user_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))
    inner = F.struct(F.col("user_id").alias("user"), F.col("event_type"), F.col("at").alias("runtime"))
    spec = F.struct(F.col("at").alias("working_dir"), (F.col("event_id") % 7).alias("limit"), inner.alias("filters"), F.array("at").alias("paths"))
    return specs.with_fingerprints(e.select("event_id", F.to_json(spec).alias("spec")), "spec").select("event_id", "fingerprint")
