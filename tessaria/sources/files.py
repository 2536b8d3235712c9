"""Reading and writing result sets, listings, images, nested annotations and manifests."""

from __future__ import annotations

import hashlib
import tempfile
import uuid

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .python import register
from .versions import Versions


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder that the session names in spark.checkpoint.dir; without one, on one machine, a folder of our own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="tessaria-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """``df`` as a table in that folder: what was computed once, and maybe by chance, is the same for all that reads it."""
    at = scratch(df.sparkSession, what)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def write_csv(df: DataFrame, path: str) -> None:
    """Minimal quoting, backslash escapes, one header a file."""
    df.write.option("header", True).option("escape", "\\").option("emptyValue", '""').csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An earlier result set by its schema; empty fields and NaN are null."""
    df = spark.read.schema(schema).option("header", True).option("escape", "\\").option("nullValue", "").csv(path)
    clean = {f.name: F.when(~F.isnan(f.name), F.col(f.name)) for f in schema if isinstance(f.dataType, T.DoubleType | T.FloatType)}
    return df.withColumns(clean) if clean else df


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files that each hold one array of records."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def write_json_arrays(df: DataFrame, path: str, per_file: int = 10_000) -> None:
    """Files that each hold one array of up to ``per_file`` records: a reader takes the first array of a file only."""
    keyed = df.select(F.to_json(F.struct(*df.columns)).alias("j")).withColumn("p", F.floor(F.monotonically_increasing_id() / per_file))
    keyed.groupBy("p").agg(F.concat(F.lit("["), F.array_join(F.collect_list("j"), ","), F.lit("]")).alias("value")).select("value").write.option("maxRecordsPerFile", 1).text(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.json(path)


def write_parquet(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    (df.write.partitionBy(*by) if by else df.write).parquet(path)


def listing(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """path, name, length, modified of files by name pattern; contents aren't read."""
    register(spark)
    return spark.read.format("tessaria_files").schema("path string, name string, length long, modified timestamp").option("pattern", pattern).load(path)


def checksums(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """path, name, length and sha256 of files by name pattern."""
    register(spark)
    return spark.read.format("tessaria_files").schema("path string, name string, length long, sha256 string").option("pattern", pattern).load(path)


def write_files(rows: DataFrame, folder: str) -> DataFrame:
    """Write ``content`` of each row to ``name`` in a folder that all executors see; names, sizes and checksums of what was written.

    Each task writes its own rows, and a task that runs twice writes the same files again.
    """

    def write(it):
        for batch in it:
            fs, base = pafs.FileSystem.from_uri(folder)
            fs.create_dir(base, recursive=True)
            names, contents = batch.column("name").to_pylist(), batch.column("content").to_pylist()
            for name, content in zip(names, contents, strict=True):
                with fs.open_output_stream(f"{base}/{name}") as out:
                    out.write(content)
            sums = [hashlib.sha256(c).hexdigest() for c in contents]
            yield pa.RecordBatch.from_arrays([batch.column("name"), pa.array([len(c) for c in contents], pa.int64()), pa.array(sums, pa.string())], ["name", "bytes", "expected_sha256"])

    return rows.select("name", "content").mapInArrow(write, "name string, bytes long, expected_sha256 string")


def species(spark: SparkSession, path: str) -> DataFrame:
    """A file of ``{"species": {code: {...}}}`` as a row for each code."""
    fields = "struct<class_id:bigint,USDA_symbol:string,common_name:string,group:string>"
    text = spark.read.text(path, wholetext=True)
    held = F.from_json("value", f"struct<species:map<string,{fields}>>")["species"]
    return text.select(F.explode(F.map_entries(held)).alias("e")).select(F.col("e.key").alias("code"), "e.value.*")


def append_manifest(df: DataFrame, path: str, key: str = "record_id") -> int:
    """Commit rows whose record isn't in the manifest yet, one for each; the manifest's new version.

    Two writers may run at once: the one that comes second looks again at what the first has added.
    """

    def new(held: DataFrame | None) -> DataFrame:
        rows = df.dropDuplicates([key])
        return rows if held is None else rows.join(held.select(key), rows[key].eqNullSafe(held[key]), "left_anti")

    return Versions(df.sparkSession, path).append(new)
