"""Exact dedup of files that arrive: a stream keeps, by digest, which document stays and where its content lies."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming.state import ON_DISK, settings
from .common import named, shared_dir, written

#: A batch of the stream takes about so much of the files; none is too old to count.
BATCH_BYTES, ANY_AGE = 64 << 30, "365000d"
#: Rows of a file that share one bitmap of four kilobytes, as Spark's bitmap functions have it.
BITS = 32_768
#: So many bitmaps at most (32 MB, up to 268 million rows) are broadcast; more are joined, for which texts are dealt by file.
MOST_BITMAPS = 8_192

ARRIVAL = "id bigint, digest binary, file string, row bigint"
STATE_ROW = "digest binary, n bigint, keep struct<id:bigint,file:string,row:bigint>"


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _located(docs: DataFrame) -> tuple[Column, Column]:
    """Where a row's content lies: its file and its place there, which every read of the files gives alike."""
    at = docs.metadataColumn("_metadata")
    return at["file_path"].alias("file"), at["row_index"].alias("row")


def _texts(docs: DataFrame, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    text = F.coalesce(named(text_col), F.lit(""))
    return docs.select(*_located(docs), digest(text).alias("digest"), text.alias("text"))


def _marks(rows: DataFrame) -> DataFrame:
    """The rows of each stretch of a file as one bitmap, as a table."""
    place = rows.select("file", F.floor(F.col("row") / BITS).alias("stretch"), (F.col("row") % BITS).alias("bit"))
    return written(place.groupBy("file", "stretch").agg(F.bitmap_construct_agg("bit").alias("bits")), "marks")


def _marked(texts: DataFrame, marks: DataFrame, most: int | None = None) -> DataFrame:
    """Rows of the files whose bit is set. Where their number allows, bitmaps are broadcast, so that no other text moves."""
    few = marks.count() <= (MOST_BITMAPS if most is None else most)
    met = texts.withColumn("stretch", F.floor(F.col("row") / BITS)).join(F.broadcast(marks) if few else marks, ["file", "stretch"])
    octet = F.ascii(F.decode(F.substring(F.col("bits"), F.floor((F.col("row") % BITS) / 8).cast("int") + 1, 1), "ISO-8859-1"))
    return met.filter(F.floor(octet / F.pow(F.lit(2), F.col("row") % 8)) % 2 == 1).drop("stretch", "bits")


def watch(spark: SparkSession, path: str, home: str, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256, batch_bytes: int = BATCH_BYTES) -> None:
    """Take in the files at ``path`` that were not seen before, under the state at ``home``; ends when there are no more.

    One stream turns rows into (id, digest, file, row), the next keeps in its state, by digest and for ever, how many
    rows have it and which stays, with its file and row. Both go on from their checkpoints, so a run that is stopped
    loses nothing and counts nothing twice. Copies are counted in each task first, so a text with very many is a few rows
    of the shuffle.
    """
    schema = spark.read.parquet(path).schema
    at = path.rstrip("/")
    only = f"{at[:-1]}[{at[-1]}]"  # a pattern that this path alone meets, be it a file or a folder
    stream = lambda: spark.readStream.option("maxFileAge", ANY_AGE).option("maxBytesPerTrigger", batch_bytes)
    docs = stream().schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).parquet(only)
    arriving = docs.select(named(id_col).cast("bigint").alias("id"), digest(F.coalesce(named(text_col), F.lit(""))).alias("digest"), *_located(docs))
    arriving.writeStream.format("parquet").option("path", f"{home}/arrivals").option("checkpointLocation", f"{home}/arrivals-state").trigger(availableNow=True).start().awaitTermination()

    def changed(df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{home}/groups/batch={number}")

    with settings(spark, ON_DISK):
        groups = stream().schema(ARRIVAL).parquet(f"{home}/arrivals").groupBy("digest").agg(F.count("*").alias("n"), F.max(F.struct("id", "file", "row")).alias("keep"))
        groups.writeStream.outputMode("update").foreachBatch(changed).option("checkpointLocation", f"{home}/groups-state").trigger(availableNow=True).start().awaitTermination()


def exact_dedup(
    spark: SparkSession,
    path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256,
    home: str | None = None,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """A row for each row of the files at ``path``: ``id``, ``keep_id``, ``group_size``, ``kept``, ``digest``, ``file``, ``row``.

    Rows of one text are a group, of which the row with the largest id stays; of several rows with that id the last by
    file and place. A second call with the same ``home`` reads only files that came since, and gives all rows.

    Texts whose digest was met before are hits: their bytes are read again and compared with those of the row that
    stays, found by its locator. If some differ, the rows of that digest are grouped anew by their whole texts, so
    groups are right whatever ``digest`` is; it should give few texts the same value.

    A null text is an empty one; a null id is smaller than any other, and ``keep_id`` is null where all ids are;
    repeated rows are copies of each other; an empty table gives no rows; very long texts are compared as a whole;
    other columns aren't read. Everything is expressions of Spark; texts move for the comparison of hits alone.
    """
    home = home or f"{shared_dir(spark)}/exact-{uuid.uuid4().hex}"
    watch(spark, path, home, id_col, text_col, digest, batch_bytes)
    docs = spark.read.parquet(path)
    # rows from files of the state alone: those that come while this runs are for the next call
    arrivals = spark.read.schema(ARRIVAL).parquet(f"{home}/arrivals")
    states = spark.read.schema(STATE_ROW + ", batch int").option("basePath", f"{home}/groups").option("recursiveFileLookup", False).parquet(f"{home}/groups") if _exists(spark, f"{home}/groups") else spark.createDataFrame([], STATE_ROW)
    latest = written(states.groupBy("digest").agg(F.max(F.struct("n", "keep")).alias("s")).select("digest", "s.*"), "groups")  # n only grows
    rows = written(arrivals.join(latest, "digest"), "grouped")
    found = rows.select("id", F.col("keep.id").alias("keep_id"), F.col("n").alias("group_size"), ((F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))).alias("kept"), "digest", "file", "row")

    texts = _texts(docs, text_col, digest)
    repeated = found.filter("group_size > 1")
    stay = written(_marked(texts, _marks(repeated.filter("kept"))).select("digest", F.col("text").alias("stays")), "stays")
    differ = _marked(texts, _marks(repeated.filter("not kept"))).join(stay, "digest").filter("text <> stays").select("digest")
    differ = written(differ, "differ")
    if differ.isEmpty():
        return found
    odd = written(differ.distinct(), "odd")
    again = found.join(odd, "digest", "left_semi")
    whole = _marked(texts, _marks(again)).select("digest", "text", "file", "row").join(again.select("id", "file", "row"), ["file", "row"])
    groups = written(whole.groupBy("digest", "text").agg(F.count("*").alias("group_size"), F.max(F.struct("id", "file", "row")).alias("keep")), "texts")
    redone = whole.join(groups, ["digest", "text"])
    kept = (F.col("file") == F.col("keep.file")) & (F.col("row") == F.col("keep.row"))
    return found.join(odd, "digest", "left_anti").unionByName(redone.select("id", F.col("keep.id").alias("keep_id"), "group_size", kept.alias("kept"), "digest", "file", "row"))


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def surviving(spark: SparkSession, path: str, found: DataFrame) -> DataFrame:
    """The rows of the files at ``path`` that stay, with all their columns."""
    docs = spark.read.parquet(path)
    file, row = _located(docs)
    rows = docs.select(F.struct(*map(named, docs.columns)).alias("doc"), file, row)
    return _marked(rows, _marks(found.filter("kept"))).select("doc.*")
