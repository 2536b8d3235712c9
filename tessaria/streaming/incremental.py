"""Incremental manifests and running metrics with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import scratch
from .state import ON_DISK, settings


def source(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The files of a table as a stream; none is too old to count, however much later others came."""
    schema = spark.read.parquet(f"{path}/{name}.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).option("maxFileAge", "365000d").parquet(f"{path}/{name}*")


def manifest(records: DataFrame, key: str, to: str, state: str | None = None) -> None:
    """Append each record once, however late and however often it comes again; of rows with one id one is taken.

    The ids lie in the stream's state (on the executors' disks, by hash range, changes in the checkpoint at ``state``) for
    ever, so a batch reads nothing that was written before. The sink lists a batch's files when all are there: a run that
    is stopped and started again with the same ``state`` loses and doubles nothing. A null id is an id.
    """
    with settings(records.sparkSession, ON_DISK):
        sink = records.dropDuplicates([key]).writeStream.format("parquet").option("path", to).outputMode("append")
        query = sink.option("checkpointLocation", state or f"{to.rstrip('/')}.state").trigger(availableNow=True).start()
    query.awaitTermination()


def metrics(events: DataFrame, to: str) -> None:
    """Sums by batch are appended as they arrive; readers add them up, so a batch that runs twice counts once."""
    spark = events.sparkSession

    def batch(df: DataFrame, number: int) -> None:
        done = F.col("event_type") != "error"
        part = df.agg(F.count_if(done).alias("processed"), F.count_if(F.col("event_type") == "view").alias("skipped"), F.count_if(~done).alias("failed"), F.coalesce(F.sum(F.when(done, F.col("value"))), F.lit(0.0)).alias("total"))
        part.write.mode("overwrite").parquet(f"{to}/batch={number}")

    q = events.writeStream.foreachBatch(batch).option("checkpointLocation", scratch(spark, "stream-state")).trigger(availableNow=True).start()
    q.awaitTermination()


def running(spark: SparkSession, at: str) -> DataFrame:
    parts = spark.read.option("basePath", at).parquet(at)
    mean = F.coalesce(F.sum("total") / F.nullif(F.sum("processed"), F.lit(0)), F.lit(0.0))
    return parts.agg(F.sum("processed").alias("processed"), F.sum("skipped").alias("skipped"), F.sum("failed").alias("failed"), F.round(mean, 4).alias("avg_ms"))


