"""Where streams keep their state."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: State lies in RocksDB on the executors' disks, with its changes in the checkpoint; its memory is bounded by executor.
ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "8",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",  # streams here end when all is read, so a task's state needn't stay open
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # else each partition takes megabytes before it has a row
}


@contextmanager
def settings(spark: SparkSession, of: Mapping[str, str]) -> Iterator[None]:
    """These settings of the session, and afterwards those from before; a stream keeps the ones that it was started with."""
    before = {k: spark.conf.get(k, None) for k in of}
    try:
        for k, v in of.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
