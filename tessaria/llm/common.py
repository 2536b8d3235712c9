"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six characters that separate words and are stripped from lines.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees; one of our own only where the session names none (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tessaria-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def written(df: DataFrame, what: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back, so that a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of whole texts that go to a Python worker at a time, at most.
BATCH_ROWS = 2_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def whole_texts(rows: DataFrame) -> DataFrame:
    """``rows`` with texts, on their way to Python: the session's Arrow batches are made no larger than BATCH_ROWS rows.

    Ten thousand rows of long texts would take tens of megabytes in the executor, twice, and in each worker.
    """
    conf = rows.sparkSession.conf
    if not 0 < int(conf.get(_BATCH)) <= BATCH_ROWS:
        conf.set(_BATCH, BATCH_ROWS)
    return rows


def ends_clean(run):
    """``run`` for mapInArrow, giving memory back to the system at its end: Spark keeps Python workers from task to task."""

    @functools.wraps(run)
    def clean(it):
        import pyarrow as pa

        try:
            yield from run(it)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return clean


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body``, inside any expression."""
    return F.element_at(F.transform(F.array(value), body), 1)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def named(name: str) -> Column:
    """The column of this name, dots and all."""
    return F.col(quoted(name))


def passing(names: list[str]) -> list[Column]:
    """Columns under plain names, in order, for mapInArrow, which takes no name with a dot; a task passes them on by place."""
    return [named(c).alias(f"__passed{k}") for k, c in enumerate(names)]


def fields(df: DataFrame, names: list[str]) -> list[str]:
    """Their parts of a schema in text."""
    return [f"{quoted(c)} {df.schema[c].dataType.simpleString()}" for c in names]


LONG = 2**63


def order_key(n: int) -> bytes:
    """Bytes that are ordered as the integers are, of any size: sign, length, magnitude; all but the sign inverted below 0."""
    size = (abs(n).bit_length() + 7) // 8
    body = size.to_bytes(4) + abs(n).to_bytes(size)
    return b"\x80" + body if n >= 0 else b"\x7f" + bytes(255 - x for x in body)


def from_key(key: bytes) -> int:
    body = key[1:] if key[0] == 0x80 else bytes(255 - x for x in key[1:])
    n = int.from_bytes(body[4:])
    return n if key[0] == 0x80 else -n


def key_as_long(key: Column) -> Column:
    """The integer of an order key as a long; beyond a long's ends, these."""
    positive = F.substring(F.hex(key), 1, 2) == "80"
    digits = F.substring(F.hex(key), 11, 1 << 20)
    size = F.length(digits) / 2
    flipped = F.translate(digits, "0123456789ABCDEF", "FEDCBA9876543210")
    value = lambda h: F.coalesce(F.conv(F.nullif(F.right(h, F.lit(16)), F.lit("")), 16, 10).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    above = F.when((size > 8) | (value(digits) > LONG - 1), F.lit(LONG - 1)).otherwise(value(digits).cast("long"))
    below = F.when((size > 8) | (value(flipped) > LONG - 1), F.lit(-LONG)).otherwise((-value(flipped)).cast("long"))
    return F.when(positive, above).otherwise(below)
