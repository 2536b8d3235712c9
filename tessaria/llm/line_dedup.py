"""Line dedup: lines found in many documents stay only in the document with the largest id."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, named, written


def ascii_lower(c: Column) -> Column:
    """A-Z only; the quick ``lower`` is used where the text is all ASCII, for there both agree."""
    slow = F.translate(c, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(slow)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def hashed(key: Column) -> list[Column]:
    """128 bits of the key; rows travel with these instead of the line."""
    return [F.xxhash64(key).alias("__h1"), F.xxhash64(F.lit(1), key).alias("__h2")]


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 3, min_chars: int = 20, prefix: str = "") -> DataFrame:
    """All columns of ``docs`` plus ``n_lines``, ``n_dropped`` and ``kept_text``, each with ``prefix`` before its name.

    Lines are split at newline. A line's key is the line stripped of ASCII white space, A-Z lower-cased. A key of
    ``min_chars`` code points or more that ``min_docs`` documents hold loses all its lines, but for those of the
    largest id that holds it. Rows of one id are one document, so repeated rows count once; all rows with the largest
    id keep the line. A null text is one empty line, an empty text too; null ids are one id, smaller than any other. An
    empty table gives no rows. Very long texts are handled as a whole, in one row. Other columns pass through; columns
    named like the results are replaced.

    Plan: one pass makes (hash, id) distinct, dealt by both, and counts by hash with partial sums; a second pass joins
    the few repeated hashes back to (id, position) rows, a join whose hot keys Spark may split, and gathers the
    positions by document. Only the last join moves texts, once.
    """
    text = F.coalesce(named(text_col), F.lit(""))
    rows = docs.select(named(id_col).alias("__id"), text.alias("__text"))
    lines = F.split(ascii_lower(F.col("__text")), "\n")

    keys = F.array_distinct(F.filter(F.transform(lines, strip), lambda k: F.length(k) >= min_chars))
    repeated = (
        rows.select("__id", F.explode(keys).alias("__key"))
        .select("__id", *hashed(F.col("__key")))
        .distinct()
        .groupBy("__h1", "__h2")
        .agg(F.count("*").alias("__n"), F.max("__id").alias("__keep"))
        .filter(F.col("__n") >= min_docs)
        .select("__h1", "__h2", "__keep")
    )
    repeated = written(repeated, "lines")  # a table's size is known, and a join of two exchanges can be split where a line is hot
    places = (
        rows.select("__id", F.xxhash64("__text").alias("__version"), F.posexplode(lines).alias("__pos", "__line"))
        .select("__id", "__version", "__pos", strip(F.col("__line")).alias("__key"))
        .filter(F.length("__key") >= min_chars)
        .select("__id", "__version", "__pos", *hashed(F.col("__key")))
    )
    drops = (
        places.join(repeated, ["__h1", "__h2"])
        .filter(~F.col("__id").eqNullSafe(F.col("__keep")))
        .groupBy(F.col("__id").alias("__d_id"), F.col("__version").alias("__d_version"))
        .agg(F.collect_set("__pos").alias("__drops"))
    )
    made = [prefix + c for c in ("n_lines", "n_dropped", "kept_text")]
    rest = [named(c) for c in docs.columns if c not in made]
    whole = docs.select(*rest, text.alias("__text"), named(id_col).alias("__id"), F.xxhash64(text).alias("__version"))
    joined = whole.join(drops, F.col("__id").eqNullSafe(F.col("__d_id")) & (F.col("__version") == F.col("__d_version")), "left")
    split = joined.withColumn("__lines", F.split("__text", "\n"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__drops"))
    return split.select(
        *rest,
        F.size("__lines").cast("long").alias(made[0]),
        F.coalesce(F.size("__drops"), F.lit(0)).cast("long").alias(made[1]),
        F.when(F.col("__drops").isNull(), F.col("__text"))
        .otherwise(F.array_join(F.transform(kept, lambda p: F.get(F.col("__lines"), p)), "\n"))
        .alias(made[2]),
    )
