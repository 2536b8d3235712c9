"""The corpus pipeline: each stage takes (spark, docs, sf_dir) and gives the documents that the next one reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessaria.llm import jaccard_join, line_dedup, mixing, quality, queries
from tessaria.llm.common import table, written


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go. All columns stay as they are, whatever their names.

    Null and empty texts are scored like others, very long ones as a whole; null metadata are a value of their own;
    repeated rows share their fate; an empty table stays empty.
    """
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model, prefix="__").filter("__keep").select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go from the texts; a text that loses all its lines stays as an empty one, a null one stays null.

    ``n_chars`` follows the text, where the table has it; other columns stay as they are, whatever their names. Rows of
    one id are one document, and repeated rows lose the same lines; of documents with a line that is dropped the one
    with the largest id keeps it, null ids being the least; very long texts are handled as a whole; an empty table
    stays empty.
    """
    kept = line_dedup.dedup_lines(docs, prefix="__")
    lost = F.col("__n_dropped") > 0
    changed = {"text": F.when(lost, F.col("__kept_text")).otherwise(F.col("text")), "n_chars": F.when(lost, F.length("__kept_text").cast("long")).otherwise(F.col("n_chars"))}
    return kept.withColumns({c: v for c, v in changed.items() if c in docs.columns}).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays, and all those without words (null and empty texts).

    It is the one of the least id, null before others, and of equal ids that of the least text hash; of repeated rows
    one stays. Very long texts count as a whole; columns stay as they are, whatever their names; an empty table stays empty.
    """
    return jaccard_join.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the target mixture; those of a second epoch are there twice. Null languages and sources are names of their own.

    Texts without words have no tokens and go with their neighbours in the seeded order; repeated rows are chosen
    together; ties in that order go by id, tokens and text hash; very long texts count as wholes; columns stay as they
    are, whatever their names; an empty table stays empty.
    """
    return mixing.mixed_documents(docs, queries.mix_levels(), **queries.MIX)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens, and digests of token ids, offsets and decoded text of each document, a row for each row.

    A null text is an empty one and has no tokens; repeated rows have equal results; very long texts are encoded as a
    whole; columns other than the id and these are not passed on; an empty table gives no rows.
    """
    return queries.encoded_and_decoded(docs)


STAGES = [("quality_classifier", classify), ("line_dedup", drop_lines), ("ngram_jaccard_join", one_of_each), ("mixing", mix), ("byte_bpe", encode)]

#: The classifier and the tokenizer can't be put into SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
