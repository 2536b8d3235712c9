"""The registered queries by subject, and the flagship."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import joining, rasters, running, selecting, statistics  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A balanced, filtered, reproducible sample: membership and range, projection, seeded strata."""
    wanted = selecting.specimens(spark, sf_dir).filter(o_orderpriority=["1-URGENT", "2-HIGH", "5-LOW"], o_totalprice={"between": [50000, 400000]})
    return wanted.select("o_orderpriority", "o_orderstatus", "o_totalprice").sample_stratified(["o_orderpriority", "o_orderstatus"], 20, seed=42).all()
