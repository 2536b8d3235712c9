"""Columns with dots and backquotes in their names pass through all operators."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tessaria.llm import bpe, fill_in_middle, jaccard_join, line_dedup, mixing, quality, secret_scan

LINE = "a line of more than twenty characters that all have"
NAMES = ["odd.name", "text.text", "a`b"]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, f"{' '.join(f'w{i}x{j}' for j in range(40))}\n{LINE}", "en", f"src{i % 3}", 7, f"d{i}", i, None) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, c1 string, c2 int, c3 string")
    return df.withColumnsRenamed(dict(zip(("c1", "c2", "c3"), NAMES, strict=True)))


@pytest.mark.parametrize(
    "operator",
    [
        line_dedup.dedup_lines,
        secret_scan.scan_secrets,
        fill_in_middle.fill_in_middle,
        jaccard_join.one_of_each,
        lambda d: mixing.mixed_documents(d, {"lang": F.col("lang")}, {}),
        lambda d: quality.score_quality(d, quality.fit_quality(d, d.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality")))),
        bpe.encode,
        lambda d: bpe.decode(bpe.encode(d)),
        bpe.encode_decode,
    ],
    ids=["lines", "secrets", "middle", "near", "mixing", "quality", "encode", "decode", "both"],
)
def test_odd_names(odd, operator):
    if operator in (bpe.encode, bpe.encode_decode):
        pytest.importorskip("public_tokenizers")
    out = operator(odd)
    assert [c for c in out.columns if c in NAMES] == NAMES
    got = {r["doc_id"]: (r["odd.name"], r["text.text"], r["a`b"]) for r in out.collect()}
    assert got == {i: (f"d{i}", i, None) for i in range(12)}
