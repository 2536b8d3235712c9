"""Fill-in-middle, hard negatives and exact dedup against plain loops: nulls, empty and long texts, ties, repeated rows."""

from __future__ import annotations

import hashlib
import math
import re
import uuid
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessaria.llm import exact_dedup, fill_in_middle, hard_negatives
from tessaria.streaming.state import ON_DISK

TEXTS = [
    (1, "one\ntwo\nthree"),
    (2, "one\n"),
    (3, "\n"),
    (4, "\n\n\n"),
    (5, ""),
    (6, None),
    (7, "é中🙂\nплюс\n🙂🙂🙂\nascii only\né"),
    (8, "has <P> inside\nand more"),
    (9, "ends with <\nS>"),
    (10, "no newline 🙂 at all"),
    (11, "".join(f"line {i} {'é' * (i % 7)}{'🙂' * (i % 3)}\n" for i in range(20_000))),
    (12, "x" * 300_000 + "🙂" + "y" * 300_000),
    (13, "\r\n\x0b\r\n"),
    (None, "a\nb\nc"),
    (14, "same\ntext\nagain"),
    (14, "same\ntext\nagain"),
    (15, "same\ntext\nagain"),
    *((100 + i, "\n".join("wé🙂"[j % 3] * (j % 5) for j in range(i))) for i in range(60)),
]


def plain_cut(i, text, unit="line", seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    digest = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, t, "kept", -1, "dot") for i, t in TEXTS]
    return spark.createDataFrame(rows, "doc_id long, text string, form string, n int, `odd.name` string").repartition(3)


@pytest.mark.parametrize("unit, rate, spm", [("line", 100, 50), ("char", 60, 30)])
def test_fill_in_middle(spark, texts, unit, rate, spm):
    cut = fill_in_middle.fill_in_middle(texts, unit=unit, rate=rate, spm=spm, prefix="fim_")
    back = fill_in_middle.restored(cut, "fim_output", "fim_form")
    got = sorted(((r.doc_id or -1, r.fim_n, r.fim_form, r.fim_prefix_chars, r.fim_middle_chars, r.fim_output, r.restored, r.form, r.n, r["odd.name"]) for r in back.collect()), key=str)
    want = sorted(((i or -1, *plain_cut(i, t, unit, 7, rate, spm), t or "", "kept", -1, "dot") for i, t in TEXTS), key=str)
    assert got == want
    assert {"plain", "psm", "spm"} <= {g[2] for g in got}
    assert "form" in fill_in_middle.fill_in_middle(texts).columns and fill_in_middle.fill_in_middle(texts).columns.count("form") == 1
    assert fill_in_middle.restored(fill_in_middle.fill_in_middle(texts.limit(0))).count() == 0


def test_places_of_characters():
    for text in ("", "abc", "é", "a🙂b中c", "🙂" * 50 + "x" * 50 + "é" * 3):
        index = fill_in_middle.Exceptions(np.frombuffer(text.encode(), np.uint8))
        chars = np.arange(len(text) + 1)
        at = np.array([len(text[:k].encode()) for k in chars])
        assert index.to_bytes(chars).tolist() == at.tolist() and index.to_chars(at).tolist() == chars.tolist()
        assert len(index) == sum(len(c.encode()) > 1 for c in text)


def test_marks_that_could_be_mistaken():
    for wrong in (("<P>", "<P>", "<M>"), ("aXa", "<S>", "<M>"), ("<P>", "<P>>", "<M>"), ("", "<S>", "<M>"), ("<|", "|>", "x")):
        with pytest.raises(ValueError, match="marks"):
            fill_in_middle.Marks(*wrong)
    own = fill_in_middle.Marks("[pre]", "[suf]", "[mid]")
    got = fill_in_middle.cut([b"a[pr\ne]b\nc"] * 20, list(range(20)), True, 3, 100, 50, own)
    assert all(fill_in_middle.restore(o, f, own) == b"a[pr\ne]b\nc" for o, f in zip(got["output"], got["form"], strict=True)) and set(got["form"]) == {"psm", "spm"}


def test_order_keys():
    numbers = [0, 1, -1, 255, 256, -255, -256, 2**63, -(2**63), 2**63 - 1, 10**400, -(10**400), 10**400 + 1, 2**32, -(2**32)]
    assert sorted(numbers) == sorted(numbers, key=hard_negatives.order_key)
    assert [hard_negatives.from_key(hard_negatives.order_key(n)) for n in numbers] == numbers


def brute_negatives(rows, every=50, positives=5, negatives=3, scale=256):
    good = [(i, [math.floor(scale * Fraction(float(x))) for x in v], label) for i, v, label in rows if None not in (i, v, label) and all(x is not None and np.isfinite(x) for x in v)]
    anchors = {}
    for i, v, label in sorted(good, key=lambda r: (r[1], r[2])):
        if i % every == 0:
            anchors.setdefault(i, (v, label))
    clamp = lambda x: max(-(2**63), min(2**63 - 1, x))
    out = []
    for q, (a, own) in anchors.items():
        scored = sorted((-sum(x * y for x, y in zip(a, v, strict=True)), i, label) for i, v, label in good if i != q and len(v) == len(a))
        for k, (s, i, _) in enumerate([r for r in scored if r[2] == own][:positives]):
            band = [r for r in scored if r[2] != own and 50 * -s <= 100 * -r[0] <= 95 * -s][:negatives]
            out += [(q, i, n + 1, j, clamp(-s), clamp(-t), k + 1) for n, (t, j, _) in enumerate(band)]
    return sorted(out)


@pytest.mark.parametrize("shard", [65_536, 60])
def test_hard_negatives(spark, shard):
    rng = np.random.default_rng(5)
    rows = [(int(i), rng.normal(size=6).astype(np.float32).tolist(), int(rng.integers(0, 4))) for i in range(600)]
    rows += [(1000 + i, [0.5] * 6, i % 2) for i in range(120)]  # ties, of either label
    rows += [(2000, None, 1), (2050, [None] * 6, 1), (2100, [float("nan")] * 6, 1), (2150, [float("inf")] * 6, 1), (None, [0.5] * 6, 1), (2200, [0.5] * 6, None)]
    rows += [(3000, [0.25] * 3, 1), (3001, [0.5] * 3, 1), (3002, [0.375] * 3, 2)]  # of another length
    rows += [(200, [0.125] * 6, 2), (200, [0.125] * 6, 2), (7, rows[7][1], rows[7][2]), (50, [0.0] * 6, 1), (4000, [0.0] * 6, 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS v", "'x' AS keys", "2 AS `odd.name`")
    got = hard_negatives.hard_negatives(df, shard=shard)
    want = brute_negatives(rows)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 100
    assert hard_negatives.hard_negatives(df.limit(0)).count() == 0


@pytest.mark.parametrize("size", [1e5, 1e9, 1e18, 1e150, 1e300])
def test_hard_negatives_of_large_components(spark, size):
    rng = np.random.default_rng(6)
    rows = [(int(i), (np.abs(rng.normal(size=4)) * size * 10.0 ** -rng.integers(0, 3)).tolist(), int(i % 3)) for i in range(150)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = hard_negatives.hard_negatives(df, every=10, shard=40)
    want = brute_negatives(rows, every=10)
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 30


def plain_groups(rows, names=("id",)):
    """(id, keep_id, group_size) of each row, and how many rows of each group stay."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    most = lambda ids: max((i for i in ids if i is not None), default=None)
    return sorted(((i, most(ids), len(ids)) for ids in groups.values() for i in ids), key=str), len(groups)


PART = [(i, f"text {i % 40} é🙂" if i % 3 else f"own {i}") for i in range(150)] + [(200, None), (201, ""), (202, None), (None, "text 1 é🙂"), (None, "only null"), (None, "only null"), (203, "long " * 200_000), (204, "long " * 200_000), (5, "text 5 é🙂"), (5, "text 5 é🙂")]
LATER = [(300 + i, f"text {i} é🙂") for i in range(60)] + [(4, "own 0"), (500, "new"), (501, "new"), (203, "long " * 200_000)]


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.unhex(F.lpad(F.hex(F.length(t) % 50), 4, "0"))])
def test_exact_dedup(spark, tmp_path, digest, monkeypatch):
    """Also by a digest that many texts share and with too many bitmaps to broadcast, over two arrivals of files in small batches."""
    monkeypatch.setattr(exact_dedup, "MOST_BITMAPS", 8_192 if digest is exact_dedup.sha256 else 1)
    at, home = f"{tmp_path}/documents.parquet", f"{tmp_path}/home-{uuid.uuid4().hex}"
    seen, settings = [], {k: spark.conf.get(k, None) for k in ON_DISK}
    for some in (PART, LATER):
        rows = [(i, t, "own", 7, "dot") for i, t in some]
        spark.createDataFrame(rows, "doc_id long, text string, file string, row int, `odd.name` string").repartition(4).write.mode("append").parquet(at)
        seen += some
        found = exact_dedup.exact_dedup(spark, at, digest=digest, home=home, batch_bytes=3_000)
        got = found.collect()
        want, groups = plain_groups(seen)
        assert sorted(((r.id, r.keep_id, r.group_size) for r in got), key=str) == want
        assert sum(r.kept for r in got) == groups and all(r.id == r.keep_id for r in got if r.kept)
        if digest is exact_dedup.sha256:
            left = exact_dedup.surviving(spark, at, found).collect()
            assert len({r.text or "" for r in left}) == len(left) == groups and {(r.file, r.row, r["odd.name"]) for r in left} == {("own", 7, "dot")}
            assert spark.read.option("recursiveFileLookup", True).parquet(f"{home}/groups").count() >= groups  # updates of several batches
    assert settings == {k: spark.conf.get(k, None) for k in ON_DISK}


def test_exact_dedup_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert exact_dedup.exact_dedup(spark, f"{tmp_path}/documents.parquet").count() == 0


def test_exact_dedup_goes_on_after_a_stop(spark, tmp_path, monkeypatch):
    """A run that broke off between its two streams counts nothing twice."""
    at, home = f"{tmp_path}/documents.parquet", f"{tmp_path}/home"
    spark.createDataFrame(PART, "doc_id long, text string").write.parquet(at)

    def broken(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(exact_dedup, "settings", broken)
        with pytest.raises(RuntimeError):
            exact_dedup.watch(spark, at, home)
    got = exact_dedup.exact_dedup(spark, at, home=home).collect()
    assert sorted(((r.id, r.keep_id, r.group_size) for r in got), key=str) == plain_groups(PART)[0]
