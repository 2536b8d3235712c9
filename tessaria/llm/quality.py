"""Quality classifier by co-training: a view of the text and a view of the metadata teach each other, then are combined."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .common import ends_clean, fields, named, partitions, passing, quoted, whole_texts, written
from .hashing import Words, groups, mix

#: Rows of the labelled sample at most; of five of them three train, one calibrates and one combines.
LABELLED = 4_000
#: Rounds of exchange; share of all unlabelled documents that a view hands on in the first round (in round r: r times it).
ROUNDS, SHARE = 3, 0.1
#: Pseudo-labelled rows of a class weigh so much together at most, as a share of what the class's labelled rows weigh.
PSEUDO = 0.5
#: Newton steps for the text view in each round, and how often one of them may be halved.
STEPS, POOL_HALVINGS = 2, 10
#: Buckets of hashed words; scores of all documents are counted in so many bins of the logit's inverse hyperbolic sine, which
#: from -LIMIT to LIMIT takes in logits up to 1e17.
WORD_BUCKETS, BINS, LIMIT = 128, 4_000, 40.0
#: A metadata value is known by itself if at least one in FREQUENT documents has it, so each feature has no more such values;
#: the others of a feature share RARE buckets. A value's rate counts as SMOOTH more documents of the general rate.
FREQUENT, RARE, SMOOTH = 4_096, 256, 20.0

_CLASSES = 12
_CLASS = np.full(256, 8, np.uint8)
for _i, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\x0b\x0c", b"\n", b".,;:'\"-()", b"!?", b"#*%$&@|~^_<>=+{}[]\\/`")):
    _CLASS[list(_chars)] = _i
_CLASS[0x80:0xC0] = 9
_CLASS[0xC0:0xE0] = 10
_CLASS[0xE0:] = 11
_PAIRS = _CLASSES**2
TEXT_FEATURES = _PAIRS + WORD_BUCKETS + 6
#: Bytes of texts whose features are made at a time, and bytes of a text whose pairs are counted at a time.
GROUP_BYTES, SLICE = 500_000, 65_536


def text_features(texts: list[bytes]) -> np.ndarray:
    """Shares of pairs of character classes and of hashed words, and how long, varied and repetitive the words are.

    Whole texts, a row each; values as half-precision numbers hold them.
    """
    out = np.zeros((len(texts), TEXT_FEATURES), np.float32)
    if not texts:
        return out
    sizes = np.array([len(t) for t in texts])
    words = Words(texts)
    kinds = _CLASS[words.data]
    pair = kinds[:-1] * np.uint8(_CLASSES) + kinds[1:]
    end = np.cumsum(sizes + 1) - 1
    for i, (a, b) in enumerate(zip((end - sizes).tolist(), (end - 1).tolist(), strict=True)):
        for s in range(a, b, SLICE):
            out[i, :_PAIRS] += np.bincount(pair[s : min(s + SLICE, b)], minlength=_PAIRS)
    out[:, :_PAIRS] = np.sqrt(out[:, :_PAIRS] / np.maximum(sizes, 1)[:, None])
    count = np.diff(words.first)
    h = words.hashes()
    n = np.maximum(count, 1)
    bucket = np.bincount(words.text * WORD_BUCKETS + (h >> np.uint64(57)).astype(np.int64), minlength=len(texts) * WORD_BUCKETS)
    out[:, _PAIRS : _PAIRS + WORD_BUCKETS] = np.sqrt(bucket.reshape(len(texts), -1) / n[:, None])
    order = np.lexsort((h, words.text))
    same = np.zeros(len(h), np.int64)
    same[1:] = (h[order][1:] == h[order][:-1]) & (words.text[order][1:] == words.text[order][:-1])
    next_same = np.zeros(len(h), np.int64)
    next_same[1:] = (h[1:] == h[:-1]) & (words.text[1:] == words.text[:-1])
    total = lambda x, by: np.bincount(by, x, len(texts))
    repeated = total(same, words.text[order])
    out[:, -6] = np.log1p(sizes) / 10
    out[:, -5] = np.log1p(count) / 10
    out[:, -4] = np.minimum(total(words.ends - words.starts, words.text) / n / 10, 1_000)
    out[:, -3] = repeated / n
    out[:, -2] = np.log1p(count - repeated) / np.log1p(n)
    out[:, -1] = total(next_same, words.text) / n
    return out.astype(np.float16).astype(np.float32)


def meta_codes(docs: DataFrame, columns: Sequence[str]) -> Column:
    """Hashes of each metadata value and of each pair of values; a number counts by its size (thirds of powers of two)."""

    def value(c: str) -> Column:
        v = named(c)
        if isinstance(docs.schema[c].dataType, NumericType):
            x = v.cast("double")
            return F.when(~F.isnan(x), F.floor(F.log2(1 + F.abs(x)) * 3))
        return v.cast("string")

    one = [F.xxhash64(F.lit(k), value(c)) for k, c in enumerate(columns)]
    two = [F.xxhash64(F.lit(1_000 + k), value(a), value(b)) for k, (a, b) in enumerate(combinations(columns, 2))]
    return F.array(*one, *two) if columns else F.array().cast("array<bigint>")


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def newton_sums(x: np.ndarray, y: np.ndarray, weight: np.ndarray, w: np.ndarray) -> np.ndarray:
    """What rows add to a Newton step at ``w``: the gradient, then the Hessian by rows; the bias is the last coefficient."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    p = _sigmoid(x @ w)
    g = x.T @ (weight * (p - y))
    return np.concatenate([g, ((x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x).reshape(-1)])


def losses(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ws: np.ndarray) -> np.ndarray:
    """What rows add to the logistic loss at each row of ``ws``."""
    z = x @ ws[:, :-1].T + ws[:, -1]
    return weight @ (np.logaddexp(0, z) - y[:, None] * z)


def ridge(d: int) -> np.ndarray:
    """1 for each coefficient, hardly anything for the bias."""
    return np.append(np.ones(d - 1), 1e-3)


#: Steps of Newton's method at most, and halvings of one.
MOST_STEPS, HALVINGS = 200, 30
#: A fit ends where the next step promises less than this share of the loss.
ENOUGH = 1e-14


def damped_step(w: np.ndarray, sums: np.ndarray, loss_at, penalty: np.ndarray, towards: np.ndarray, halvings: int = HALVINGS) -> np.ndarray:
    """The coefficients after ``w``: a Newton step, halved until the penalised loss falls enough; ``w`` if it never does.

    ``sums``: see newton_sums; ``loss_at`` gives the loss of all rows at each row of a matrix; ``penalty`` by
    coefficient draws coefficients ``towards`` others. The penalised loss never rises.
    """
    d = len(w)
    g = sums[:d] + penalty * (w - towards)
    move = -np.linalg.solve(sums[d:].reshape(d, d) + np.diag(penalty), g)
    lengths = np.append(0.5 ** np.arange(halvings + 1), 0.0)
    tried = w + lengths[:, None] * move
    total = loss_at(tried) + ((tried - towards) ** 2) @ penalty / 2
    if -(g @ move) <= ENOUGH * (1 + total[-1]):
        return w
    low = np.flatnonzero(total[:-1] <= total[-1] + 1e-4 * lengths[:-1] * (g @ move))
    return tried[low[0]] if len(low) else w


def fit(x: np.ndarray, y: np.ndarray, penalty: np.ndarray | None = None, towards: np.ndarray | None = None) -> np.ndarray:
    """Logistic regression with a bias as last coefficient, by damped Newton steps until these gain nothing."""
    d = x.shape[1] + 1
    penalty, towards = ridge(d) if penalty is None else penalty, np.zeros(d) if towards is None else towards
    x, w, ones = x.astype(np.float64), towards.copy(), np.ones(len(x))
    for _ in range(MOST_STEPS):
        before, w = w, damped_step(w, newton_sums(x, y, ones, w), lambda ws: losses(x, y, ones, ws), penalty, towards)
        if w is before:
            return w
    raise RuntimeError(f"the regression did not converge in {MOST_STEPS} steps")


def fit_positive(x: np.ndarray, y: np.ndarray, penalty: np.ndarray, towards: np.ndarray) -> np.ndarray:
    """``fit`` with coefficients not below 0 (the bias may be): the best of the fits on each set of columns that has none."""
    best, least = None, math.inf
    for n in range(x.shape[1], -1, -1):
        for some in combinations(range(x.shape[1]), n):
            own = [*some, x.shape[1]]
            w = np.zeros(x.shape[1] + 1)
            w[own] = fit(x[:, list(some)], y, penalty[own], towards[own])
            total = losses(x, y, np.ones(len(x)), w[None])[0] + penalty @ (w - towards) ** 2 / 2
            if w[:-1].min(initial=0) >= 0 and total < least:
                best, least = w, total
    return best


def logit(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


@dataclass
class Model:
    """Both views, their calibrations (slope, bias), the weights of the combination, and what was exchanged by round.

    ``exchanged``: counts of good and bad documents handed to the metadata view, then to the text view; ``lift``: how
    much surer than the general rate those were on labelled rows kept out of training, which is what they weighed.
    """

    meta: list[str]
    constant: float | None = None
    text_w: np.ndarray = field(default_factory=lambda: np.zeros(TEXT_FEATURES + 1))
    frequent: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    rates: np.ndarray = field(default_factory=lambda: np.zeros(0))
    prior: float = 0.0
    text_cal: tuple[float, float] = (1.0, 0.0)
    meta_cal: tuple[float, float] = (1.0, 0.0)
    both: tuple[float, float, float] = (1.0, 0.0, 0.0)
    exchanged: list[tuple[int, int, int, int]] = field(default_factory=list)
    lift: list[tuple[float, float, float, float]] = field(default_factory=list)

    def index(self, codes: np.ndarray) -> np.ndarray:
        """Places of values in ``rates``: frequent ones first, then each feature's buckets of the others."""
        bucket = len(self.frequent) + np.arange(codes.shape[1]) * RARE + (codes.view(np.uint64) >> np.uint64(56)).astype(np.int64)
        if not len(self.frequent):
            return bucket
        at = np.minimum(np.searchsorted(self.frequent, codes), len(self.frequent) - 1)
        return np.where(self.frequent[at] == codes, at, bucket)

    def text_logit(self, text: np.ndarray) -> np.ndarray:
        return self.text_cal[0] * logit(text, self.text_w) + self.text_cal[1]

    def meta_raw(self, codes: np.ndarray) -> np.ndarray:
        return self.prior + self.rates[self.index(codes)].sum(1)

    def meta_logit(self, codes: np.ndarray) -> np.ndarray:
        return self.meta_cal[0] * self.meta_raw(codes) + self.meta_cal[1]

    def score(self, text: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probabilities of a good document: by text, by metadata, by both."""
        if self.constant is not None:
            p = np.full(len(text), self.constant)
            return p, p, p
        a, b = self.text_logit(text), self.meta_logit(codes)
        return _sigmoid(a), _sigmoid(b), _sigmoid(self.both[0] * a + self.both[1] * b + self.both[2])

    def learn_rates(self, counts: np.ndarray) -> None:
        """From weights of good and of bad documents by value: how far each value's smoothed rate lies from the general one."""
        good, bad = counts.reshape(2, -1)
        p = float(_sigmoid(np.array(self.prior)))
        r = np.clip((good + SMOOTH * p) / (good + bad + SMOOTH), 1e-9, 1 - 1e-9)
        self.rates = np.log(r / (1 - r)) - self.prior


def _calibrated(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    w = fit(z[:, None], y, np.full(2, 0.1), np.array([1.0, 0.0]))
    return float(w[0]), float(w[1])


def _value_counts(index: np.ndarray, y: np.ndarray, weight: np.ndarray, size: int) -> np.ndarray:
    times = index.shape[1]
    return np.concatenate([np.bincount(index.reshape(-1), np.repeat(weight * (y == label), times), size) for label in (1, 0)])


def _codes(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def _halves(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float16).reshape(len(column), -1).astype(np.float64)


def summed(rows: DataFrame, per_batch, size: int) -> np.ndarray:
    """The sum over all batches of ``per_batch(text, codes)``, a vector of ``size`` numbers.

    A task gives one vector, as many tasks as the root of the number of partitions add those up, and only theirs come
    to the driver.
    """

    def part(it):
        total = np.zeros(size)
        for batch in it:
            for a in range(0, batch.num_rows, 4_096):
                some = batch.slice(a, 4_096)
                total += per_batch(_halves(some.column("text")), _codes(some.column("meta")))
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["v"])

    def add(it):
        total = np.zeros(size)
        for batch in it:
            for v in batch.column("v").to_pylist():
                total += np.frombuffer(v)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["v"])

    few = math.ceil(math.sqrt(partitions(rows.sparkSession)))
    parts = rows.select("text", "meta").mapInArrow(ends_clean(part), "v binary").repartition(few).mapInArrow(add, "v binary")
    total = np.zeros(size)
    for v in parts.toLocalIterator():
        total += np.frombuffer(bytes(v.v))
    return total


def _bin(z: np.ndarray) -> np.ndarray:
    """Bins of equal width in the inverse hyperbolic sine, so that none of the surest scores share an end bin."""
    return np.clip(((np.arcsinh(z) + LIMIT) / (2 * LIMIT) * BINS).astype(np.int64), 0, BINS - 1)


def chance(text: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """A number from 0 to 1 by row, from a hash of its features: it says which rows of a bin are handed on."""
    odd = (np.arange(1, text.shape[1] + codes.shape[1] + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    bits = np.hstack([text.astype(np.float16).view(np.uint16).astype(np.uint64), codes.astype(np.int64).view(np.uint64).reshape(len(text), -1)])
    return (mix((bits * odd).sum(1, dtype=np.uint64)) >> np.uint64(11)).astype(np.float64) / 2.0**53


@dataclass(frozen=True)
class Picked:
    """The surest documents of a view: those above bin ``hi`` and below ``lo``, and shares of these two bins themselves."""

    hi: int = BINS
    top: float = 0.0
    lo: int = -1
    end: float = 0.0
    weights: tuple[float, float] = (0.0, 0.0)

    def pseudo(self, bins: np.ndarray, drawn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows handed on, their labels and weights."""
        good = (bins > self.hi) | ((bins == self.hi) & (drawn < self.top))
        some = np.flatnonzero(good | (bins < self.lo) | ((bins == self.lo) & (drawn < self.end)))
        y = good[some].astype(float)
        return some, y, np.where(y == 1, *self.weights)


def _surest(hist: np.ndarray, good: int, bad: int) -> Picked:
    """The surest ``good`` and ``bad`` documents by rank; of the last bin a share. Where both ends meet (all scores alike), none."""
    from_top, from_end = np.cumsum(hist[::-1])[::-1], np.cumsum(hist)
    hi = int(np.flatnonzero(from_top >= min(good, hist.sum()))[-1])
    lo = int(np.flatnonzero(from_end >= min(bad, hist.sum()))[0])
    if hi <= lo:
        return Picked()
    return Picked(hi, (good - (from_top[hi] - hist[hi])) / hist[hi], lo, (bad - (from_end[lo] - hist[lo])) / hist[lo])


def _lift(bins: np.ndarray, y: np.ndarray, hi: int, lo: int, prior: float) -> tuple[float, float]:
    """How much surer than the general rate the labels above and below are: 0 for no surer, 1 for always right."""
    out = []
    for chosen, right, rate in ((bins >= hi, y == 1, prior), (bins <= lo, y == 0, 1 - prior)):
        precision = ((chosen & right).sum() + 2 * rate) / (chosen.sum() + 2)
        out.append(float(max(0.0, (precision - rate) / (1 - rate))))
    return out[0], out[1]


def co_train(model: Model, pool: DataFrame, text: np.ndarray, codes: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, share: float = SHARE, pseudo: float = PSEUDO) -> Model:
    """Fit both views on labelled rows (arrays); each round, what one is surest of in ``pool`` trains the other too.

    ``pool`` (text, meta: see fit_quality) is all unlabelled documents. By rank, a view hands on the surest ``share`` of
    them (times the round), good and bad ones in the shares of the labels. All of them take part: their sums
    are added up where they lie. Those of a class weigh ``pseudo`` of its labelled rows together, times their lift on the rows
    kept for calibration, so that a view without power over the prior can't mislead the other.
    """
    part = np.arange(len(y)) % 5
    usable = all(len(set(y[part == k])) == 2 for k in (3, 4)) and len(set(y[part < 3])) == 2
    train, cal, comb = (part < 3, part == 3, part == 4) if usable else (np.ones(len(y), bool),) * 3
    prior = float(y[train].mean())
    model.prior = math.log(prior / (1 - prior))
    classes = (float(y[train].sum()), float((1 - y[train]).sum()))
    size = len(model.frequent) + codes.shape[1] * RARE
    known = _value_counts(model.index(codes[train]), y[train], np.ones(train.sum()), size)
    model.text_w = fit(text[train], y[train])
    model.learn_rates(known)

    def calibrate() -> None:
        model.text_cal = _calibrated(logit(text[cal], model.text_w), y[cal])
        model.meta_cal = _calibrated(model.meta_raw(codes[cal]), y[cal])

    calibrate()
    for turn in range(1, rounds + 1):
        count = lambda t, c, m=model: np.concatenate([np.bincount(_bin(z), minlength=BINS) for z in (m.text_logit(t), m.meta_logit(c))])
        hists = summed(pool, count, 2 * BINS).reshape(2, BINS)
        n = int(hists[0].sum())
        if not n:
            break
        want = (math.ceil(n * turn * share * prior), math.ceil(n * turn * share * (1 - prior)))
        picks = [_surest(h, *want) for h in hists]
        lifts = [_lift(_bin(z), y[cal], p.hi, p.lo, prior) for z, p in zip((model.text_logit(text[cal]), model.meta_logit(codes[cal])), picks, strict=True)]
        model.lift.append((*lifts[0], *lifts[1]))
        by_text, by_meta = [replace(p, weights=tuple(pseudo * lift * total / n for lift, total, n in zip(ls, classes, want, strict=True))) for ls, p in zip(lifts, picks, strict=True)]
        at = model.text_w
        d = len(at)

        def learn(t, c, m=model, w=at, by_text=by_text, by_meta=by_meta):
            drawn = chance(t, c)
            a, ya, wa = by_text.pseudo(_bin(m.text_logit(t)), drawn)
            b, yb, wb = by_meta.pseudo(_bin(m.meta_logit(c)), drawn)
            handed = [(ya == 1).sum(), (ya == 0).sum(), (yb == 1).sum(), (yb == 0).sum()]
            return np.concatenate([handed, _value_counts(m.index(c[a]), ya, wa, size), newton_sums(t[b], yb, wb, w)])

        def at_pool(what, t, c, m=model, by_meta=by_meta):
            b, yb, wb = by_meta.pseudo(_bin(m.meta_logit(c)), chance(t, c))
            return what(t[b], yb, wb)

        sums = summed(pool, learn, 4 + 2 * size + d + d * d)
        model.exchanged.append(tuple(int(n) for n in sums[:4]))
        counts, sums = sums[4 : 4 + 2 * size], sums[4 + 2 * size :]
        ones = np.ones(train.sum())
        for step in range(STEPS):
            if step:
                sums = summed(pool, lambda t, c, w=at: at_pool(lambda *rows: newton_sums(*rows, w), t, c), d + d * d)
            own = sums + newton_sums(text[train], y[train], ones, at)
            loss = lambda ws: losses(text[train], y[train], ones, ws) + summed(pool, lambda t, c: at_pool(lambda *rows: losses(*rows, ws), t, c), len(ws))
            at = damped_step(at, own, loss, ridge(d), np.zeros(d), POOL_HALVINGS)
        model.text_w = at
        model.learn_rates(known + counts)
        calibrate()
    both = np.column_stack([model.text_logit(text[comb]), model.meta_logit(codes[comb])])
    w = fit_positive(both, y[comb], np.ones(3), np.array([1.0, 0.0, 0.0]))
    model.both = (float(w[0]), float(w[1]), float(w[2]))
    return model


def _with_features(rows: DataFrame) -> DataFrame:
    """``key``, ``y``, ``text`` (half-precision numbers, packed) and ``meta`` of rows with ``__text``."""

    def features(it):
        for batch in it:
            texts = batch.column("__text").cast(pa.binary())
            for a, b in groups(pc.binary_length(texts).to_pylist(), GROUP_BYTES):
                made = text_features(texts.slice(a, b - a).to_pylist()).astype(np.float16)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("y"), pa.array([r.tobytes() for r in made], pa.binary()), part.column("meta")], ["key", "y", "text", "meta"])

    return whole_texts(rows).mapInArrow(ends_clean(features), f"key {rows.schema['key'].dataType.simpleString()}, y int, text binary, meta array<bigint>")


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", meta: tuple[str, ...] = ("lang", "source", "n_chars"), labelled: int = LABELLED) -> Model:
    """A model from ``labelled`` labelled documents at most, drawn by a hash of the id, and from all others without labels.

    Labels other than 0 and 1 don't count; of several for one id the greatest does; of several documents of a drawn id
    one is used. With less than ten labels or one class alone the model gives all documents the share of good labels (1
    without any, as for an empty table). Metadata columns that ``docs`` lacks are left out. A null text is an empty
    one, null metadata are a value of their own, a document without an id has no label. Very long texts are read as a
    whole, in groups of half a megabyte or one text.

    Features are made once, as a table of about 600 bytes a document. Each round takes a pass for the ranks, one for
    the sums, one for the losses by which a Newton step is halved, and two more for each further step; sums have a
    fixed size.
    """
    have = [c for c in meta if c in docs.columns]
    model = Model(have)
    known = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__k")).agg(F.max(label_col).cast("int").alias("__y"))
    ids = docs.select(named(id_col).alias("__k")).distinct()
    some = known.join(ids, "__k", "left_semi").orderBy(F.xxhash64("__k", F.lit(17)), "__k").limit(labelled)
    rows = docs.select(named(id_col).alias("__id"), F.coalesce(named(text_col), F.lit("")).alias("__text"), meta_codes(docs, have).alias("meta"))
    drawn = rows.join(F.broadcast(some), F.col("__id") == F.col("__k"), "left")  # ``labelled`` ids at most
    table = written(_with_features(drawn.select(F.col("__id").alias("key"), F.col("__y").alias("y"), "__text", "meta")), "features")
    one = table.filter("y is not null").groupBy("key").agg(F.min(F.struct("text", "meta", "y")).alias("r")).select("key", "r.*")
    got = one.orderBy(F.xxhash64("key", F.lit(18)), "key").toPandas()
    y = got["y"].to_numpy(float)
    if len(y) < 10 or y.min() == y.max():
        model.constant = float(y.mean()) if len(y) else 1.0
        return model
    pool = table.filter("y is null")
    width = len(got["meta"].iloc[0])
    if width:
        values = table.select(F.explode("meta").alias("v")).groupBy("v").agg(F.count("*").alias("n"))
        least = max(1, table.count() // FREQUENT)
        model.frequent = np.sort(np.array([r.v for r in values.filter(F.col("n") >= least).select("v").collect()], np.int64))  # FREQUENT for each feature at most
    text = np.array([np.frombuffer(bytes(t), np.float16) for t in got["text"]]).astype(np.float64)
    codes = np.array([list(m) for m in got["meta"]], np.int64).reshape(len(got), width)
    return co_train(model, pool, text, codes, y)


def score_quality(docs: DataFrame, model: Model, text_col: str = "text", keep_at: float = 0.5, prefix: str = "") -> DataFrame:
    """All columns of ``docs`` plus ``p_text``, ``p_meta``, ``p_quality`` and ``keep``, each with ``prefix`` before its name.

    Columns of these names are replaced. Every row is scored by its whole text, in groups of half a megabyte or one text; a null
    text is an empty one; null metadata are a value of their own; repeated rows all stay, with equal scores; an empty
    table gives no rows.
    """
    made = [prefix + c for c in ("p_text", "p_meta", "p_quality", "keep")]
    rest = [c for c in docs.columns if c not in made]
    source = docs.select(*passing(rest), F.coalesce(named(text_col), F.lit("")).alias("__scored"), meta_codes(docs, model.meta).alias("__meta"))

    def run(it):
        for batch in it:
            texts, width = batch.column("__scored").cast(pa.binary()), len(model.meta) * (len(model.meta) + 1) // 2
            for a, b in groups(pc.binary_length(texts).to_pylist(), GROUP_BYTES):
                part = batch.slice(a, b - a)
                p = model.score(text_features(texts.slice(a, b - a).to_pylist()), _codes(part.column("__meta")).reshape(b - a, width))
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(len(rest))), *(pa.array(v, pa.float64()) for v in p), pa.array(p[2] >= keep_at)], [*rest, *made])

    kinds = ("double", "double", "double", "boolean")
    return whole_texts(source).mapInArrow(ends_clean(run), ", ".join([*fields(docs, rest), *(f"{quoted(c)} {t}" for c, t in zip(made, kinds, strict=True))]))
