"""Substring dedup by super-k-mers: windows of words that start earlier elsewhere lose their words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ends_clean, partitions, whole_texts, written
from .hashing import Words, grams, groups, sliding_min

#: Words in a window, in a minimiser, and windows in a super-k-mer at most (longer runs go as several).
WINDOW, MINI, LONGEST = 20, 4, 512
#: A minimiser with more super-k-mers than this is hot: its windows travel one by one, dealt by their own hash.
HOT = 5_000
#: Packed bytes sorted at a time, unless one bucket alone (HOT super-k-mers at most) has more.
CHUNK_BYTES = 4_000_000


def runs(words: Words, window: int, mini: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Super-k-mers of some texts: minimiser, first word, number of windows, and how often the minimiser stands there."""
    g = grams(words.hashes(), mini)
    h = sliding_min(g, window - mini + 1)
    none = np.zeros(0, np.int64)
    if not len(h):
        return none.view(np.uint64), none, none, none
    whole = words.text[: len(h)] == words.text[window - 1 : window - 1 + len(h)]
    at = np.flatnonzero(whole)
    if not len(at):
        return none.view(np.uint64), none, none, none
    least = h[at]
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) > 1) | (least[1:] != least[:-1]) | (words.text[at[1:]] != words.text[at[:-1]])
    start = np.flatnonzero(new)
    size = np.diff([*start, len(at)])
    pieces = (size + LONGEST - 1) // LONGEST
    within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = np.repeat(start, pieces) + within * LONGEST
    least, begin, size = least[first], at[first], np.minimum(np.repeat(size, pieces) - within * LONGEST, LONGEST)
    span = size + (window - mini)
    offset = np.cumsum(span) - span
    places = np.arange(span.sum()) + np.repeat(begin - offset, span)
    return least, begin, size, np.add.reduceat((g[places] == np.repeat(least, span)).astype(np.int64), offset)


def _batches(it: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in it:
        texts = batch.column("__text").cast(pa.binary()).to_pylist()
        for a, b in groups([len(t) for t in texts]):
            yield batch.slice(a, b - a), texts[a:b]


def _light(window: int, mini: int):
    def light(it):
        for batch, texts in _batches(it):
            words = Words(texts)
            least, first, size, times = runs(words, window, mini)
            doc = words.text[first]
            ids, versions = batch.column("__id").to_numpy(), batch.column("__version").to_numpy()
            columns = [pa.array(least.view(np.int64)), pa.array(ids[doc]), pa.array(versions[doc]), pa.array((first - words.first[doc]).astype(np.int32)), pa.array(size.astype(np.int32)), pa.array((times > 1).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["__mini", "__id", "__version", "__start", "__windows", "__again"])

    return light


def _own_runs(batch: pa.RecordBatch) -> Iterator[list[tuple[int, int, int, bool]]]:
    """By row: minimiser, first word, number of windows, hot."""
    for chosen in batch.column("__runs").to_pylist():
        yield [(r["__mini"], r["__place"] >> 10, r["__place"] & 1023, r["__hot"]) for r in chosen]


def _packed(window: int):
    """Cold super-k-mers as packed strings: the words joined by one space."""

    def packed(it):
        for batch in it:
            out: list[list] = [[], [], [], [], []]
            for text, doc, version, own in zip(batch.column("__text").cast(pa.binary()).to_pylist(), *(batch.column(c).to_pylist() for c in ("__id", "__version")), _own_runs(batch), strict=True):
                words = text.split()
                for least, s, n, hot in own:
                    if not hot:
                        for col, v in zip(out, (least, doc, version, s, b" ".join(words[s : s + n + window - 1])), strict=True):
                            col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int32()), pa.array(out[4], pa.binary())], ["__mini", "__id", "__version", "__start", "__pack"])

    return packed


def _window_hashes(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits a window, by first word, over all words in a row."""
    return grams(words.hashes(), window), grams(words.hashes(1), window, 0xC6A4A7935BD1E995)


def _single(window: int):
    """Hot super-k-mers as single windows: 128 bits each."""

    def single(it):
        for batch, texts in _batches(it):
            words = Words(texts)
            rows = [(d, s, n) for d, own in enumerate(_own_runs(batch)) for _, s, n, hot in own if hot]
            if not rows:
                continue
            doc, start, size = (np.array(c, np.int64) for c in zip(*rows, strict=True))
            within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            doc, start = np.repeat(doc, size), np.repeat(start, size) + within
            h1, h2 = _window_hashes(words, window)
            at = words.first[doc] + start
            ids, versions = batch.column("__id").to_numpy(), batch.column("__version").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(h1[at].view(np.int64)), pa.array(h2[at].view(np.int64)), pa.array(ids[doc]), pa.array(versions[doc]), pa.array(start.astype(np.int32))], ["__w1", "__w2", "__id", "__version", "__start"])

    return single


def _sorted(window: int):
    """Buckets arrive sorted by minimiser; whole buckets are sorted by window and compared with the first of each."""

    def judge(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(parts).combine_chunks()
        ids, versions, starts = (t.column(c).to_numpy() for c in ("__id", "__version", "__start"))
        words = Words(t.column("__pack").to_pylist())
        h1, h2 = _window_hashes(words, window)
        size = np.diff(words.first) - (window - 1)
        row = np.repeat(np.arange(len(size)), size)
        within = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        at = words.first[row] + within
        a, b, doc, start = h1[at], h2[at], ids[row], starts[row] + within
        order = np.lexsort((start, doc, b, a))
        a, b = a[order], b[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        head = order[np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))]
        again = np.zeros(len(a), bool)
        again[order] = (doc[order] != doc[head]) | (start[order] != start[head])
        hit = np.flatnonzero(again)
        split = np.ones(len(hit), bool)
        split[1:] = (np.diff(hit) > 1) | (row[hit[1:]] != row[hit[:-1]])
        first = hit[split]
        last = hit[np.append(np.flatnonzero(split)[1:] - 1, len(hit) - 1)] if len(hit) else hit
        return pa.RecordBatch.from_arrays([pa.array(ids[row[first]]), pa.array(versions[row[first]]), pa.array(start[first].astype(np.int32)), pa.array((start[last] + window).astype(np.int32))], ["__id", "__version", "__from", "__to"])

    def sorted_(it):
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in it:
            minis = batch.column("__mini").to_numpy()
            cuts = [0, *(np.flatnonzero(minis[1:] != minis[:-1]) + 1), len(minis)]
            begin = 0
            offsets = np.cumsum([0, *(len(x) for x in batch.column("__pack").to_pylist())])
            for c in cuts[:-1]:
                if held or c > begin:
                    same = c == begin and held and held[-1].column("__mini")[-1].as_py() == minis[c]
                    if not same and size + offsets[c] - offsets[begin] >= CHUNK_BYTES:
                        if c > begin:
                            held.append(batch.slice(begin, c - begin))
                        yield judge(held)
                        held, size, begin = [], 0, c
            if len(minis) > begin:
                held.append(batch.slice(begin))
                size += int(offsets[-1] - offsets[begin])
        if held:
            yield judge(held)

    return sorted_


def _kept(window: int):
    def kept(it):
        for batch in it:
            out: list[list] = [[], [], []]
            for text, spans, later in zip(batch.column("__text").cast(pa.binary()).to_pylist(), *(batch.column(c).to_pylist() for c in ("__spans", "__later")), strict=True):
                words = text.split()
                n = len(words)
                if later:
                    words = words if n < window else []
                elif spans:
                    delta = np.zeros(n + 1, np.int64)
                    np.add.at(delta, [x["__from"] for x in spans], 1)
                    np.add.at(delta, [x["__to"] for x in spans], -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(delta)[:n] == 0)]
                for col, v in zip(out, (n, n - len(words), b" ".join(words).decode()), strict=True):
                    col.append(v)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())], ["doc_id", "n_words", "n_removed", "kept_text"])

    return kept


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, mini: int = MINI, hot: int = HOT) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept_text`` of each row.

    Words are runs of anything but ASCII white space, unchanged. A window is ``window`` consecutive words of one
    document. Each word covered by a window whose sequence of words also starts earlier (smaller id, or the same
    document and an earlier place) goes; windows are judged on the input. Kept words are joined by one space. A null
    text has no words, a null id counts as the smallest; rows that repeat an id and a text start at the same places
    and so are not earlier than each other. Documents shorter than a window lose nothing. An empty table gives no rows;
    other columns don't matter. Very long texts are handled as a whole, each in one task. Ids are whole numbers.

    A document is an id and a text, told apart by 64 bits of the text's hash, so rows without an id don't gather.

    1. A row whose text a smaller id has as a whole loses all words that a window covers; it takes no part in 3 to 5.
    2. Consecutive windows with the same minimiser (least hash of ``mini`` words) form a super-k-mer. Only (minimiser,
       document, place) is counted at first: a window that two texts or two places of a text hold has a minimiser that
       they hold.
    3. Super-k-mers of such minimisers travel as packed strings of words to the bucket of their minimiser; there
       windows are sorted and all but the first of each are marked. A bucket holds ``hot`` super-k-mers at most.
    4. Windows of minimisers with more travel singly, dealt by their own hash; the first of each is found by partial
       minima and joined back, so neither copies nor a common line gather in one task.
    5. Marked places are gathered by document and joined to the texts.
    Windows are compared by 128-bit hashes of their words.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-(2**63))).alias("__id"), F.xxhash64(text).alias("__version"), text.alias("__text"))
    whole = base.select("__id", "__version", F.xxhash64(F.lit(1), "__text").alias("__second"))
    first_copy = whole.groupBy("__version", "__second").agg(F.min("__id").alias("__least"), F.max("__id").alias("__most")).filter("__least < __most").drop("__most")
    first_copy = written(first_copy, "copies")  # tables, so that joins with them can be split where a text, a minimiser or a window is hot
    later = whole.join(first_copy, ["__version", "__second"]).filter("__id > __least").select("__id", "__version", F.lit(True).alias("__later")).distinct()
    later = written(later, "later")
    document = ["__id", "__version"]

    places = written(whole_texts(base).mapInArrow(ends_clean(_light(window, mini)), "__mini long, __id long, __version long, __start int, __windows int, __again int"), "superkmers")
    place = F.xxhash64("__version", "__start").bitwiseAND(-2)  # the same for the same place of equal texts
    repeated = places.groupBy("__mini").agg(F.min(place).alias("__a"), F.max(place.bitwiseOR(F.col("__again").cast("long"))).alias("__b"), F.count("*").alias("__n")).filter("__a < __b")
    repeated = written(repeated.select("__mini", (F.col("__n") > hot).alias("__hot")), "minimisers")
    at = F.shiftleft(F.col("__start").cast("long"), 10).bitwiseOR(F.col("__windows").cast("long"))
    chosen = places.select("__mini", *document, at.alias("__place")).join(repeated, "__mini")
    chosen = chosen.groupBy(*document).agg(F.collect_set(F.struct("__mini", "__place", "__hot")).alias("__runs"))
    found = base.join(chosen.join(later, document, "left_anti"), document)
    packed = found.mapInArrow(ends_clean(_packed(window)), "__mini long, __id long, __version long, __start int, __pack binary")
    spans = "__id long, __version long, __from int, __to int"
    cold = packed.repartition(partitions(spark), "__mini").sortWithinPartitions("__mini").mapInArrow(ends_clean(_sorted(window)), spans)
    single = found.filter(F.exists("__runs", lambda r: r["__hot"])).mapInArrow(ends_clean(_single(window)), "__w1 long, __w2 long, __id long, __version long, __start int")
    first = single.groupBy("__w1", "__w2").agg(F.min(F.struct("__id", "__start")).alias("__first"), F.count("*").alias("__n")).filter("__n > 1").drop("__n")
    first = written(first, "windows")
    after = single.join(first, ["__w1", "__w2"]).filter(F.struct("__id", "__start") > F.col("__first")).select(*document, F.col("__start").alias("__from"), (F.col("__start") + window).alias("__to"))
    marked = cold.unionByName(after).groupBy(*document).agg(F.collect_list(F.struct("__from", "__to")).alias("__spans"))
    joined = base.join(marked, document, "left").join(later, document, "left")
    return joined.select(F.nullif("__id", F.lit(-(2**63))).alias("doc_id"), "__text", "__spans", "__later").mapInArrow(ends_clean(_kept(window)), "doc_id long, n_words long, n_removed long, kept_text string")
