"""N-gram Jaccard join: a MinHash LSH forest for candidates, exact verification in blocks."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ends_clean, named, partitions, whole_texts, written
from .components import components
from .hashing import Words, grams, groups, mix

#: Words of a shingle; the least similarity; trees of the forest, depth of their tries, and the recall to reach.
SHINGLE, SIMILAR, TREES, DEEPEST, RECALL = 5, 0.8, 40, 8, 0.99999
#: By so much a prefix is shortened at a time.
SHORTER = 2
#: Texts and shingles of a block at most, on average.
BLOCK_TEXTS, BLOCK_GRAMS = 512, 150_000
#: Labels that are compared with those of a part of their bucket, and labels of such a part, on average.
ASKING, ASKED = 512, 65_536


def depth(similar: float = SIMILAR, trees: int = TREES, deepest: int = DEEPEST, recall: float = RECALL) -> int:
    """The longest prefix at which a pair at the threshold shares one in some tree so surely."""
    for d in range(deepest, 0, -1):
        if 1 - (1 - similar**d) ** trees >= recall:
            return d
    raise ValueError("so few trees can't reach that recall")


def depths(similar: float, trees: int, recall: float) -> list[int]:
    """Lengths of prefixes from the whole label down to the one that reaches the recall."""
    last = depth(similar, trees, recall=recall)
    return [*range(DEEPEST, last, -SHORTER), last]


def near_enough(similar: float, size: int) -> float:
    """The share of ``size`` MinHashes that two sets so similar have in common, less six standard deviations."""
    return similar - 6 * math.sqrt(similar * (1 - similar) / size)


def shingles(texts: list[bytes], n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, in one array, and where each text's begin.

    A text of fewer than ``n`` words has one shingle, all its words; one without words has none.
    """
    words = Words(texts)
    h = words.hashes()
    g = grams(h, n)
    whole = words.text[: len(g)] == words.text[n - 1 : n - 1 + len(g)]
    doc, value = words.text[: len(g)][whole], g[whole]
    count = np.diff(words.first)
    short = np.flatnonzero((count > 0) & (count < n))
    if len(short):
        one = [xxhash.xxh64_intdigest(h[words.first[d] : words.first[d + 1]].tobytes(), int(count[d])) for d in short]
        doc, value = np.concatenate([doc, short]), np.concatenate([value, np.array(one, np.uint64)])
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return value[new], np.searchsorted(doc[new], np.arange(len(texts) + 1))


def labels(value: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
    """``size`` bytes for each text (which must have shingles): one of each MinHash."""
    rng = np.random.default_rng(20_240_607)
    flip, times = rng.integers(0, 2**63, size, np.uint64), rng.integers(0, 2**63, size, np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.empty((len(begin) - 1, size), np.uint8)
    for j in range(size):
        least = np.minimum.reduceat((value ^ flip[j]) * times[j], begin[:-1])
        out[:, j] = (mix(least) & np.uint64(0xFF)).astype(np.uint8)
    return out


def _sets(size: int):
    def sets(it):
        for batch in it:
            texts = batch.column("__text").cast(pa.binary()).to_pylist()
            for a, b in groups([len(t) for t in texts], 1_000_000):
                value, begin = shingles(texts[a:b])
                count = np.diff(begin)
                some = np.flatnonzero(count)
                if not len(some):
                    continue
                made = labels(value, np.append(begin[some], len(value)), size)
                digest = np.frombuffer(b"".join(xxhash.xxh3_128_digest(value[begin[d] : begin[d + 1]].tobytes()) for d in some), np.int64).reshape(-1, 2)
                rows = batch.slice(a, b - a).select(["__id", "__version"]).take(pa.array(some))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(np.ascontiguousarray(digest[:, 0])), pa.array(np.ascontiguousarray(digest[:, 1])), pa.array(count[some].astype(np.int64)), pa.array([r.tobytes() for r in made], pa.binary())],
                    ["__id", "__version", "__h1", "__h2", "__grams", "__label"],
                )

    return sets


def linked(texts: list[bytes], left: np.ndarray, right: np.ndarray, similar: float) -> np.ndarray:
    """Which texts of ``left`` and ``right`` (indices) are so similar: a matrix. Shared shingles are counted exactly."""
    value, begin = shingles(texts)
    size = np.diff(begin)
    doc = np.repeat(np.arange(len(texts)), size)
    order = np.argsort(value, kind="stable")
    value, doc = value[order], doc[order]
    new = np.ones(len(value), bool)
    new[1:] = value[1:] != value[:-1]
    column = np.cumsum(new) - 1
    often = np.bincount(column) > 1
    keep = often[column]
    doc, column = doc[keep], (np.cumsum(often) - 1)[column[keep]]
    both = np.zeros((len(left), len(right)), np.float32)
    step = max(256, 2_000_000 // len(texts))
    edges = np.searchsorted(column, np.arange(0, (int(column[-1]) + 1 if len(column) else 0) + step, step))
    for k in range(len(edges) - 1):
        a, b = edges[k], edges[k + 1]
        if a < b:
            block = np.zeros((len(texts), step), np.float32)
            block[doc[a:b], column[a:b] - k * step] = 1
            both += block[left] @ block[right].T
    union = size[left][:, None] + size[right][None, :] - both
    return both >= similar * union - 1e-6


def _unit(rows: list[tuple], similar: float) -> list[tuple]:
    """Links of one pair of blocks: ("n", node, links, 0) counts and ("e", node, 0, node) edges of a spanning forest."""
    i, j = rows[0][1], rows[0][2]
    block, node, copies = (np.array([r[k] for r in rows], np.int64) for k in (3, 4, 5))
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    hit = linked([r[6] for r in rows], left, right, similar)
    if i == j:
        np.fill_diagonal(hit, False)
    out: list[tuple] = []
    for side, matrix, other in ((left, hit, right), *(() if i == j else ((right, hit.T, left),))):
        links = matrix @ copies[other]
        out += [("n", int(node[side[k]]), int(links[k]), 0) for k in np.flatnonzero(links)]
    label = np.arange(len(rows))
    pairs = np.argwhere(hit)
    a, b = left[pairs[:, 0]], right[pairs[:, 1]]
    while len(a):
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == before).all():
            break
    return out + [("e", int(node[k]), 0, int(node[label[k]])) for k in np.flatnonzero(label != np.arange(len(rows)))]


def _verify(similar: float):
    names = ["__c", "__i", "__j", "__block", "__node", "__copies", "__text"]

    def emit(out: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], ["kind", "a", "links", "b"])

    def verify(it):
        held: list[tuple] = []
        out: list[tuple] = []
        for batch in it:
            for row in zip(*(batch.column(c).to_pylist() for c in names[:6]), batch.column("__text").cast(pa.binary()).to_pylist(), strict=True):
                if held and held[0][:3] != row[:3]:
                    out += _unit(held, similar)
                    held = []
                held.append(row)
            if len(out) >= 10_000:
                yield emit(out)
                out = []
        if held:
            out += _unit(held, similar)
        if out:
            yield emit(out)

    return verify


def _agree(least: float):
    """Of pairs (a, b) with labels, those whose labels agree in so large a share of the bytes."""

    def agree(it):
        for batch in it:
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("__left", "__right"))
            same = (left == right).mean(1) if batch.num_rows else np.zeros(0)
            yield batch.select(["a", "b"]).filter(pa.array(same >= least))

    return agree


def _across(least: float):
    """Units come sorted, those that ask first: a spanning forest of the families that have members whose labels agree so far.

    Of n families that all agree it has n - 1 pairs, whatever the number of pairs that were compared.
    """

    def across(it: Iterator[pa.RecordBatch]):
        now, labels, family, root = None, [], [], {}

        def top(f: int) -> int:
            while (up := root.get(f, f)) != f:
                root[f] = f = root.get(up, up)
            return f

        for batch in it:
            places = [batch.column(c).to_numpy() for c in ("__key", "__g", "__c", "__asked")]
            cuts = [0, *(np.flatnonzero(np.any([p[1:] != p[:-1] for p in places], axis=0)) + 1), batch.num_rows]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if now != tuple(p[a] for p in places[:3]):
                    now, labels, family, root = tuple(p[a] for p in places[:3]), [], [], {}
                part = batch.slice(a, b - a)
                mine = np.frombuffer(b"".join(part.column("__label").to_pylist()), np.uint8).reshape(b - a, -1)
                of = part.column("__f").to_numpy()
                if not places[3][a]:
                    labels.append(mine)
                    family.append(of.tolist())
                    continue
                found = []
                for asking, fs in zip(labels, family, strict=True):
                    for label, own in zip(asking, fs, strict=True):
                        for f in set(of[(mine == label).mean(1) >= least].tolist()):
                            if (x := top(own)) != (y := top(f)):
                                root[max(x, y)] = min(x, y)
                                found.append((max(own, f), min(own, f)))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    return across


def families(nodes: DataFrame, similar: float, trees: int, recall: float) -> DataFrame:
    """``__node``, ``__f``: nodes that may be so similar have the same family.

    ``nodes`` have a ``__label`` of ``trees`` times DEEPEST bytes. In each tree of the forest, nodes below one prefix
    form a bucket. From the whole label on prefixes are shortened, until the recall is reached; at each length only
    buckets count that still hold several families, and no pair joins two families unless all their MinHashes
    together allow for the similarity, so buckets that met by chance don't chain unrelated texts.

    In a bucket each node is first compared with the least one, which joins most copies. Nodes that neither agree with
    it nor belong to its family are then compared with all of the bucket, in units of bounded size; each gives a spanning
    forest of the families that it has found together. Nodes that agree with the least one count as of its family there.
    """
    spark = nodes.sparkSession
    enough = near_enough(similar, trees * DEEPEST)
    label = nodes.select("__node", "__label")
    family = nodes.select("__node", F.col("__node").alias("__f"))
    for size in depths(similar, trees, recall):
        tree = label.join(family, "__node").select("__node", "__f", "__label", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("__t"))
        below = tree.select("__node", "__f", F.xxhash64("__t", F.substring("__label", F.col("__t") * DEEPEST + 1, F.lit(size))).alias("__key"))
        several = below.groupBy("__key").agg(F.min("__f").alias("__lo"), F.max("__f").alias("__hi"), F.min(F.struct("__node", "__f")).alias("__first")).filter("__lo < __hi")
        several = written(several.select("__key", F.col("__first.__node").alias("__least"), F.col("__first.__f").alias("__lf")), "prefixes")  # so that joins with it can be split where a prefix is hot
        held = written(below.join(several, "__key"), "buckets")
        pairs = held.filter("__f <> __lf").select(F.col("__node").alias("a"), F.col("__least").alias("b")).distinct()
        pairs = pairs.join(label.select(F.col("__node").alias("a"), F.col("__label").alias("__left")), "a").join(label.select(F.col("__node").alias("b"), F.col("__label").alias("__right")), "b")
        agreed = written(pairs.mapInArrow(ends_clean(_agree(enough)), "a long, b long"), "agreed")
        met = held.join(agreed, (F.col("__node") == F.col("a")) & (F.col("__least") == F.col("b")), "left")
        rows = met.select("__key", "__node", "__f", "__lf", F.col("a").isNotNull().alias("__agrees"), (F.col("a").isNull() & (F.col("__f") != F.col("__lf"))).alias("__apart"))

        counts = rows.groupBy("__key").agg(F.count_if("__apart").alias("__n"), F.count("*").alias("__all")).filter("__n > 0")
        contested = written(counts.select("__key", F.ceil(F.col("__n") / ASKING).cast("int").alias("__gs"), F.ceil(F.col("__all") / ASKED).cast("int").alias("__cs")), "contested")
        open_ = rows.join(contested, "__key")
        dealt = lambda n, seed: F.pmod(F.xxhash64("__node", F.lit(seed)), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        asking = open_.filter("__apart").select("__key", dealt("__gs", 5).alias("__g"), every("__cs").alias("__c"), F.lit(0).alias("__asked"), "__node", "__f")
        asked = open_.select("__key", every("__gs").alias("__g"), dealt("__cs", 6).alias("__c"), F.lit(1).alias("__asked"), "__node", F.when(F.col("__agrees"), F.col("__lf")).otherwise(F.col("__f")).alias("__f"))
        units = asking.unionByName(asked).join(label, "__node").drop("__node").repartition(partitions(spark), "__key", "__g", "__c").sortWithinPartitions("__key", "__g", "__c", "__asked")
        across = units.mapInArrow(ends_clean(_across(enough)), "a long, b long")

        roots = components(rows.filter("__agrees").select(F.col("__f").alias("a"), F.col("__lf").alias("b")).unionByName(across))
        joined = family.join(roots, F.col("__f") == F.col("node"), "left")
        family = written(joined.select("__node", F.coalesce("root", "__f").alias("__f")), "families")
    return family


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILAR, trees: int = TREES, recall: float = RECALL) -> DataFrame:
    """``doc_id``, ``__version`` (hash of the text), ``copy_id``, ``n_links``, ``class_id``, ``class_version``: one row for each row of ``docs``.

    A text's set is its distinct shingles of five words (runs of anything but ASCII white space, unchanged); a text of
    fewer words has one shingle. Two rows are linked if their sets' Jaccard similarity is ``similar`` or more.
    n_links counts a row's links, copies included; class_id is the least id that links lead to, class_version the
    least version among the rows of that id in the class: the two together name the class, since texts that have nothing
    in common may have the same id, or none. copy_id is the least id with an equal set. Rows without words (null,
    empty) have no links and are their own class. A null id is the smallest. Rows that repeat count as copies. An empty
    table gives no rows; other columns don't matter; ids are whole numbers; very long texts are handled as a whole,
    each in one task.

    1. Rows with equal sets become one node, which knows how many they are.
    2. A forest of ``trees`` prefix tries over MinHash labels joins nodes into candidate families (see families).
    3. A family's texts are dealt to blocks, each pair of blocks is a unit of bounded size; in it shared shingles
       are counted for all pairs at once, exactly. It returns counts by node and a spanning forest of its links.
    """
    spark = docs.sparkSession
    text = F.coalesce(named(text_col), F.lit(""))
    base = docs.select(F.coalesce(named(id_col).cast("long"), F.lit(-(2**63))).alias("__id"), F.xxhash64(text).alias("__version"), text.alias("__text"))
    sets = written(whole_texts(base).mapInArrow(ends_clean(_sets(trees * DEEPEST)), "__id long, __version long, __h1 long, __h2 long, __grams long, __label binary"), "shingles")
    nodes = sets.groupBy("__h1", "__h2").agg(F.min(F.struct("__id", "__version")).alias("__r"), F.count("*").alias("__copies"), F.first("__grams").alias("__grams"), F.first("__label").alias("__label"))
    nodes = nodes.select("__h1", "__h2", "__r.__id", "__r.__version", "__copies", "__grams", "__label", F.xxhash64("__r.__id", "__r.__version").alias("__node"))
    nodes = written(nodes, "nodes")

    family = families(nodes, similar, trees, recall)
    several = family.groupBy(F.col("__f").alias("__c")).agg(F.count("*").alias("__n")).filter("__n > 1").select("__c")
    found = family.join(written(several, "several"), F.col("__f") == F.col("__c")).select("__node", "__c")
    members = written(found.join(nodes.drop("__label"), "__node"), "members")
    cut = members.groupBy("__c").agg(F.greatest(F.ceil(F.count("*") / BLOCK_TEXTS), F.ceil(F.sum("__grams") / BLOCK_GRAMS)).cast("int").alias("__blocks"))
    members = members.join(written(cut, "blocks"), "__c").withColumn("__block", F.pmod(F.xxhash64("__node", F.lit(3)), F.col("__blocks")).cast("int"))
    texts = base.join(members.select("__id", "__version", "__c", "__node", "__copies", "__blocks", "__block"), ["__id", "__version"]).dropDuplicates(["__node"])
    units = texts.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
    units = units.select("__c", F.least("__block", "__other").alias("__i"), F.greatest("__block", "__other").alias("__j"), "__block", "__node", "__copies", "__text")
    units = units.repartition(partitions(spark), "__c", "__i", "__j").sortWithinPartitions("__c", "__i", "__j")
    verified = written(units.mapInArrow(ends_clean(_verify(similar)), "kind string, a long, links long, b long"), "links")

    links = verified.filter("kind = 'n'").groupBy(F.col("a").alias("__node")).agg(F.sum("links").alias("__links"))
    joined = components(verified.filter("kind = 'e'").select("a", "b"))
    rooted = nodes.drop("__label").join(joined.select(F.col("node").alias("__node"), F.col("root").alias("__root")), "__node", "left").withColumn("__root", F.coalesce("__root", "__node"))
    rooted = written(rooted.join(links, "__node", "left"), "rooted")
    names = rooted.groupBy("__root").agg(F.min(F.struct("__id", "__version")).alias("__first")).select("__root", F.col("__first.__id").alias("__class"), F.col("__first.__version").alias("class_version"))
    classes = rooted.join(written(names, "names"), "__root").select("__h1", "__h2", F.col("__id").alias("__copy"), (F.col("__copies") - 1 + F.coalesce("__links", F.lit(0))).alias("__n"), "__class", "class_version")
    judged = sets.select("__id", "__version", "__h1", "__h2").join(written(classes, "classes"), ["__h1", "__h2"])
    none = without_words(base)
    of = lambda c: F.when(F.col(c) != -(2**63), F.col(c))
    judged = judged.select(of("__id").alias("doc_id"), "__version", of("__copy").alias("copy_id"), F.col("__n").alias("n_links"), of("__class").alias("class_id"), "class_version")
    return judged.unionByName(none.select(of("__id").alias("doc_id"), "__version", of("__id").alias("copy_id"), F.lit(0).cast("long").alias("n_links"), of("__id").alias("class_id"), F.col("__version").alias("class_version")))


#: A text that holds a word.
WORDED = r"[^\x20\x09-\x0D]"


def without_words(base: DataFrame) -> DataFrame:
    """Rows that hold no word."""
    return base.filter(~F.col("__text").rlike(WORDED)).select("__id", "__version")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """The rows of ``docs``, all columns as they are, but one row alone of each class: its least id, then its first text.

    Classes are told apart by id and text, so those that share an id, or have none, all keep their row; of repeated rows
    one stays. Rows without words (null and empty texts) are their own class and all stay. Very long texts count as a
    whole; an empty table stays empty.
    """
    judged = near_duplicates(docs, id_col, text_col, **more)
    first = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("__version") == F.col("class_version"))
    keep = judged.filter(first).select(F.col("doc_id").alias("__k"), F.col("__version").alias("__v")).distinct()
    worded = F.coalesce(named(text_col), F.lit("")).rlike(WORDED)
    keyed = docs.filter(worded).withColumns({"__d": named(id_col).cast("long"), "__w": F.xxhash64(F.coalesce(named(text_col), F.lit("")))})
    met = keyed.join(keep, F.col("__d").eqNullSafe(F.col("__k")) & (F.col("__w") == F.col("__v")))
    return met.dropDuplicates(["__d", "__w"]).select(*map(named, docs.columns)).unionByName(docs.filter(~worded))
