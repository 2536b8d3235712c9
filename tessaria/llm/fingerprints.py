"""Document fingerprints by winnowing, in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import let, partitions, written

#: A k-gram is so many tokens in a row; a window is so many k-grams in a row.
K, WINDOW = 5, 8
#: Windows handled at a time, which bounds the memory a long text takes.
SEGMENT = 16_384
#: K-grams are hashed as polynomials of their tokens' hashes, with this base, modulo a prime.
BASE, PRIME = 1_000_000_007, 2**31 - 1

#: Scripts written without spaces, each of whose characters is a token (Thai to Lao, Myanmar, Khmer, CJK).
SINGLE = r"\x{E00}-\x{EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{2E80}-\x{A4CF}\x{F900}-\x{FAFF}\x{FE30}-\x{FE4F}\x{FF00}-\x{FFEF}\x{20000}-\x{3FFFF}"
#: ASCII letters and digits, and all others beyond ASCII.
WORD = r"a-zA-Z0-9\x{80}-\x{DFF}\x{F00}-\x{FFF}\x{10A0}-\x{177F}\x{1800}-\x{2E7F}\x{A4D0}-\x{F8FF}\x{FB00}-\x{FE2F}\x{FE50}-\x{FEFF}\x{FFF0}-\x{1FFFF}\x{40000}-\x{10FFFF}"
#: While over 16 word characters are left of a run, it is cut after each of these, and after each character from U+0250 on.
CUT = r"aeiouAEIOU048\x{250}-\x{DFF}\x{F00}-\x{FFF}\x{10A0}-\x{177F}\x{1800}-\x{2E7F}\x{A4D0}-\x{F8FF}\x{FB00}-\x{FE2F}\x{FE50}-\x{FEFF}\x{FFF0}-\x{1FFFF}\x{40000}-\x{10FFFF}"
#: Plain words and signs come first, and what is no token is told at once: most places are settled by small classes.
PLAIN = r"[a-zA-Z0-9]{1,16}+(?![a-zA-Z0-9\x{80}-\x{10FFFF}])|[!-/:-@\[-`{-~]"
TOKEN = rf"{PLAIN}|(?=[a-zA-Z0-9\x{{80}}-\x{{10FFFF}}])(?:[{WORD}]{{1,16}}+(?![{WORD}])|[{WORD}]*?[{CUT}]|[{WORD}]+|[{SINGLE}])"


def tokens(text: Column) -> Column:
    """The tokens of a text, or the text itself if it is all white space.

    A token is a run of up to 16 letters and digits, one ASCII sign, or one character of a script without spaces. Longer
    runs (encoded data, identifiers) are cut by what they hold, so but for the last 16 characters of a run, where a cut
    lies doesn't depend on the place in it.
    """
    found = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    return let(found, lambda u: F.when((F.size(u) > 0) | (F.length(text) == 0), u).otherwise(F.array(text)))


def token_hash(token: Column) -> Column:
    return F.pmod(F.hash(token), F.lit(PRIME)).cast("long")


def rolled(values: Column, k: int) -> Column:
    """The polynomial hash of each run of ``k`` values (the last k - 1 places are null): that of 2n is made from two of n."""

    def longer(g: Column, n: int, more: Column, m: int) -> Column:
        factor = pow(BASE, m, PRIME)
        return F.zip_with(g, F.slice(more, F.lit(n + 1), F.greatest(F.size(more), F.lit(1))), lambda a, b: (a * F.lit(factor).cast("long") + b) % PRIME)

    def step(g: Column, n: int, bits: str) -> Column:
        if not bits:
            return g
        doubled = lambda h: longer(h, n, h, n)
        if bits[0] == "0":
            return let(let(g, doubled), lambda h: step(h, 2 * n, bits[1:]))
        return let(let(g, doubled), lambda h: let(longer(h, 2 * n, values, 1), lambda j: step(j, 2 * n + 1, bits[1:])))

    return step(values, 1, bin(k)[3:])


def winnow(units: Column, k: int = K, window: int = WINDOW, segment: int = SEGMENT) -> Column:
    """The selected k-grams of a text's tokens: array of hash * 2**31 + (2**31 - 1 - position).

    In each window of ``window`` k-grams (a power of two) the least hash is chosen, of equal ones the rightmost, so any
    run of ``window + k - 1`` tokens that two texts share gives both an equal hash. A text shorter than a window is one
    window, one shorter than a k-gram is one k-gram, an empty one has none. Tokens are hashed once; k-grams roll on from
    these hashes; the minima of windows of length 2, 4, 8 ... are made from one another.
    """
    grams = F.greatest(F.size(units) - (k - 1), F.lit(1))
    windows = F.greatest(grams - (window - 1), F.lit(1))

    def packed(hashes: Column, start: Column) -> Column:
        return F.transform(hashes, lambda h, i: F.shiftleft(h, 31) + (F.lit(2**31 - 1) - start - i))

    def minima(hashed: Column, start: Column) -> Column:
        here = F.least(windows - start, F.lit(segment))
        need = F.least(grams - start, here + (window - 1))
        own = F.slice(hashed, start + 1, need + (k - 1))
        step = 1
        body = lambda h: h
        while step < window:
            body = (lambda inner, s: lambda h: let(F.zip_with(h, F.slice(h, F.lit(s + 1), F.size(h)), lambda a, b: F.least(a, b)), inner))(body, window // 2 // step)
            step *= 2
        return let(let(own, lambda v: packed(F.slice(rolled(v, k), F.lit(1), need), start)), lambda h: F.array_distinct(F.slice(body(h), F.lit(1), here)))

    short = F.array(F.shiftleft(F.aggregate(units, F.lit(0).cast("long"), lambda acc, u: (acc * F.lit(BASE).cast("long") + token_hash(u)) % PRIME), 31) + F.lit(2**31 - 1))
    chosen = let(F.transform(units, token_hash), lambda v: F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), windows - 1, F.lit(segment)), lambda start: minima(v, start)))))
    return F.when(F.size(units) == 0, F.array().cast("array<bigint>")).when(F.size(units) < k, short).otherwise(chosen)


def winnowed(rows: DataFrame, text_col: str, name: str) -> DataFrame:
    """``rows`` plus the selected k-grams of a text; tokens are a column first, so that they are found once."""
    return rows.withColumn("__units", tokens(F.col(text_col))).withColumn("__size", F.size("__units")).withColumn(name, winnow(F.col("__units"))).drop("__units", "__size")


def hashes(chosen: Column) -> Column:
    """The distinct hashes of a fingerprint, without positions."""
    return F.array_distinct(F.transform(chosen, lambda x: F.shiftright(x, 31).cast("int")))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets of hashes; two empty sets are alike."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def _bucket(key: Column, cuts: list[int], lo: int, hi: int) -> Column:
    """The number of cuts at or below ``key``, by bisection."""
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(key < cuts[mid], _bucket(key, cuts, lo, mid)).otherwise(_bucket(key, cuts, mid + 1, hi))


def neighbours(ids: DataFrame) -> DataFrame:
    """``ids`` (distinct __k, __v; __n) with ``__pk``, ``__pv`` and ``__pn`` of the row before in the order of both, of the first: of the last.

    Only these numbers move. They are cut into ranges at quantiles of __k (as many as shuffle partitions, at most 1000
    numbers come to the driver); an id that several quantiles fall on is cut by __v as well. The first row of each range
    is also sent to the range before, so no range waits for another and no task gets all rows.
    """
    ids = written(ids, "ids")
    n = min(1000, max(2, 2 * partitions(ids.sparkSession)))
    least, found = ids.agg(F.min("__k"), F.percentile_approx("__k", [i / n for i in range(1, n)], 10_000)).first()
    if least is None:
        return ids.select("*", *(F.col(c).alias(c.replace("__", "__p")) for c in ("__k", "__v", "__n")))
    cuts = sorted({c for c in found if c > least})
    hot = sorted({a for a, b in zip(found, found[1:]) if a == b})
    within = F.when(F.col("__k").isin(hot), F.shiftright("__v", 54) + 512).otherwise(1024) if hot else F.lit(0)
    rows = ids.withColumns({"__b": _bucket(F.col("__k"), cuts, 0, len(cuts)).cast("long") * 2048 + within, "__s": F.lit(0)})
    own = ("__k", "__v", "__n")
    every = Window.orderBy("__b")  # a row for each range
    first = rows.groupBy("__b").agg(F.min(F.struct(*own)).alias("__first"))
    first = first.select("__first.*", F.coalesce(F.lag("__b").over(every), F.max("__b").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("__b"), F.lit(1).alias("__s"))
    order = Window.partitionBy("__b").orderBy("__s", "__k", "__v")
    pairs = rows.unionByName(first).select("__s", *(F.lead(c).over(order).alias(c) for c in own), *(F.col(c).alias(c.replace("__", "__p")) for c in own))
    return pairs.filter("__s = 0").drop("__s")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` plus ``fingerprint``: hash and position of each chosen k-gram, packed (see winnow).

    A null text counts as empty; equal texts have equal fingerprints; repeated rows stay; an empty table gives no rows;
    a column called like the result is replaced. Very long texts are handled as a whole, in one row.
    """
    return winnowed(docs.withColumn("__text", F.coalesce(F.col(text_col), F.lit(""))), "__text", "fingerprint").drop("__text")


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_chars``, ``edited``, ``fp``, ``edited_fp``, ``near_edited``, ``near_next`` of each row.

    Each text's fingerprint is put beside that of its edited text and that of the next document. Edited: the last
    floor(n/2) code points are replaced by as many first ones of the next document. A null text counts as empty, a null
    id comes first, rows of equal id go by a hash of the text; rows that repeat id and text are one document, and each
    has its result; a lone document is its own next one; an empty table gives no rows. Ids are whole numbers; other
    columns don't matter. Very long texts are handled as a whole, in one row.

    Who follows whom is found among ids and lengths alone. Texts move once, by id; then the first characters and the
    hashes of each document move on to the one before it.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = base.withColumns({"__k": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))), "__v": F.xxhash64("text")})
    pairs = written(neighbours(base.groupBy("__k", "__v").agg(F.max(F.length("text")).alias("__n"))), "neighbours")
    keyed = base.join(pairs, ["__k", "__v"])
    to = Window.partitionBy("__pk", "__pv").orderBy("doc_id")
    first = winnowed(keyed.select("doc_id", "__pk", "__pv", F.left("text", F.floor(F.col("__pn") / 2).cast("int")).alias("__begin"), "text"), "text", "__fp")
    first = first.select("doc_id", "__pk", "__pv", "__begin", hashes(F.col("__fp")).alias("__next"))
    first = first.withColumn("__r", F.row_number().over(to)).filter("__r = 1").drop("__r", "doc_id")  # with the same columns as below, so that texts are exchanged once
    own = keyed.select("doc_id", "text", "__k", "__v")
    met = own.join(first, (F.col("__k") == F.col("__pk")) & (F.col("__v") == F.col("__pv")))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = met.select("doc_id", "text", "__next", n.cast("long").alias("n_chars"), F.concat(F.left("text", n - half), "__begin").alias("edited"))
    pairs = winnowed(winnowed(edited, "text", "fp"), "edited", "edited_fp")
    sets = pairs.withColumns({"__a": hashes(F.col("fp")), "__e": hashes(F.col("edited_fp"))})
    return sets.select(
        "doc_id",
        "n_chars",
        "edited",
        "fp",
        "edited_fp",
        likeness(F.col("__a"), F.col("__e")).alias("near_edited"),
        likeness(F.col("__a"), F.col("__next")).alias("near_next"),
    )
