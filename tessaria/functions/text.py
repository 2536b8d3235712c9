"""Scalar functions on text: cleaning, names, paths, literals held in strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that a title leaves in lower case, unless they come first or last; misspellings.
SMALL_WORDS = ["and", "or", "of", "the", "in", "on", "at", "to", "for"]
TYPOS = {"perenial": "perennial"}


def clip_tail(c: Column, n: int = 60) -> Column:
    return F.when(F.length(c) > n, F.concat(F.lit("..."), F.right(c, F.lit(n - 3)))).otherwise(c)


def clip_head(c: Column, n: int = 50) -> Column:
    return F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n - 3)), F.lit("..."))).otherwise(c)


def natural_key(c: Column) -> Column:
    """A key under which runs of digits, of any length, sort as numbers among texts in lower case.

    Texts and numbers take turns, a text first, be it empty. A text ends in two zero characters, and one inside it gets a
    mark, so a shorter text comes before those that go on from it; a number is its length, in ten digits, and its digits
    without leading zeros. Equal numbers with other zeros have equal keys.
    """
    end = "\0\0"
    parts = F.regexp_extract_all(F.lower(c), F.lit(r"[0-9]+|[^0-9]+"), F.lit(0))
    bare = lambda x: F.regexp_replace(x, "^0+(?=[0-9])", "")
    number = lambda x: F.concat(F.lpad(F.length(bare(x)).cast("string"), 10, "0"), bare(x))
    text = lambda x: F.concat(F.replace(x, F.lit("\0"), F.lit("\0\x01")), F.lit(end))
    first = F.when(c.rlike("^[0-9]"), end).otherwise("")
    return F.concat(first, F.array_join(F.transform(parts, lambda x: F.when(x.rlike("^[0-9]"), number(x)).otherwise(text(x))), ""))


def numbers(c: Column) -> Column:
    """``[..]`` or ``(..)`` of numbers as an array; null if it isn't one."""
    return F.from_json(F.translate(c, "()", "[]"), "array<double>", {"mode": "PERMISSIVE"})


def box(c: Column) -> Column:
    """x, y, width, height as whole numbers, half to even; four zeros where there is no box."""
    a = numbers(c)
    good = (F.size(a) == 4) & F.forall(a, lambda x: x.isNotNull())
    return F.coalesce(F.when(good, F.transform(a, lambda x: F.bround(x).cast("int"))), F.array(*[F.lit(0)] * 4))


def rgb(c: Column, fallback: tuple[int, int, int] = (0, 255, 0)) -> Column:
    """Three whole numbers; components that all lie in 0..1 are shares of 255."""
    a = numbers(c)
    good = (F.size(a) == 3) & F.forall(a, lambda x: x.isNotNull())
    scaled = F.when(F.forall(a, lambda x: x.between(0, 1)), F.transform(a, lambda x: (x * 255).cast("int"))).otherwise(F.transform(a, lambda x: x.cast("int")))
    return F.coalesce(F.when(good, scaled), F.array(*map(F.lit, fallback)))


def rgb_clamped(a: Column) -> Column:
    return F.transform(a, lambda v: F.least(F.lit(255), F.greatest(F.lit(0), v)))


def hex_colour(c: Column) -> Column:
    """``#RRGGBB`` of three or six hex digits; anything else as it is."""
    body = F.regexp_replace(F.trim(c), "^#", "")
    six = F.when(body.rlike("^[0-9A-Fa-f]{3}$"), F.regexp_replace(body, "(.)", "$1$1")).when(body.rlike("^[0-9A-Fa-f]{6}$"), body)
    return F.coalesce(F.concat(F.lit("#"), F.upper(six)), F.trim(c))


def aliases(a: Column) -> Column:
    """Trimmed, without empty ones, the first of each."""
    return F.array_distinct(F.filter(F.transform(a, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != "")))


def trim_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def capitalise(c: Column) -> Column:
    return F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substring(c, 2, 1_000_000)))


def title(c: Column) -> Column:
    """Each word's first letter upper, the rest lower, single spaces; small words, in brackets or not, stay lower between others."""
    words = F.filter(F.split(F.lower(c), r"\s+"), lambda w: w != "")
    bare = lambda w: F.regexp_replace(w, r"^[()\[\],.]+|[()\[\],.]+$", "")
    return F.array_join(F.transform(words, lambda w, i: F.when((i > 0) & (i < F.size(words) - 1) & bare(w).isin(SMALL_WORDS), w).otherwise(_title_word(w))), " ")


def typos(c: Column) -> Column:
    for wrong, right in TYPOS.items():
        c = F.replace(c, F.lit(wrong), F.lit(right))
    return c


def _title_word(w: Column) -> Column:
    """A letter after anything but a letter is upper."""
    parts = F.regexp_extract_all(w, F.lit(r"\p{L}+|\P{L}+"), F.lit(0))
    return F.array_join(F.transform(parts, lambda x: F.concat(F.upper(F.left(x, F.lit(1))), F.substring(x, 2, 1_000_000))), "")


def separators(c: Column) -> Column:
    """One space after a comma, none round a slash, single spaces."""
    c = F.regexp_replace(c, r"\s*,\s*", ", ")
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"\s*/\s*", "/"), r"\s{2,}", " "))


def safe_name(c: Column, default: str = "unnamed", longest: int = 200) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"\s+", "_"), r"[^a-z0-9._-]", "_")
    s = F.regexp_replace(F.regexp_replace(s, "_+", "_"), r"^[_.]+|[_.]+$", "")
    return F.coalesce(F.nullif(F.left(s, F.lit(longest)), F.lit("")), F.lit(default))


def stem(c: Column) -> Column:
    """The file name without folders and its last suffix."""
    return F.regexp_replace(F.regexp_replace(c, r"^.*/", ""), r"(?<=.)\.[^.]*$", "")


def without_mask(c: Column) -> Column:
    return F.regexp_replace(c, r"_mask$", "")


def record_id(c: Column) -> Column:
    """The id in a stem: STATE_digits_digits, else PREFIX_8digits_6digits, else a trailing run of four digits or more."""
    found = [F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")) for pattern in (r"(?<![A-Z])([A-Z]{2}_\d{6,}_\d+)", r"([A-Z]+_\d{8}_\d{6})", r"(\d{4,})$")]
    return F.coalesce(*found)


def path(*parts: Column) -> Column:
    """Parts joined by slashes; later ones lose theirs at the start."""
    return F.concat_ws("/", F.regexp_replace(parts[0], "/+$", ""), *(F.regexp_replace(x, "^/+", "") for x in parts[1:]))


def slug(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(c)), r"[\s-]+", "_")


def season(month: Column) -> Column:
    return F.when(month.isin(12, 1, 2), "winter").when(month.isin(3, 4, 5), "spring").when(month.isin(6, 7, 8), "summer").otherwise("fall")
