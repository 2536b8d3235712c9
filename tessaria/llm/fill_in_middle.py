"""Fill-in-middle: texts are cut in three, and the parts are put in another order between marks, so that it can be undone."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import permutations, product

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ends_clean, fields, named, passing, quoted, whole_texts
from .hashing import groups

#: Bytes of texts that are cut at a time.
GROUP_BYTES = 2_000_000


@dataclass(frozen=True)
class Marks:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        every = (self.prefix, self.suffix, self.middle)
        held = any(a in b for a, b in permutations(every, 2))
        overlap = any(a[-k:] == b[:k] for a, b in product(every, every) for k in range(1, min(len(a), len(b))))
        if not all(every) or held or overlap:
            raise ValueError("marks must not hold, equal or overlap each other, or they could not be told from texts beside them")

    def all(self) -> tuple[bytes, bytes, bytes]:
        return self.prefix.encode(), self.suffix.encode(), self.middle.encode()


class Exceptions:
    """Characters of more than one byte in some bytes of UTF-8: where they are, and how many bytes more than one they take.

    ``chars`` and ``at`` are their places in code points and in bytes, ``more`` the excess bytes up to and with each.
    Text without such characters has an empty index, and both kinds of places are the same numbers.
    """

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.more = np.cumsum(excess)
        self.chars = self.at - (self.more - excess)

    def __len__(self) -> int:
        return len(self.at)

    def _plus(self, before: np.ndarray) -> np.ndarray:
        return np.where(before > 0, self.more[before - 1], 0) if len(self) else np.zeros_like(before)

    def to_bytes(self, chars: np.ndarray) -> np.ndarray:
        """Byte places of cuts before these code points."""
        return chars + self._plus(np.searchsorted(self.chars, chars, side="left"))

    def to_chars(self, at: np.ndarray) -> np.ndarray:
        """Code points before these byte places, which lie between characters."""
        return at - self._plus(np.searchsorted(self.at, at, side="left"))


def draws(ids: Sequence[int | None], seed: int) -> np.ndarray:
    """Four numbers of 32 bits an id, from the digits of a hash of the seed and the id."""
    digests = [hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).digest()[:16] for i in ids]
    return np.frombuffer(b"".join(digests), ">u4").reshape(-1, 4).astype(np.int64)


FORMS = np.array(["plain", "psm", "spm"])


def cut(texts: list[bytes], ids: Sequence[int | None], by_line: bool, seed: int, rate: int, spm: int, marks: Marks) -> dict[str, list]:
    """Units, form, code points of prefix and middle, and the output of each text."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    index = Exceptions(data)
    size = np.array([len(t) for t in texts], np.int64)
    end = np.cumsum(size)
    start = end - size
    first_char = index.to_chars(start)
    if by_line:  # the ends of lines; a text's last line may have no newline
        ends = np.unique(np.concatenate([np.flatnonzero(data == 0x0A) + 1, end[size > 0]]))
        before = np.searchsorted(ends, start, side="right")
        n = np.searchsorted(ends, end, side="right") - before
    else:
        n = index.to_chars(end) - first_char
    h = draws(ids, seed)
    two = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)

    def place(units: np.ndarray) -> np.ndarray:
        if by_line:
            return np.where(units > 0, ends[np.maximum(before + units - 1, 0)] if len(ends) else 0, start)
        return index.to_bytes(first_char + units)

    p, m = place(two[:, 0]), place(two[:, 1])
    prefix_chars, middle_chars = index.to_chars(p) - first_char, index.to_chars(m) - index.to_chars(p)
    form = np.where(h[:, 3] % 100 < spm, 2, 1)
    form[(size == 0) | (h[:, 2] % 100 >= rate)] = 0
    pre, suf, mid = marks.all()
    output = []
    for i, t in enumerate(texts):
        if pre in t or suf in t or mid in t:
            form[i] = 0
        a, b = int(p[i] - start[i]), int(m[i] - start[i])
        output.append(t if form[i] == 0 else pre + t[:a] + suf + t[b:] + mid + t[a:b] if form[i] == 1 else suf + t[b:] + pre + t[:a] + mid + t[a:b])
    some = form > 0
    held = lambda x: [int(v) if ok else None for v, ok in zip(x, some, strict=True)]
    return {"n": n.tolist(), "form": FORMS[form].tolist(), "prefix_chars": held(prefix_chars), "middle_chars": held(middle_chars), "output": output}


def restore(output: bytes, form: str, marks: Marks = Marks()) -> bytes:
    """The text that an output of this form was made from; texts that hold marks are never cut, so each mark is there once."""
    pre, suf, mid = marks.all()
    if form == "plain":
        return output
    head, _, middle = output.partition(mid)
    a, b = head.split(suf if form == "psm" else pre)
    return a[len(pre) :] + middle + b if form == "psm" else b + middle + a[len(suf) :]


MADE = {"n": ("n", "bigint", pa.int64()), "form": ("form", "string", pa.string()), "prefix_chars": ("prefix_chars", "bigint", pa.int64()), "middle_chars": ("middle_chars", "bigint", pa.int64()), "output": ("output", "string", pa.string())}


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "line", seed: int = 7, rate: int = 100, spm: int = 50, marks: Marks = Marks(), prefix: str = "") -> DataFrame:
    """All columns of ``docs`` plus ``n``, ``form``, ``prefix_chars``, ``middle_chars`` and ``output``, each with ``prefix`` before its name.

    A text is cut at two places between its ``n`` units (``line``: up to and with each newline; ``char``: code points),
    which a hash of seed and id draws. ``rate`` per cent of the texts are cut, ``spm`` per cent of these have the suffix first.
    Form ``plain`` is the text as it is: empty texts, those that hold a mark, and those not drawn; their lengths are null.

    A null text is an empty one; a null id is drawn as an empty string; rows that repeat an id are cut at the same
    units of their own texts; equal texts under different ids are cut differently; an empty table gives no rows; very
    long texts are handled whole, a group of about two megabytes or one text at a time. Columns named like the results
    are replaced, all others pass through.

    One pass without a shuffle: a task holds one group of texts and an index of its characters beyond one byte.
    """
    if unit not in ("line", "char"):
        raise ValueError(f"unit is line or char, not {unit!r}")
    made = [prefix + c for c in MADE]
    rest = [c for c in docs.columns if c not in made]
    source = docs.select(*passing(rest), named(id_col).cast("string").alias("__id"), F.coalesce(named(text_col), F.lit("")).alias("__text"))

    def run(it):
        for batch in it:
            texts = batch.column("__text").cast(pa.binary())
            for a, b in groups(pc.binary_length(texts).to_pylist(), GROUP_BYTES):
                part = batch.slice(a, b - a)
                got = cut(texts.slice(a, b - a).to_pylist(), part.column("__id").to_pylist(), unit == "line", seed, rate, spm, marks)
                new = [pa.array(got[k], pa.binary()).cast(pa.string()) if k == "output" else pa.array(got[k], t) for k, (_, _, t) in MADE.items()]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(rest))), *new], [*rest, *made])

    return whole_texts(source).mapInArrow(ends_clean(run), ", ".join([*fields(docs, rest), *(f"{quoted(c)} {t}" for c, (_, t, _) in zip(made, MADE.values(), strict=True))]))


def restored(rows: DataFrame, output_col: str = "output", form_col: str = "form", name: str = "restored", marks: Marks = Marks()) -> DataFrame:
    """``rows`` plus the text from which each output was made; a null output stays null. One pass, whole texts.

    A column called ``name`` is replaced; nulls in ``form`` count as plain.
    """
    rest = [c for c in rows.columns if c != name]
    source = rows.select(*passing(rest), named(output_col).alias("__output"), F.coalesce(named(form_col), F.lit("plain")).alias("__form"))

    def run(it):
        for batch in it:
            outputs = batch.column("__output").cast(pa.binary())
            for a, b in groups([n or 0 for n in pc.binary_length(outputs).to_pylist()], GROUP_BYTES):
                part = batch.slice(a, b - a)
                texts = [None if o is None else restore(o, f, marks) for o, f in zip(outputs.slice(a, b - a).to_pylist(), part.column("__form").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in range(len(rest))), pa.array(texts, pa.binary()).cast(pa.string())], [*rest, name])

    return whole_texts(source).mapInArrow(ends_clean(run), ", ".join([*fields(rows, rest), f"{quoted(name)} string"]))
