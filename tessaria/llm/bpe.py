"""Byte-level BPE: encoding with the tokenizers library over Arrow batches, and decoding by the reversed byte table."""

from __future__ import annotations

import base64
import os
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ends_clean, fields, named, passing, whole_texts
from .hashing import groups

#: Bytes of text or ids handled at a time, and bytes given to the library at a time: its results take many times as much.
GROUP_BYTES, LIBRARY_BYTES = 1_000_000, 50_000
#: Bytes that the pieces a task remembers may take; longer pieces are not remembered.
REMEMBERED_BYTES, LONGEST_REMEMBERED = 48_000_000, 64


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """The place of a public vocabulary that is installed on every node."""
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_characters() -> dict[str, int]:
    """The byte table: printable Latin-1 bytes stand for themselves, the others for characters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True  # their strings in a text are ordinary text
    return found


def ranks(path: str) -> Iterator[tuple[int, bytes]]:
    """Ranks and tokens of a file of ranks: base64 of a token's bytes, and its rank, by line."""
    with open(path, "rb") as f:
        for a, b in map(bytes.split, f):
            yield int(b), base64.b64decode(a)


def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id; specials are their own text.

    Where a file of ranks lies beside the vocabulary, the two must agree.
    """
    table, tokenizer = byte_characters(), _tokenizer(path)
    found = {i: bytes(table[c] for c in token) for token, i in tokenizer.get_vocab(with_added_tokens=False).items() if all(c in table for c in token)}
    found |= {i: t.content.encode() for i, t in tokenizer.get_added_tokens_decoder().items()}
    if os.path.exists(beside := path.removesuffix(".json") + ".tiktoken") and any(found.get(i) != b for i, b in ranks(beside)):
        raise ValueError(f"{path} and {beside} differ")
    return [found.get(i, b"") for i in range(max(found) + 1)]


def character_offsets(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code point ranges of tokens of so many bytes each; a token that holds part of a character covers all of it."""
    ends = np.cumsum(lengths)
    starts = ends - lengths
    char = np.cumsum((data & 0xC0) != 0x80, dtype=np.int32) - 1
    return char[starts], char[ends - 1] + 1


_ASCII = np.arange(256)
_ALNUM = np.isin(_ASCII, np.frombuffer(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", np.uint8))
_PRINTED = (_ASCII > 0x20) & (_ASCII < 0x7F)
#: First bytes of printable ASCII characters but the apostrophe, which may start a match with letters, and of U+00C0 to U+023F.
_SIGN, _SAFE = _PRINTED & ~_ALNUM & (_ASCII != 0x27), _PRINTED | (_ASCII >= 0xC3) & (_ASCII <= 0xC8)


def _starts(data: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Where pieces start, so that each can be merged alone: places at which a match of the pattern starts in any text.

    These are a space before a printed character, a sign after a letter or digit, a newline after a printed character,
    and a printed character after such a newline. ``begin``: where texts start, each of which starts a piece.
    """
    start = np.zeros(len(data), bool)
    printed, newline, safe = _PRINTED[data], data == 0x0A, _SAFE[data]
    start[:-1] = (data[:-1] == 0x20) & safe[1:]
    start[1:] |= _ALNUM[data[:-1]] & _SIGN[data[1:]] | printed[:-1] & newline[1:]
    start[2:] |= printed[:-2] & newline[1:-1] & safe[2:]
    start[begin[1:] - 1] &= data[begin[1:] - 1] != 0x20  # what follows a text's last character is another text
    start[begin] = True
    return np.flatnonzero(start)


class _Pieces:
    """Ids of texts, piece by piece. Arrow finds the distinct pieces of a batch; new ones go through the library."""

    def __init__(self, path: str):
        self.tokenizer, self.table = _tokenizer(path), _table(path)
        self.known: dict[str, bytes] = {}
        self.used = 0

    def _made(self, pieces: list[str], sizes: np.ndarray, plain: np.ndarray) -> list[bytes]:
        """``plain`` pieces, which start and end in a printed character, go through the library as lines of one text."""
        out = [b""] * len(pieces)
        for some in (np.flatnonzero(plain), np.flatnonzero(~plain)):
            for a, b in groups(sizes[some].tolist(), LIBRARY_BYTES):
                here = some[a:b]
                chunk = [pieces[k] for k in here]
                if plain[here[0]]:
                    ids = np.array(self.tokenizer.encode("\n".join(chunk), add_special_tokens=False).ids, np.int32)
                    until = np.cumsum(self.table.sizes[ids])
                    end = np.cumsum(sizes[here] + 1) - 1
                    packed, first, last = ids.tobytes(), np.searchsorted(until, end - sizes[here], side="right"), np.searchsorted(until, end) + 1
                    made = [packed[4 * i : 4 * j] for i, j in zip(first.tolist(), last.tolist(), strict=True)]
                else:
                    made = [array("i", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(chunk, add_special_tokens=False)]
                for k, ids in zip(here.tolist(), made, strict=True):
                    out[k] = ids
        return out

    def _ids(self, distinct: pa.Array) -> list[bytes]:
        """int32 ids of each piece, packed."""
        pieces, known = distinct.to_pylist(), self.known
        found = [known.get(p) for p in pieces]
        new = [k for k, i in enumerate(found) if i is None]
        if new:
            begin, data = _buffers(distinct)
            sizes, first = np.diff(begin)[new], begin[:-1][new]
            head = data[first]
            plain = (_SAFE[head] | (head == 0x20) & (sizes > 1) & _SAFE[data[first + (sizes > 1)]]) & _PRINTED[data[first + sizes - 1]]
            made = self._made([pieces[k] for k in new], sizes, plain)
            short = [(pieces[k], ids) for k, ids, n in zip(new, made, sizes.tolist(), strict=True) if n <= LONGEST_REMEMBERED]
            for k, ids in zip(new, made, strict=True):
                found[k] = ids
            more = 150 * len(short) + 2 * int(sizes[sizes <= LONGEST_REMEMBERED].sum())
            if self.used + more > REMEMBERED_BYTES:
                known.clear()
                self.used = 0
            known.update(short)
            self.used += more
        return found

    def encode(self, texts: pa.Array) -> pa.ListArray:
        begin, data = _buffers(texts)
        start = _starts(data, begin[:-1][begin[:-1] < begin[1:]]) if len(data) else np.zeros(0, np.int64)
        places = np.append(start, len(data)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.string(), len(start), [None, pa.py_buffer(places), pa.py_buffer(data)]).dictionary_encode()
        packed = self._ids(pieces.dictionary)
        size = np.array([len(i) // 4 for i in packed], np.int64)
        at = pieces.indices.to_numpy(zero_copy_only=False)
        ids = taken(np.frombuffer(b"".join(packed), np.int32), np.cumsum(size) - size, size, at)
        until = np.cumsum(np.append(0, size[at]))
        return pa.ListArray.from_arrays(pa.array(until[np.searchsorted(start, begin)].astype(np.int32)), pa.array(ids))


def taken(flat: np.ndarray, first: np.ndarray, size: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The rows ``at`` of a table whose row k is flat[first[k] : first[k] + size[k]], one after the other."""
    n = size[at]
    end = np.cumsum(n)
    return flat[np.repeat(first[at] - (end - n), n) + np.arange(int(end[-1]) if len(end) else 0)]


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0, with the end) and bytes of a string or binary array without nulls."""
    if not len(texts):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return offsets - offsets[0], data


def _character_lists(texts: pa.Array, ids: pa.ListArray, sizes: np.ndarray) -> list[pa.Array]:
    """Starts and ends of the tokens of all ``texts``, each counted from its own text's start."""
    every = ids.values.to_numpy()
    if not len(every):
        return [ids, ids]
    begin, data = _buffers(texts)
    chars = np.cumsum(np.append(0, (data & 0xC0) != 0x80))[begin[:-1]]
    before = np.repeat(chars, np.diff(ids.offsets.to_numpy())).astype(np.int32)
    return [pa.ListArray.from_arrays(ids.offsets, pa.array(x - before)) for x in character_offsets(data, sizes[every])]


class _Table:
    """The bytes of all ids, one after the other; an id outside the vocabulary counts as one more without bytes."""

    def __init__(self, path: str):
        found = token_bytes(path)
        self.top = len(found)
        self.sizes = np.array([*(len(b) for b in found), 0], np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(found), np.uint8)

    def decode(self, ids: pa.ListArray) -> pa.Array:
        count = pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
        at = pc.fill_null(ids.flatten(), -1).to_numpy()
        at = np.where((at >= 0) & (at < self.top), at, self.top)
        until = np.cumsum(np.append(0, self.sizes[at]))
        data = taken(self.data, self.first, self.sizes, at)
        offsets = until[np.cumsum(np.append(0, count))].astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


@cache
def _table(path: str) -> _Table:
    return _Table(path)


def _characters(column: pa.Array) -> pa.Array:
    """The same as text; only where some bytes form no characters is it made row by row."""
    try:
        return column.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([x.decode(errors="replace") for x in column.to_pylist()], pa.string())


def _encoded(texts: pa.Array, pieces: _Pieces, table: _Table, offsets: bool) -> list[pa.Array]:
    ids = pieces.encode(texts)
    return [ids, *(_character_lists(texts, ids, table.sizes) if offsets else [])]


def _decoded(ids: pa.ListArray, table: _Table, text: bool) -> list[pa.Array]:
    data = table.decode(ids)
    return [data, *([_characters(data)] if text else [])]


ENCODED, OFFSETS, DECODED = {"ids": "array<int>"}, {"starts": "array<int>", "ends": "array<int>"}, {"decoded": "binary", "decoded_text": "string"}


def _mapped(source: DataFrame, rest: list[str], read: Column, made: dict[str, str], path: str, sized, results) -> DataFrame:
    """``results(part, pieces, table)`` for parts of batches that hold ``read``, of about GROUP_BYTES by ``sized(batch)``."""

    def run(it):
        pieces, table = _Pieces(path), _table(path)
        for batch in it:
            for a, b in groups(sized(batch), GROUP_BYTES):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(len(rest))), *results(part, pieces, table)], [*rest, *made])

    return whole_texts(source.select(*passing(rest), read)).mapInArrow(ends_clean(run), ", ".join([*fields(source, rest), *(f"{c} {t}" for c, t in made.items())]))


def _text(name: str) -> Column:
    return F.coalesce(named(name), F.lit("")).alias("__text")


def _text_bytes(batch: pa.RecordBatch) -> list[int]:
    return pc.binary_length(batch.column("__text")).to_pylist()


def encode(docs: DataFrame, text_col: str = "text", path: str | None = None, offsets: bool = False) -> DataFrame:
    """The columns of ``docs`` but for the text, and ``ids``; with ``offsets`` also ``starts`` and ``ends`` (code points).

    Each match of the vocabulary's pattern is merged for itself; no special tokens are added or recognised. A null or
    empty text has no ids; repeated rows stay; an empty table gives no rows; a column called like a result is replaced.
    A text is handled as a whole, however long: it takes some forty times its bytes in one task.
    """
    path = path or vocabulary()
    made = ENCODED | (OFFSETS if offsets else {})
    rest = [c for c in docs.columns if c != text_col and c not in made]
    return _mapped(docs, rest, _text(text_col), made, path, _text_bytes, lambda part, pieces, table: _encoded(part.column("__text"), pieces, table, offsets))


def decode(rows: DataFrame, ids_col: str = "ids", path: str | None = None, text: bool = True) -> DataFrame:
    """``rows`` plus ``decoded`` (binary) and, with ``text``, ``decoded_text``.

    Ids are turned into bytes before bytes are turned into characters, so a character split over tokens is whole again;
    bytes that form none, as where a list ends inside a character, become U+FFFD. Null ids are an empty list; an id
    outside the vocabulary, or a null one, has no bytes. Repeated rows stay; columns called like a result are replaced.
    """
    path = path or vocabulary()
    made = {c: t for c, t in DECODED.items() if text or c != "decoded_text"}
    rest = [c for c in rows.columns if c not in DECODED]
    sized = lambda batch: [4 * (n or 0) for n in pc.list_value_length(batch.column("__ids")).to_pylist()]
    return _mapped(rows, rest, named(ids_col).alias("__ids"), made, path, sized, lambda part, pieces, table: _decoded(part.column("__ids"), table, text))


def encode_decode(docs: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """``decode(encode(docs, offsets=True))`` in one pass, so that ids need not leave the task between the two."""
    path = path or vocabulary()
    made = ENCODED | OFFSETS | DECODED
    rest = [c for c in docs.columns if c != text_col and c not in made]
    def results(part: pa.RecordBatch, pieces: _Pieces, table: _Table) -> list[pa.Array]:
        encoded = _encoded(part.column("__text"), pieces, table, True)
        return [*encoded, *_decoded(encoded[0], table, True)]

    return _mapped(docs, rest, _text(text_col), made, path, _text_bytes, results)
