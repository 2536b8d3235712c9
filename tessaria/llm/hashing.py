"""Words and hashes of words for whole batches of texts, as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

#: Texts are handled in groups of about so many bytes, whatever the size of an Arrow batch.
GROUP_BYTES = 2_000_000
#: Longer words are hashed one by one.
LONG_WORD = 48

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_U = np.uint64


def groups(sizes: list[int], most: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose sizes add up to ``most`` or a bit more."""
    start, total = 0, 0
    for i, n in enumerate(sizes):
        total += n
        if total >= most:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser that spreads all bits (Murmur3's)."""
    h = h ^ (h >> _U(33))
    h = h * _U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> _U(33))
    h = h * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


class Words:
    """The words of some texts: byte offsets, the text each belongs to, and ``first``: index of each text's first word."""

    def __init__(self, texts: list[bytes]):
        self.data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        space = _SPACE[self.data]
        edge = np.empty(len(space), bool)
        edge[0] = not space[0]
        np.not_equal(space[1:], space[:-1], out=edge[1:])
        at = np.flatnonzero(edge)
        self.starts, self.ends = at[0::2], at[1::2]
        begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.first = np.searchsorted(self.starts, begin)
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """64 bits a word."""
        lengths = self.ends - self.starts
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = self.starts[order], lengths[order]
        h = np.full(len(order), 0xCBF29CE484222325 ^ (seed * 0x9E3779B97F4A7C15 & (2**64 - 1)), _U)
        upto = int(min(LONG_WORD, lengths[0])) if len(lengths) else 0
        counts = np.searchsorted(-lengths, -np.arange(upto), side="left")
        prime = _U(0x100000001B3 if not seed else 0x9E3779B97F4A7C15)
        for j in range(upto):
            n = counts[j]
            h[:n] = (h[:n] ^ self.data[starts[:n] + j]) * prime
        for i in np.flatnonzero(lengths > LONG_WORD):
            h[i] = xxhash.xxh64_intdigest(self.data[starts[i] : starts[i] + lengths[i]].tobytes(), seed)
        out = np.empty_like(h)
        out[order] = mix(h + lengths.astype(_U))
        return out


def grams(h: np.ndarray, n: int, base: int = 0x9DDFEA08EB382D69) -> np.ndarray:
    """Hash of each run of ``n`` values, by the place of its first one; shorter by n - 1."""
    count = len(h) - n + 1
    if count <= 0:
        return h[:0]
    g = h[:count].copy()
    for j in range(1, n):
        g = g * _U(base | 1) + h[j : j + count]
    return mix(g)


def sliding_min(h: np.ndarray, n: int) -> np.ndarray:
    """The least of each run of ``n`` values; shorter by n - 1."""
    if len(h) < n:
        return h[:0]
    span = 1
    while span * 2 <= n:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    if span < n:
        h = np.minimum(h[: len(h) - (n - span)], h[n - span :])
    return h
