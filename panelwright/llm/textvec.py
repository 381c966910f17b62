"""Words of many texts at once, as numpy arrays over an Arrow batch: starts, ends and 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_P = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INV = pow(_P, -1, 1 << 64)
_POWERS: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]

#: Byte tables: A-Z to a-z, and the separators of words.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
NEWLINE = np.zeros(256, bool)
NEWLINE[0x0A] = True


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary or string column (no nulls) and where each value starts, without a copy."""
    kind = np.int64 if pa.types.is_large_binary(texts.type) or pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about `size` bytes, so that the arrays stay in cache; a longer text is a run of its own."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n + 1:
        m = max(n + 1, 1 << 20)
        for k, base in enumerate((_P, _INV)):
            x = np.full(m, base, _U)
            x[0] = 1
            _POWERS[k] = np.multiply.accumulate(x)
    return _POWERS[0], _POWERS[1]


def mix(h: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


class Words:
    """Maximal runs of bytes that `sep` doesn't hold, in texts laid end to end; no run crosses a text's border.

    start, end: byte positions; first: index of each text's first word, one more at the end; doc: text of each word.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, sep: np.ndarray):
        inside = ~sep[data]
        begin, last = inside.copy(), inside.copy()
        if len(data):
            begin[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            border = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
            begin[border] = inside[border]
            last[border - 1] = inside[border - 1]
        self.data, self.inside = data, inside
        self.start, self.end = np.flatnonzero(begin), np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.n = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.n)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes: a polynomial by prefix sums modulo 2**64, then mixed."""
        power, inverse = _powers(len(self.data))
        total = np.zeros(len(self.data) + 1, _U)
        np.cumsum((self.data.astype(_U) + _U(1)) * power[: len(self.data)], out=total[1:])
        return mix((total[self.end] - total[self.start]) * inverse[self.start])


def windows(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start (word index) and hash of every run of `size` words inside one text."""
    if len(hashes) < size:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    at = np.flatnonzero(words.doc[: len(hashes) - size + 1] == words.doc[size - 1 :])
    total = np.zeros(len(at), _U)
    for k in range(size):
        total = total * _U(_P) + hashes[at + k]
    return at, mix(total)


def per_doc(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of `flags` between offsets."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]
