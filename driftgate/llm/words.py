"""Words, lines and shingles of many texts as flat numpy arrays.

A word is a maximal run of bytes other than space and 0x09-0x0D.  Texts come
as one Arrow string column; nothing here builds a Python string.  Hashes are
64-bit: a prefix polynomial over random byte values, taken modulo 2**64 and
mixed.  All randomness is fixed by constants, so every task and every rerun
agrees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_BASE = 0x5851F42D4C957F2B  # odd and 3 modulo 8: powers keep their low bits apart
_INV = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def _values(seed: int, n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _GOLD + np.uint64(seed))


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_RAW = _values(11, 256)
_FOLDED = _RAW.copy()
_FOLDED[65:91] = _RAW[97:123]
_NORMAL = _FOLDED.copy()
_NORMAL[48:58] = _RAW[48]
TABLES = {"raw": _RAW, "lower": _FOLDED, "normal": _NORMAL}
_COEF = _values(12, 64) | np.uint64(1)

_powers: dict[str, np.ndarray] = {}


def _pow(n: int, inverse: bool) -> np.ndarray:
    key = "i" if inverse else "p"
    if key not in _powers or len(_powers[key]) <= n:
        a = np.full(max(n + 1, CHUNK_BYTES + 1), _INV if inverse else _BASE, np.uint64)
        a[0] = 1
        _powers[key] = np.cumprod(a, dtype=np.uint64)
    return _powers[key][: n + 1]


def spans_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the items [start, end) under a prefix sum made by ``prefix_sum``."""
    inv = _pow(len(prefix), True)
    return mix((prefix[end] - prefix[start]) * inv[start] + (end - start).astype(np.uint64))


def prefix_sum(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _pow(len(values), False)[: len(values)], out=out[1:], dtype=np.uint64)
    return out


def slices(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` text bytes, or of one longer text."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64)
    lo, total = 0, 0
    for i, s in enumerate(sizes):
        if i > lo and total + s > limit:
            yield lo, i
            lo, total = i, 0
        total += s
    if lo < len(sizes):
        yield lo, len(sizes)


class Texts:
    """Words of rows of an Arrow string column (null: no text)."""

    def __init__(self, column: pa.Array, table: str = "raw"):
        column = pc.fill_null(column.cast(pa.large_string()), "")
        _, offsets, data = column.buffers()
        off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
        raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
        self.n, self.raw, self.off = len(column), raw, (off - off[0]).astype(np.int64)
        space = _SPACE[raw]
        first = np.zeros(len(raw), bool)
        first[self.off[:-1][self.off[:-1] < len(raw)]] = True  # a text starts here
        word = ~space
        before = np.empty(len(raw), bool)
        before[:1] = False
        before[1:] = word[:-1]
        self.start = np.flatnonzero(word & (first | ~before))
        after = np.ones(len(raw) + 1, bool)
        after[:-1] = space | first
        self.end = np.flatnonzero(word & after[1:]) + 1 if len(raw) else self.start
        self.doc = np.searchsorted(self.off, self.start, "right") - 1
        #: words of row i are bounds[i]:bounds[i+1]
        self.bounds = np.searchsorted(self.start, self.off)
        self.table = table
        self.bytes_prefix = prefix_sum(TABLES[table][raw])
        self.hash = spans_hash(self.bytes_prefix, self.start, self.end)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Start word and hash of every run of k words within one text."""
        n = len(self.hash) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero(self.doc[:n] == self.doc[k - 1 :])
        return at, run_hash(self.hash, k)[at]

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Sum over each text of per-byte values."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.off[1:]] - total[self.off[:-1]]

    def per_words(self, flags: np.ndarray) -> np.ndarray:
        """Sum over each text of per-word values."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start byte, end byte and row of each newline-split line (an empty text is one empty line)."""
        cut = np.flatnonzero(self.raw == 10)
        start = np.concatenate([self.off[:-1], cut + 1])
        row = np.concatenate([np.arange(self.n), np.searchsorted(self.off, cut, "right") - 1])
        order = np.lexsort((start, row))
        start, row = start[order], row[order]
        end = np.empty_like(start)
        end[:-1] = start[1:] - 1
        last = np.ones(len(row), bool)
        last[:-1] = row[1:] != row[:-1]
        end[last] = self.off[1:][row[last]]
        return start, end, row


def run_hash(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k consecutive items, in order."""
    n = len(h) - k + 1
    out = np.zeros(max(n, 0), np.uint64)
    for j in range(k if n > 0 else 0):
        out += h[j : j + n] * _COEF[j]
    return mix(out)


def covered(n: int, start: np.ndarray, length: int | np.ndarray) -> np.ndarray:
    """Which of n places lie in one of the runs [start, start + length)."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, start, 1)
    np.add.at(d, start + length, -1)
    return np.cumsum(d[:-1]) > 0
