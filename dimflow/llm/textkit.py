"""Byte-level text kernels on Arrow batches: whole batches of texts at once,
with numpy, inside Spark tasks.

A batch of texts is one byte array plus document offsets.  Words are maximal
runs of bytes other than space and 0x09-0x0D; these bytes never occur inside a
multi-byte UTF-8 character, so byte words are the code-point words.  A word's
hash is a polynomial over its bytes modulo 2**64, finished with a bit mixer.
Working memory follows BLOCK (or one word, if longer), not the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
CHUNK = 1 << 20
_U = np.uint64

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = _U(0x9E3779B97F4A7C15 | 5)
_BASE_INV = _U(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift and multiply)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def mix_int(x: int) -> np.uint64:
    return mix(np.array([x & (1 << 64) - 1], dtype=_U))[0]


#: One random 64-bit value per byte, and the same with A-Z read as a-z.
BYTE_VALUES = mix(np.arange(1, 257, dtype=_U))
LOWER_VALUES = BYTE_VALUES.copy()
LOWER_VALUES[65:91] = BYTE_VALUES[97:123]


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=_U)
    p[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(p)


_POW, _INV = _powers(_BASE, 2 * BLOCK), _powers(_BASE_INV, 2 * BLOCK)


class Texts:
    """Some whole documents of a batch: ``data`` (uint8) and ``offsets``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first = data, offsets, first

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(starts, ends, cut): word byte bounds, and for each document the
        number of words before it (so ``cut[i]:cut[i + 1]`` are its words)."""
        solid = ~_SPACE[self.data]
        starts = solid.copy()
        starts[1:] &= ~solid[:-1]
        ends = solid.copy()
        ends[:-1] &= ~solid[1:]
        full = self.offsets[:-1][self.offsets[:-1] < self.offsets[1:]]
        starts[full] = solid[full]
        last = self.offsets[1:][self.offsets[:-1] < self.offsets[1:]] - 1
        ends[last] = solid[last]
        s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        return s, e, np.searchsorted(s, self.offsets)

    def hashes(self, starts: np.ndarray, ends: np.ndarray,
               values: np.ndarray = BYTE_VALUES) -> np.ndarray:
        """A 64-bit hash of each byte range; ranges are disjoint and ordered."""
        out = np.empty(len(starts), dtype=_U)
        i = 0
        with np.errstate(over="ignore"):
            while i < len(starts):
                lo = int(starts[i])
                j = max(i + 1, int(np.searchsorted(ends, lo + BLOCK, side="right")))
                size = int(ends[j - 1]) - lo
                p, q = (_POW, _INV) if size <= len(_POW) else (
                    _powers(_BASE, size), _powers(_BASE_INV, size))
                c = np.zeros(size + 1, dtype=_U)
                np.cumsum(values[self.data[lo:lo + size]] * p[:size], out=c[1:])
                s, e = starts[i:j] - lo, ends[i:j] - lo
                out[i:j] = mix((c[e] - c[s]) * q[s] + (e - s).astype(_U))
                i = j
        return out


def texts_of(column: pa.Array, limit: int = CHUNK) -> Iterator[Texts]:
    """The documents of an Arrow string column (null: empty), in pieces of
    whole documents of about ``limit`` bytes."""
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else \
        np.empty(0, dtype=np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(n, max(i + 1, j))
        lo, hi = int(offsets[i]), int(offsets[j])
        yield Texts(raw[lo:hi], offsets[i:j + 1] - lo, i)
        i = j


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words over a word-hash array (runs that cross
    documents are for the caller to leave out)."""
    n = max(0, len(hashes) - k + 1)
    acc = np.zeros(n, dtype=_U)
    with np.errstate(over="ignore"):
        for i in range(k):
            acc = mix(acc * _U(0x9FB21C651E98DF25) + hashes[i:i + n])
    return acc


def shingle_sets(texts: Texts, k: int, values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each document: runs of ``k``
    words; with fewer words the whole sequence is the one shingle."""
    s, e, cut = texts.words()
    h = texts.hashes(s, e, values)
    runs = windows(h, k)
    for d in range(len(texts)):
        a, b = int(cut[d]), int(cut[d + 1])
        if b - a >= k:
            yield texts.first + d, np.unique(runs[a:b - k + 1])
        elif b > a:
            yield texts.first + d, windows(h[a:b], b - a) + _U(b - a)
        else:
            yield texts.first + d, np.empty(0, dtype=_U)
