"""Word boundaries and 64-bit word hashes of whole Arrow batches with numpy.

Used inside Spark tasks: one call handles all documents of a slice of a batch
at once, so the cost per word is a few vector operations.  Words are runs of
anything but the bytes 0x20 and 0x09-0x0D, A-Z lower-cased.  Words are named
by a 64-bit hash (a polynomial modulo 2**64, then mixed).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_LOWER += 1                     # no byte counts as zero
# separators of loose words: every ASCII byte that is no letter or digit
_LOOSE = np.ones(256, bool)
_LOOSE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

_BASE = 0x9E3779B97F4A7C15 | 1
_POW = _INV = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if len(_POW) < n:
        size = max(n, SLICE_BYTES + 1)
        with np.errstate(over="ignore"):
            _POW = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, _BASE, np.uint64)],
                              dtype=np.uint64)
            _INV = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, pow(_BASE, -1, 1 << 64),
                                                          np.uint64)], dtype=np.uint64)
    return _POW, _INV


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    a = column.cast(pa.large_binary()).fill_null(b"")
    _, off, data = a.buffers()
    off = np.frombuffer(off, np.int64)[a.offset:a.offset + len(a) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data, off


def slices(off: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about ``limit`` bytes (one long text at least)."""
    i, n = 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def word_bounds(b: np.ndarray, off: np.ndarray, loose: bool = False):
    """(starts, ends, word offsets per text) of texts laid end to end in ``b``."""
    if not len(b):
        z = np.empty(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    sep = (_LOOSE if loose else _SPACE)[b]
    edge = np.empty(len(b) + 1, bool)
    edge[0] = edge[-1] = True
    edge[1:-1] = sep[:-1]
    edge[off[:-1]] = True
    starts = np.flatnonzero(~sep & edge[:-1])
    edge[1:-1] = sep[1:]
    edge[off] = True
    ends = np.flatnonzero(~sep & edge[1:]) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    pow_, inv = _powers(len(b) + 1)
    total = np.empty(len(b) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_LOWER[b] * pow_[:len(b)], out=total[1:])
    return mix((total[ends] - total[starts]) * inv[starts])


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes (texts not regarded)."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    out = h[:len(h) - n + 1].copy()
    for k in range(1, n):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += h[k:len(h) - n + 1 + k]
    return mix(out)


def shingles(h: np.ndarray, woff: np.ndarray, n: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its ``n``-word shingles; a text
    with fewer words has its whole sequence as the only one, a text without
    words none."""
    grams = ngram_hashes(h, n)
    out = []
    for a, z in zip(woff[:-1].tolist(), woff[1:].tolist()):
        if z - a >= n:
            out.append(np.unique(grams[a:z - n + 1]))
        elif z > a:
            # the length parts a short sequence from any n-word shingle
            out.append(ngram_hashes(h[a:z], z - a) ^ np.uint64((z - a) * 0x9FB21C651E98DF25
                                                               & 0xFFFFFFFFFFFFFFFF))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def shingle_sets(column: pa.Array, n: int = 5) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(index of the first text, shingle sets) slice by slice."""
    data, off = texts_of(column)
    for i, j in slices(off):
        b = data[off[i]:off[j]]
        o = off[i:j + 1] - off[i]
        starts, ends, woff = word_bounds(b, o)
        yield i, shingles(word_hashes(b, starts, ends), woff, n)
