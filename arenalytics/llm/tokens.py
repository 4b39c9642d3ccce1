"""Runs of wanted bytes in whole Arrow batches, with numpy.

Like ``wordhash``, for token rules other than words between white space: a
token is a maximal run of bytes that ``wanted`` holds.  All rules here part
tokens at ASCII bytes only, so a run never cuts a UTF-8 character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def byte_table(*unwanted) -> np.ndarray:
    """256 flags: all bytes but those in ``unwanted`` (ranges or numbers)."""
    out = np.ones(256, bool)
    for u in unwanted:
        out[list(u) if isinstance(u, range) else u] = False
    return out


def runs(b: np.ndarray, off: np.ndarray, wanted: np.ndarray):
    """(starts, ends, text index) of the tokens of texts laid end to end in
    ``b``; ``off`` holds the texts' offsets, from 0 to ``len(b)``."""
    if not len(b):
        z = np.empty(0, np.int64)
        return z, z, z
    good = wanted[b]
    edge = np.zeros(len(b) + 1, bool)
    edge[off] = True                       # a token ends with its text
    first = good.copy()
    first[1:] &= ~good[:-1] | edge[1:-1]
    last = good.copy()
    last[:-1] &= ~good[1:] | edge[1:-1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(off, starts, "right") - 1


def prefix_ends(b: np.ndarray, starts: np.ndarray, ends: np.ndarray, chars: int) -> np.ndarray:
    """End of the first ``chars`` characters of each token (or of the token)."""
    at = np.append(np.flatnonzero((b & 0xC0) != 0x80), np.full(chars, len(b)))
    return np.minimum(at[np.searchsorted(at[:-chars], starts) + chars], ends)


class Held:
    """Counts per key, summed inside a task before they are sent on: at most
    about ``limit`` rows are held at a time."""

    def __init__(self, keys: list[str], limit: int, counts: list[str] | None = None):
        self.keys, self.counts, self.limit = keys, counts or ["c"], limit
        self.parts, self.rows = [], 0

    def add(self, keys: list[pa.Array], counts: list[pa.Array] | None = None) -> Iterator[pa.RecordBatch]:
        """Counts of one each unless given; yields what no longer fits."""
        counts = counts or [pa.array(np.ones(len(keys[0]), np.int64))]
        self.parts.append(pa.table([*keys, *counts], names=[*self.keys, *self.counts]))
        self.rows += len(keys[0])
        if self.rows > self.limit:
            self._sum()
            if self.rows > self.limit // 2:
                yield from self.send()

    def _sum(self) -> None:
        t = pa.concat_tables(self.parts).combine_chunks()
        t = t.group_by(self.keys, use_threads=False).aggregate([(c, "sum") for c in self.counts])
        t = t.select([*self.keys, *[f"{c}_sum" for c in self.counts]])
        self.parts, self.rows = [t.rename_columns([*self.keys, *self.counts])], len(t)

    def send(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            self._sum()
            yield from self.parts[0].to_batches(max_chunksize=1 << 16)
        self.parts, self.rows = [], 0
        pa.default_memory_pool().release_unused()      # workers live on between tasks
