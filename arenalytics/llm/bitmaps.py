"""Bitmaps of fixed size over hashed keys.

A set of keys that grows with the corpus must not be broadcast.  What a scan
needs of it is only a filter: tasks get a bitmap of ``1 << BITS`` bits (4 MB,
whatever the set's size), send on the rows whose key has its bit set, and the
shuffled rows are joined with the set itself.  A fuller bitmap lets more rows
through; it never changes a result.
"""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 25
_ROW = 15                                  # bits numbered inside one 4 KB row
MASK = np.uint64((1 << BITS) - 1)
_SHIFT = 20                                # the second word of a pair is taken from here


def pair_position(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Bit of a pair of (mixed) hashes; the same as ``pair_column``."""
    return (first ^ (second >> np.uint64(_SHIFT))) & MASK


def pair_column(first: str, second: str) -> Column:
    return F.col(first).bitwiseXOR(F.shiftrightunsigned(F.col(second), _SHIFT)) \
            .bitwiseAND(F.lit(int(MASK)))


def position_column(key: str) -> Column:
    return F.col(key).bitwiseAND(F.lit(int(MASK)))


def bitmap(keys: DataFrame, position: Column) -> Broadcast:
    """The bitmap of the positions of ``keys``, in every executor.  At most
    ``1 << (BITS - 15)`` rows of 4 KB reach the driver."""
    rows = (keys.select(position.alias("p"))
            .groupBy(F.shiftright("p", _ROW).cast("int").alias("row"))
            .agg(F.bitmap_construct_agg(F.col("p").bitwiseAND(F.lit((1 << _ROW) - 1))).alias("bits"))
            .collect())
    out = np.zeros(1 << (BITS - 3), np.uint8)
    for r in rows:
        at = r["row"] << (_ROW - 3)
        out[at:at + len(r["bits"])] = np.frombuffer(r["bits"], np.uint8)
    return keys.sparkSession.sparkContext.broadcast(out)


def has(bits: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Whether the bit at each position is set."""
    return (bits[(position >> np.uint64(3)).astype(np.int64)]
            >> (position & np.uint64(7)).astype(np.uint8)) & 1 == 1
