"""Documents dealt to chunks of a few MB, and what chunks exchange.

Several operators look up every distinct key of a chunk (n-grams, byte strings)
among those of all chunks.  As rows these keys would be several times the text;
here a chunk sends them sorted and packed, one blob per key range, and gets the
answers back in the order of its own keys.  Texts travel compressed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame

from .common import id_and_text

CHUNK_BYTES = 2 << 20      # a task holds some twenty times this in arrays

Key = tuple[pa.Scalar, ...]


def squeeze(a: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes (high, mostly equal bytes together)."""
    planes = np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueeze(b: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view("<u8").reshape(-1)


def squeeze_sorted(keys: np.ndarray) -> bytes:
    return squeeze(np.diff(keys, prepend=np.uint64(0)))


def unsqueeze_sorted(b: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(b), dtype=np.uint64)


def zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``text`` (last column) compressed text by text."""
    z = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        texts = [z.compress(t.as_buffer()) for t in batch.column("text").cast(pa.large_binary())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.binary())],
                                         names=batch.schema.names)


def unzipped(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts of a chunk, in the order of its rows."""
    z = zstandard.ZstdDecompressor()
    texts = [z.decompress(t.as_buffer()) for t in table.column("text")]
    off = np.cumsum([0, *map(len, texts)])
    return np.frombuffer(b"".join(texts), np.uint8), off


def in_chunks(docs: DataFrame, chunk: Column) -> DataFrame:
    """(doc_id, chunk, text) with ``text`` compressed."""
    d = id_and_text(docs).select("doc_id", chunk.cast("long").alias("chunk"), "text")
    return d.mapInArrow(zipped, "doc_id long, chunk long, text binary")


def range_bits(chunks: int) -> int:
    """Bits of the key-range number: as many ranges as chunks, or up to twice."""
    return max(4, (chunks - 1).bit_length())


def range_edges(keys: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """(range, first, end) of the ranges that ``keys`` (sorted) have."""
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    at = np.r_[0, np.searchsorted(keys, edges), len(keys)]
    return [(p, int(a), int(z)) for p, (a, z) in enumerate(zip(at[:-1], at[1:])) if z > a]


def rows_table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    cols = list(zip(*rows)) or [[]] * len(schema)
    return pa.table([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)
