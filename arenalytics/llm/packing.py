"""Packing tokenized documents into fixed windows by Karmarkar-Karp multiway
differencing.

A document is its token ids and an end id.  It is cut into whole windows and a
remainder, the remainder into pieces of at most a quarter window.  Pieces are
dealt by hash to batches of a known size; in each batch the largest differencing
method builds m near-equal windows: it starts with one partial partition per
piece, and merges the two most unbalanced ones, the fullest bins of one onto the
emptiest of the other, until one partition is left.  m begins at the least
number that could hold the batch and rises while the fullest bin is over
capacity.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, materialize

WINDOW, END_ID = 4096, 2           # fixed by the contract
PARTS = 4                          # pieces of a remainder: at most WINDOW / PARTS ids
BATCH_PIECES = 2048
CACHE_WORDS = 1_000_000              # words whose ids a worker remembers
NARROW_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"

# The white-space-free words of these two settings can be encoded one by one.
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"}]}
_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
# Printable ASCII and the letters of Latin-1: composed already, lower-cased one by
# one, and split by the same expression without its Unicode classes.
_PLAIN = re.compile("[!-~\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
_PLAIN_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]"
                           "|[^\\sa-z0-9\xdf-\xf6\xf8-\xff]+")
# Byte-level tokenizers write a byte as the character of that number where it is a
# printable one, the others as 256 and up, in order.
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
_BYTE = {b: chr(b) for b in _SHOWN} | {
    b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in _SHOWN)}
_ODD_SPACE = re.compile("[\x1c-\x1f]")      # separators for Python, none for the tokenizer


class Encoder:
    """Little-endian uint32 ids of a text, by the tokenizer's own model.

    A tokenizer that drops white space treats every word alike wherever it
    stands, so its ids are computed once and remembered.  With any other
    settings the tokenizer encodes whole texts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        pre = conf["pre_tokenizer"] or {}
        splits = pre.get("pretokenizers", [{}])
        self.by_word = (conf["normalizer"] == _NORMALIZER
                        and splits[0].get("pattern") == {"Regex": _SPLIT}
                        and splits[0].get("behavior") == "Removed"
                        and [s.get("type") for s in splits] == ["Split", "ByteLevel"]
                        and not splits[-1].get("add_prefix_space"))
        # the strings of added tokens are ids of their own, wherever they stand
        added = conf.get("added_tokens", [])
        self.added = [t["content"] for t in added]
        # one that is looked for in normalised text may stand there in another form
        self.by_word = self.by_word and not any(t["normalized"] for t in added)
        self.known = _Known(self._learn)         # by word
        self.pieces: dict[str, bytes] = {}       # by what the model encodes

    def _whole(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def _modelled(self, piece: str) -> bytes:
        shown = piece if piece.isascii() else "".join(map(_BYTE.__getitem__, piece.encode()))
        ids = array("I", [t.id for t in self.model.tokenize(shown)])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = self.pieces[piece] = self._modelled(piece)
        return ids

    def _learn(self, word: str) -> bytes:
        """The ids of a word met for the first time."""
        low = word.lower()
        if word.isascii():
            # letters alone are one piece, remembered as the word they are
            if low.isalpha():
                return self._modelled(low) if low == word else self.known[low]
            if low[:-1].isalpha() and "!" <= low[-1] <= "~":
                return self.known[low[:-1]] + self._piece(low[-1])
        if _PLAIN.fullmatch(word):
            return b"".join(map(self._piece, _PLAIN_PIECES.findall(low)))
        return self._whole([word])[0]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for text in texts:
            if not self.by_word or _ODD_SPACE.search(text) or any(t in text for t in self.added):
                yield self._whole([text])[0]
                continue
            if len(self.known) > CACHE_WORDS:
                self.known.clear()
                self.pieces.clear()
            yield b"".join(map(self.known.__getitem__, text.split()))


class _Known(dict):
    """Ids by word; a new word is learnt when it is asked for."""

    def __init__(self, learn):
        super().__init__()
        self.learn = learn

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = self.learn(word)
        return ids


def encoder_of(path: str) -> Encoder:
    """The worker's one encoder of a tokenizer.  It is kept on the tokenizers
    module, which outlives a task: a tokenizer loaded anew by every task does
    not give all its memory back."""
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_encoders_by_path", {})
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def cuts(n: int, window: int = WINDOW, parts: int = PARTS) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids."""
    out = [(s, window) for s in range(0, n - window + 1, window)]
    rest = n % window
    k = -(-rest * parts // window)
    at = n - rest
    for i in range(k):
        size = rest // k + (i < rest % k)
        out.append((at, size))
        at += size
    return out


def _pieces(path: str, window: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            doc, start, length, crc, total, ids_col = [], [], [], [], [], []
            texts = batch.column("text").to_pylist()
            for d, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts)):
                ids = memoryview(ids + end)
                n = len(ids) // 4
                for s, k in cuts(n, window):
                    part = ids[4 * s:4 * (s + k)]
                    doc.append(d)
                    start.append(s)
                    length.append(k)
                    crc.append(zlib.crc32(part))
                    total.append(n)
                    if with_ids:
                        ids_col.append(np.frombuffer(part, "<u4").astype(np.int32))
            cols = [pa.array(c, pa.int64()) for c in (doc, start, length, crc, total)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                cols.append(pa.array(ids_col, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def differencing(sizes: np.ndarray, m: int) -> tuple[np.ndarray, int]:
    """(bin of each size, fullest bin) by largest differencing into ``m`` bins."""
    n = len(sizes)
    if m == 1:
        return np.zeros(n, np.int64), int(sizes.sum())
    # a partition: sums in falling order and, per bin, the root of a tree of sizes
    child = np.full((n * 2 + n * m, 2), -1, np.int64)
    used = n
    heap = []
    for i, s in enumerate(sizes.tolist()):
        heap.append((-s, i, np.array([s], np.int64), np.array([i], np.int64)))
    heapq.heapify(heap)
    tick = n
    while len(heap) > 1:
        _, _, sa, ra = heapq.heappop(heap)
        _, _, sb, rb = heapq.heappop(heap)
        if len(sa) < len(sb):
            sa, ra, sb, rb = sb, rb, sa, ra
        # bins that a partition does not name are empty
        clash = max(0, len(sa) + len(sb) - m)
        k = len(sb) - clash               # of b's bins, the first k go to empty bins of a
        sums = np.concatenate([sa, sb[:k]])
        roots = np.concatenate([ra, rb[:k]])
        if clash:
            # b's emptier bins onto a's fuller ones, in opposite order
            at = np.arange(len(sa) - 1, len(sa) - 1 - clash, -1)
            sums[at] += sb[k:]
            new = np.arange(used, used + clash)
            child[new, 0], child[new, 1] = ra[at], rb[k:]
            roots[at] = new
            used += clash
        order = np.argsort(-sums, kind="stable")
        sums, roots = sums[order], roots[order]
        spread = sums[0] - (sums[-1] if len(sums) == m else 0)
        heapq.heappush(heap, (-int(spread), tick, sums, roots))
        tick += 1
    _, _, sums, roots = heap[0]
    bins = np.empty(n, np.int64)
    for b, root in enumerate(roots.tolist()):
        stack = [root]
        while stack:
            x = stack.pop()
            if x < n:
                bins[x] = b
            else:
                stack.extend(child[x].tolist())
    return bins, int(sums[0])


def pack_sizes(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each size, no bin over ``capacity``; near-equal bins."""
    m = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        bins, fullest = differencing(sizes, m)
        if fullest <= capacity:
            return bins
        m += 1


def _pack(window: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start"], ascending=[False, True, True],
                              kind="stable").reset_index(drop=True)
        bins = pack_sizes(pdf["length"].to_numpy(np.int64), window)
        pdf["sequence_id"] = (pdf["batch"].to_numpy(np.int64) * (1 << 24) + bins) * 2
        pdf["offset"] = pdf.groupby("sequence_id")["length"].cumsum() - pdf["length"]
        return pdf.drop(columns="batch")
    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, window: int = WINDOW,
                   end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: (doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset), with ``with_ids`` also ``ids``.

    A null text is empty (its only id is the end id); rows without doc_id and
    repeated rows are packed like any other; an empty table gives no rows;
    other columns are ignored.  Sequence ids are distinct, not gapless.
    """
    schema = NARROW_SCHEMA + (", ids array<int>" if with_ids else "")
    pieces = materialize(id_and_text(docs).mapInArrow(
        _pieces(tokenizer_path, window, end_id, with_ids), schema), "pieces")
    whole = pieces.filter(F.col("length") == window).select(
        "*", (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    rest = pieces.filter(F.col("length") < window)
    batches = max(1, -(-rest.count() // BATCH_PIECES))
    keys = ["doc_id", "start", "ids_crc32"]
    rest = rest.withColumn("batch", F.pmod(F.xxhash64(*keys), F.lit(batches)).cast("long"))
    packed = rest.groupBy("batch").applyInPandas(
        _pack(window), schema + ", sequence_id long, offset long")
    return whole.union(packed.select(whole.columns))


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): the windows themselves, from pieces with ids."""
    return pieces.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))),
                              lambda x: x["ids"])).alias("ids"))
