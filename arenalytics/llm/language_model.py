"""Language-model scores by deleted interpolation.

p(w | v) = l2(b) c(v w) / c(v) + l1(b) c(w) / N + l0(b) / (V + 1), where b is
the bucket of the context's frequency c(v) (its number of binary digits).  The
weights of every bucket come from expectation maximisation on deleted counts:
one fold of the training documents is left out of the counts and its n-grams
are explained by the rest.

Counting all n-grams of a corpus as rows would shuffle several times the text.
Instead documents are dealt by hash to chunks of a few MB; a chunk sends each
of its distinct n-grams once (64-bit hash and count, packed per key range), a
key range adds up the counts of all chunks and sends them back in the order of
the chunk's own keys, so no hash travels twice.  A frequent word costs a chunk
one entry, so no key is hot.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import (
    CHUNK_BYTES, Key, in_chunks, range_bits, range_edges, rows_table, squeeze, squeeze_sorted,
    unsqueeze, unsqueeze_sorted, unzipped)
from .common import materialize, text_bytes
from .wordhash import mix, slices, word_bounds, word_hashes

FOLDS, HELD_OUT = 5, 1            # fixed by the contract
EM_FOLD = 0                       # training fold whose counts are deleted for EM
END, START = np.uint64(0x5851F42D4C957F2C), np.uint64(0x14057B7EF767814E)
CLASSES = 24                      # context-frequency buckets
LEVELS = 48                       # half-octave steps of a probability in the EM table
EM_ROUNDS = 60

SENT = "part int, chunk long, keys binary, counts binary"
SENT_ROWS = pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("keys", pa.binary()),
                       ("counts", pa.binary())])
RETURNED = ("part int, chunk long, counts binary, kept binary, tokens long, types long, "
            "kept_tokens long")
SCORED = ("doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, "
          "score double")


class _Chunk:
    """The tokens of a chunk's documents, laid end to end in document order."""

    def __init__(self, table: pa.Table):
        self.ids = table.column("doc_id")
        data, off = unzipped(table)
        tokens, lengths = [], []
        for i, j in slices(off):
            b, o = data[off[i]:off[j]], off[i:j + 1] - off[i]
            starts, ends, woff = word_bounds(b, o)
            n = np.diff(woff)
            t = np.full(len(starts) + len(n), END, np.uint64)
            # every document's words, then its end
            t[np.arange(len(starts)) + np.repeat(np.arange(len(n)), n)] = word_hashes(b, starts, ends)
            tokens.append(t)
            lengths.append(n + 1)
        self.lengths = np.concatenate(lengths) if lengths else np.empty(0, np.int64)
        t = np.concatenate(tokens) if tokens else np.empty(0, np.uint64)
        even = ~np.uint64(1)
        self.first = np.cumsum(self.lengths) - self.lengths
        before = np.r_[START, t[:-1]] if len(t) else t
        before[self.first] = START
        # unigram keys are even, bigram keys odd
        token = t & even
        pair = mix(before * np.uint64(0xD6E8FEB86659FD93) + t) | np.uint64(1)
        self.keys, place, counts = np.unique(np.concatenate([token, pair]), return_inverse=True,
                                             return_counts=True)
        self.counts = counts
        self.token, self.pair = place[:len(t)], place[len(t):]
        # a context's count is that of its token; before the first stands START,
        # which occurs as often as END
        self.context = np.r_[0, self.token[:-1]] if len(t) else self.token
        end = np.searchsorted(self.keys, END & even)
        self.context[self.first] = end


def _send(bits: int):
    def run(key: Key, table: pa.Table) -> pa.Table:
        chunk = _Chunk(table)
        return rows_table([(p, key[0].as_py(), squeeze_sorted(chunk.keys[a:z]),
                            squeeze(chunk.counts[a:z]))
                           for p, a, z in range_edges(chunk.keys, bits)], SENT_ROWS)
    return run


def _add_up(key: Key, table: pa.Table) -> pa.Table:
    """All counts of one key range, handed back chunk by chunk; and its totals
    (chunk null)."""
    chunks = table.column("chunk").to_numpy()
    keys = [unsqueeze_sorted(b.as_py()) for b in table.column("keys")]
    counts = [unsqueeze(b.as_py()).astype(np.int64) for b in table.column("counts")]
    fold = chunks % FOLDS
    every, place = np.unique(np.concatenate(keys), return_inverse=True)
    at = np.cumsum([0, *map(len, keys)])
    total, kept = np.zeros(len(every), np.int64), np.zeros(len(every), np.int64)
    for i, c in enumerate(counts):
        if fold[i] != HELD_OUT:
            total[place[at[i]:at[i + 1]]] += c
            if fold[i] != EM_FOLD:
                kept[place[at[i]:at[i + 1]]] += c
    rows = []
    for i, c in enumerate(chunks.tolist()):
        own = place[at[i]:at[i + 1]]
        rows.append((c, squeeze(total[own]), squeeze(kept[own]) if fold[i] == EM_FOLD else None,
                     0, 0, 0))
    word = (every & np.uint64(1)) == 0
    rows.append((None, None, None, int(total[word].sum()), int(np.count_nonzero(total[word])),
                 int(kept[word].sum())))
    c = list(zip(*rows))
    return pa.table({
        "part": pa.array([key[0].as_py()] * len(rows), pa.int32()), "chunk": pa.array(c[0], pa.int64()),
        "counts": pa.array(c[1], pa.binary()), "kept": pa.array(c[2], pa.binary()),
        "tokens": pa.array(c[3], pa.int64()), "types": pa.array(c[4], pa.int64()),
        "kept_tokens": pa.array(c[5], pa.int64())})


def _returned(counts: pa.Table, column: str) -> np.ndarray:
    """A chunk's counts in the order of its keys."""
    parts = sorted(zip(counts.column("part").to_pylist(), counts.column(column).to_pylist()))
    return np.concatenate([unsqueeze(b) for _, b in parts]).astype(np.float64) if parts \
        else np.empty(0)


def context_class(c: np.ndarray) -> np.ndarray:
    """Bucket of a context frequency: 0 for none, else its binary digits."""
    return np.minimum(np.frexp(c)[1], CLASSES - 1)


def _level(f: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore"):
        return np.where(f > 0, 1 + np.minimum(-2 * np.log2(np.where(f > 0, f, 1)), LEVELS - 2),
                        0).astype(np.int64)


def _components(chunk: _Chunk, c: np.ndarray, tokens: float):
    context = c[chunk.context]
    f2 = np.where(context > 0, c[chunk.pair] / np.maximum(context, 1), 0.0)
    f1 = c[chunk.token] / max(tokens, 1)
    return context_class(context), f2, f1


def _deleted(kept_tokens: int):
    """EM table of a chunk of the deleted fold: cells of context class and
    levels of both estimates, with their number and sums."""
    def run(key: Key, docs: pa.Table, counts: pa.Table) -> pa.Table:
        chunk = _Chunk(docs)
        cls, f2, f1 = _components(chunk, _returned(counts, "kept"), kept_tokens)
        cell, place = np.unique((cls * LEVELS + _level(f2)) * LEVELS + _level(f1),
                                return_inverse=True)
        return pa.table({"cell": pa.array(cell.astype(np.int64)),
                         "n": pa.array(np.bincount(place, minlength=len(cell)).astype(np.float64)),
                         "f2": pa.array(np.bincount(place, f2, len(cell))),
                         "f1": pa.array(np.bincount(place, f1, len(cell)))})
    return run


def fit_weights(cells: list[tuple[int, float, float, float]], types: int) -> np.ndarray:
    """(CLASSES, 3) weights of (uniform, unigram, bigram), each row adding up
    to 1, by expectation maximisation over the table's cells."""
    weights = np.tile([0.1, 0.4, 0.5], (CLASSES, 1))
    weights[0] = [0.2, 0.8, 0.0]                        # an unseen context has no bigrams
    if cells:
        cell, n, f2, f1 = (np.array(x) for x in zip(*cells))
        cls = cell // (LEVELS * LEVELS)
        f = np.stack([np.full(len(n), 1.0 / (types + 1)), f1 / n, f2 / n], axis=1)
        seen = np.bincount(cls, n, CLASSES)
        for _ in range(EM_ROUNDS):
            share = weights[cls] * f
            share /= share.sum(axis=1, keepdims=True)
            for k in range(3):
                # one token's worth of the start values keeps every weight defined
                weights[:, k] = (np.bincount(cls, share[:, k] * n, CLASSES)
                                 + [0.2, 0.4, 0.4][k]) / (seen + 1)
    weights[0] = [weights[0, 0], weights[0, 1] + weights[0, 2], 0.0]
    return weights


def _score(tokens: int, types: int, weights: np.ndarray):
    def run(key: Key, docs: pa.Table, counts: pa.Table) -> pa.Table:
        chunk = _Chunk(docs)
        n = len(chunk.lengths)
        c = _returned(counts, "counts")
        cls, f2, f1 = _components(chunk, c, tokens)
        w = weights[cls]
        p = w[:, 0] / (types + 1) + w[:, 1] * f1 + w[:, 2] * f2
        own = c[chunk.token]
        base = np.log10((own + 0.5) / (tokens + 0.5 * (types + 1)))
        doc = np.repeat(np.arange(n), chunk.lengths)
        return pa.table({
            "doc_id": chunk.ids, "held_out": pa.array([key[0].as_py() % FOLDS == HELD_OUT] * n, pa.bool_()),
            "n_tokens": pa.array(chunk.lengths.astype(np.int64)),
            "n_known": pa.array(np.bincount(doc, own > 0, n).astype(np.int64)),
            "base_score": pa.array(np.bincount(doc, base, n)),
            "score": pa.array(np.bincount(doc, np.log10(p), n))})
    return run


def score_documents(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: (doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score), learnt from the documents not held out.

    A null text is empty (one token, its end); rows without doc_id take the
    remainder of the empty string's checksum; repeated rows count as often as
    they stand there; an empty table gives no rows; other columns are ignored.
    """
    size = text_bytes(docs)
    n = max(1, -(-size // (FOLDS * chunk_bytes)))
    bits = range_bits(n * FOLDS)
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS
    # the rest of a chunk's number, divided by FOLDS, is its fold
    chunk = F.pmod(F.xxhash64("doc_id"), F.lit(n)) * FOLDS + fold
    d = in_chunks(docs, chunk)

    sent = d.groupBy("chunk").applyInArrow(_send(bits), SENT)
    counts = materialize(sent.groupBy("part").applyInArrow(_add_up, RETURNED), "ngram-counts")
    t = counts.filter("chunk is null").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "types", "kept_tokens")]).first()
    counts = counts.filter("chunk is not null")

    em = F.col("chunk") % FOLDS == EM_FOLD
    table = (in_chunks(docs.filter(fold == EM_FOLD), chunk).groupBy("chunk")
             .cogroup(counts.filter(em).select("chunk", "part", "kept").groupBy("chunk"))
             .applyInArrow(_deleted(t["kept_tokens"]), "cell long, n double, f2 double, f1 double")
             .groupBy("cell").agg(F.sum("n").alias("n"), F.sum("f2").alias("f2"), F.sum("f1").alias("f1")))
    weights = fit_weights([tuple(r) for r in table.orderBy("cell").collect()], t["types"])

    scored = (d.groupBy("chunk")
              .cogroup(counts.select("chunk", "part", "counts").groupBy("chunk"))
              .applyInArrow(_score(t["tokens"], t["types"], weights), SCORED))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known",
                         F.lit(t["tokens"]).cast("long").alias("train_tokens"), "base_score", "score")
