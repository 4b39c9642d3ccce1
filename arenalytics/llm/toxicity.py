"""Toxicity by a classifier chain.

Categories are predicted one after another; every linear model sees the hashed
features of the text and the predicted log-odds of all earlier categories.  For
training, those earlier predictions are out-of-fold: the sample is cut into
folds, and a document's prediction comes from the model fitted without its
fold, so later models see them as wrong as they will be on new documents.

Features are the distinct loose words of a text and their first four and five
bytes, hashed.  The models are fitted on a bounded sample of labelled documents
by Spark tasks, one per fold and category; every document is then scored in one
pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_rows, id_and_text, materialize
from .wordhash import slices, texts_of, word_bounds, word_hashes

# Category and the label that means yes; the last one is the verdict.
CATEGORIES = (("low_quality", "quality = 0"), ("toxic", "toxic = 1"))
DIMENSIONS = 1 << 18
FOLDS = 3
SAMPLE_DOCS = 20_000             # labelled documents the models are fitted on
PREFIXES = (4, 5)
LEAST_CHI2 = 15.0
EPOCHS, BATCH, RATE, PENALTY = 12, 128, 0.3, 1e-6
THRESHOLD = 0.5

Key = tuple[pa.Scalar, ...]


def _features(texts: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(index of the first text, distinct feature numbers per text), by slices."""
    data, off = texts_of(pc.utf8_lower(texts))
    for i, j in slices(off):
        b, o = data[off[i]:off[j]], off[i:j + 1] - off[i]
        starts, ends, woff = word_bounds(b, o, loose=True)
        kinds = [word_hashes(b, starts, ends)]
        for k in PREFIXES:
            kinds.append(word_hashes(b, starts, np.minimum(starts + k, ends)) * np.uint64(2 * k + 1))
        f = np.stack([(h >> np.uint64(64 - DIMENSIONS.bit_length() + 1)).astype(np.int32)
                      for h in kinds], axis=1)
        yield i, [np.unique(f[a:z]) for a, z in zip(woff[:-1], woff[1:])]


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = [c for c in batch.schema.names if c != "text"]
        for i, sets in _features(batch.column("text")):
            yield pa.RecordBatch.from_arrays(
                [batch.column(c).slice(i, len(sets)) for c in kept]
                + [pa.array(sets, pa.list_(pa.int32()))], names=[*kept, "features"])


def _sets(column: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    """The rows of a list column as arrays."""
    a = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(a, pa.ChunkedArray):
        a = a.chunk(0) if a.num_chunks else pa.array([], column.type)
    return np.split(a.flatten().to_numpy(), np.cumsum(a.value_lengths().to_numpy())[:-1]) if len(a) else []


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _rows_of(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, row numbers) laid end to end."""
    n = np.array([len(s) for s in sets])
    return (np.concatenate(sets) if len(sets) else np.empty(0, np.int32)), np.repeat(np.arange(len(n)), n)


def telling(idx: np.ndarray, row: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether a feature goes with the label: chi-square of its documents
    against the label of at least LEAST_CHI2."""
    n, n1 = len(y), y.sum()
    has = np.bincount(idx, minlength=DIMENSIONS).astype(float)
    has1 = np.bincount(idx, y[row], DIMENSIONS)
    expected = has * n1 / n
    spread = expected * (1 - n1 / n) * (1 - has / n)
    return (has1 - expected) ** 2 >= LEAST_CHI2 * np.maximum(spread, 1e-9)


def fit_linear(sets: list[np.ndarray], dense: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression on the telling features by AdaGrad over a fixed
    order of small batches; (DIMENSIONS + dense columns + 1) weights, the last
    is the constant."""
    keep = telling(*_rows_of(sets), y)
    sets = [s[keep[s]] for s in sets]
    size = DIMENSIONS + dense.shape[1] + 1
    w, g2 = np.zeros(size), np.full(size, 1e-8)
    order = np.random.RandomState(11)
    for _ in range(EPOCHS):
        for at in np.array_split(order.permutation(len(y)), max(1, len(y) // BATCH)):
            idx, row = _rows_of([sets[k] for k in at])
            z = np.bincount(row, w[idx], len(at)) + dense[at] @ w[DIMENSIONS:-1] + w[-1]
            err = (_sigmoid(z) - y[at]) / len(at)
            used = np.unique(idx)
            g = np.bincount(idx, err[row], DIMENSIONS)[used] + PENALTY * w[used]
            tail = np.r_[err @ dense[at], err.sum()]
            g2[used] += g * g
            g2[DIMENSIONS:] += tail * tail
            w[used] -= RATE * g / np.sqrt(g2[used])
            w[DIMENSIONS:] -= RATE * tail / np.sqrt(g2[DIMENSIONS:])
    return w


def _odds(sets: list[np.ndarray], dense: np.ndarray, w: np.ndarray) -> np.ndarray:
    idx, row = _rows_of(sets)
    z = np.bincount(row, w[idx], len(sets)) + dense @ w[DIMENSIONS:-1] + w[-1]
    return np.clip(z, -30, 30)


def _train(step: int):
    """One model: the sample without fold ``model`` (all of it for -1)."""
    def run(key: Key, table: pa.Table) -> pa.Table:
        rows = table.sort_by("doc_id")
        sets = _sets(rows.column("features"))
        y = np.stack(_sets(rows.column("y")))
        odds = np.stack(_sets(rows.column("odds")))
        w = fit_linear(sets, odds[:, :step], y[:, step])
        return pa.table({"model": pa.array([key[0].as_py()], pa.int32()),
                         "weights": pa.array([w.astype(np.float32).tobytes()], pa.binary())})
    return run


def _predict_out_of_fold(models: dict[int, np.ndarray], step: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = _sets(batch.column("features"))
            odds = np.stack(_sets(batch.column("odds"))) if sets else np.empty((0, step))
            fold = batch.column("fold").to_numpy()
            out = np.zeros(len(sets))
            for k, w in models.items():
                at = np.flatnonzero(fold == k)
                if len(at):
                    out[at] = _odds([sets[i] for i in at], odds[at, :step], w)
            cols = {n: batch.column(n) for n in batch.schema.names}
            cols["odds"] = pa.array(list(np.c_[odds[:, :step], out]), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_pydict(cols)
    return run


def fit_chain(docs: DataFrame, labels: DataFrame, categories=CATEGORIES,
              sample_docs: int = SAMPLE_DOCS) -> list[np.ndarray]:
    """Final weights per category, in order; none without labelled documents.

    Of the labelled documents the ``sample_docs`` with the smallest hash of
    their id are used; a null label means no, and of several labels of one
    document any yes counts."""
    spark = docs.sparkSession
    yes = [F.max(F.coalesce(F.expr(rule), F.lit(False)).cast("double")).alias(f"y{k}")
           for k, (_, rule) in enumerate(categories)]
    ids = materialize(bounded_rows(
        labels.withColumn("doc_id", F.col("doc_id").cast("long")).filter("doc_id is not null")
        .groupBy("doc_id").agg(*yes), sample_docs), "chain-labels")
    sample = (id_and_text(docs).join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"])
              .select("doc_id", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(FOLDS)).cast("int").alias("fold"),
                      F.array(*[f"y{k}" for k in range(len(categories))]).alias("y"),
                      F.array().cast("array<double>").alias("odds"), "text"))
    schema = "doc_id long, fold int, y array<double>, odds array<double>, features array<int>"
    sample = materialize(sample.mapInArrow(_feature_rows, schema), "chain-sample")
    if sample.isEmpty():
        return []
    final = []
    for step in range(len(categories)):
        models = sample.withColumn("model", F.explode(F.array(
            *[F.lit(k) for k in (-1, *range(FOLDS))]))).filter("model != fold")
        fitted = models.groupBy("model").applyInArrow(_train(step), "model int, weights binary").collect()
        weights = {r["model"]: np.frombuffer(r["weights"], np.float32).astype(float) for r in fitted}
        final.append(weights.pop(-1))
        if step + 1 < len(categories):
            folds = spark.sparkContext.broadcast(weights)

            def run(batches: Iterator[pa.RecordBatch], step=step, folds=folds) -> Iterator[pa.RecordBatch]:
                return _predict_out_of_fold(folds.value, step)(batches)

            sample = materialize(sample.mapInArrow(run, schema), "chain-sample")
    return final


def classify(docs: DataFrame, labels: DataFrame, categories=CATEGORIES,
             threshold: float = THRESHOLD, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """One row per document: (doc_id, p_<category> each, and the last
    category's verdict as a boolean under its name).

    A null text has no features; without labelled documents every probability
    is 0; repeated rows and rows without doc_id are judged like any other; an
    empty table gives no rows; other columns are ignored.
    """
    names = [name for name, _ in categories]
    chain = docs.sparkSession.sparkContext.broadcast(fit_chain(docs, labels, categories, sample_docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, sets in _features(batch.column("text")):
                odds = np.empty((len(sets), 0))
                for w in chain.value:
                    odds = np.c_[odds, _odds(sets, odds, w)]
                p = _sigmoid(odds) if odds.shape[1] else np.zeros((len(sets), len(names)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, len(sets)), *[pa.array(c) for c in p.T],
                     pa.array(p[:, -1] >= threshold)],
                    names=["doc_id", *[f"p_{n}" for n in names], names[-1]])

    schema = ", ".join(["doc_id long", *[f"p_{n} double" for n in names], f"{names[-1]} boolean"])
    return id_and_text(docs).mapInArrow(run, schema)
