"""Quality rules (DataFrame functions only): counts per document, two base
rules, and a hashed n-gram log-likelihood ratio.

The ratio compares two multinomials over hashed word n-grams (n = 1, 2): a
trusted target (a bounded sample of documents labelled good) and the raw corpus
(every document).  A document's score is the mean log ratio of its n-grams, so
it does not depend on the length.  Every document is held against one
threshold: a fixed low quantile of the scores that all trusted documents, not
only the sample, get from the ratio fitted without their half of the sample.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import (
    bounded_rows, doubles_literal, id_and_text, let, materialize, spare_name, text_or_empty, words_of)

SYMBOLS = "#*$%&|<>"                 # fixed by the contract
WHITE = " \t\n\x0b\f\r"
MIN_WORDS, MAX_REPEAT = 50, 50       # fixed by the contract (words; percent)
BUCKETS = 1 << 14
TRUSTED_DOCS = 20_000                # bound of the labelled sample the target is counted on
TRUSTED_LOSS = 0.02                  # share of all trusted documents that may lie below the threshold
SCORE_STEPS = 1024                   # the threshold is a multiple of 1 / SCORE_STEPS


def _without(text: Column, chars: str) -> Column:
    return F.translate(text, chars, "")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda x: F.length(_without(x, WHITE)) > 0)
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")


def repeated_words(words: Column) -> Column:
    """Words in 3-word windows that occur twice or more in the text, the first
    occurrence included.  Windows are compared by a 64-bit hash."""

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3),
                           lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))

    def covered(h: Column) -> Column:
        """``h``: the hashes of all windows in order."""
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            def position(x: Column, k: Column) -> Column:
                before = F.try_element_at(s, k)["h"]            # 1-based: the entry before
                after = F.try_element_at(s, k + 2)["h"]
                same = ((k > 0) & (before == x["h"])) | F.coalesce(after == x["h"], F.lit(False))
                return F.when(same, x["i"])
            return F.sort_array(F.filter(F.transform(s, position), lambda x: x.isNotNull()))

        def length(at: Column) -> Column:
            step = F.aggregate(
                at, F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
                lambda acc, i: F.struct(i.alias("last"),
                                        (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")))
            return step["n"]

        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)) \
                .otherwise(let(let(pairs, twice), length))

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(
        let(let(words, windows), covered)).cast("long")


def _bucket(*words: Column) -> Column:
    return F.pmod(F.xxhash64(*words), F.lit(BUCKETS)).cast("int")


def bucket_counts(grams: DataFrame, folds: DataFrame) -> list[tuple[int, int, int]]:
    """Per bucket: n-grams in all documents (``grams``: doc_id, buckets), and in
    the two halves of the trusted sample (``folds``: doc_id, fold; at most
    TRUSTED_DOCS rows).  Only the BUCKETS totals reach the driver."""
    rows = (grams.join(F.broadcast(folds), "doc_id", "left")
            .select("fold", F.explode("buckets").alias("k")).groupBy("k").agg(
                F.count(F.lit(1)).alias("raw"), F.count_if(F.col("fold") == 0).alias("f0"),
                F.count_if(F.col("fold") == 1).alias("f1")).collect())
    out = [(0, 0, 0)] * BUCKETS
    for r in rows:
        out[r["k"]] = (r["raw"], r["f0"], r["f1"])
    return out


def log_ratios(target: list[int], raw: list[int]) -> list[float]:
    """Log of target over raw probability per bucket, both with one count
    added to every bucket."""
    t, r = sum(target) + BUCKETS, sum(raw) + BUCKETS
    return [math.log((x + 1) / t) - math.log((y + 1) / r) for x, y in zip(target, raw)]


def gram_buckets(words: Column) -> Column:
    """The buckets of all n-grams of a document, hashed once."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.concat(F.transform(words, lambda a: _bucket(a)),
                    F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n),
                               lambda a, b: _bucket(a, b)))


def mean_ratio(buckets: Column, ratios: list[float]) -> Column:
    """Mean log ratio of a document's n-grams (0 without any)."""
    table = doubles_literal(ratios)
    return F.when(F.size(buckets) > 0, F.aggregate(
        buckets, F.lit(0.0), lambda acc, k: acc + table[k]) / F.size(buckets)).otherwise(F.lit(0.0))


def _base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT * n_words)


def _judged(text: Column) -> Column:
    """All that a text gives, from one split into words."""
    def of(words: Column) -> Column:
        n = F.size(words).cast("long")

        def fields(repeat: Column) -> Column:
            return F.struct(
                n.alias("n_words"), F.length(_without(text, WHITE)).cast("long").alias("word_chars"),
                (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long").alias("n_symbols"),
                duplicate_lines(text).alias("n_dup_lines"), repeat.alias("n_repeat_words"),
                _base_failed(n, repeat).alias("base_failed"), gram_buckets(words).alias("buckets"))
        return let(repeated_words(words), fields)
    return let(words_of(text), of)


def _fold() -> Column:
    return F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit(7)), F.lit(2)).cast("int")


def low_quantile(scores: DataFrame, share: float = TRUSTED_LOSS) -> float:
    """The largest multiple of 1 / SCORE_STEPS with at most ``share`` of the
    scores (column ``score``) in the steps below it; 0 without scores.  Only
    the counts per step reach the driver; a mean log ratio spans some ten
    thousand steps at most."""
    steps = sorted((r["step"], r["n"]) for r in scores.groupBy(
        F.floor(F.col("score") * SCORE_STEPS).alias("step")).agg(F.count(F.lit(1)).alias("n")).collect())
    allowed, below = share * sum(n for _, n in steps), 0
    for step, n in steps:
        below += n
        if below > allowed:
            return step / SCORE_STEPS
    return 0.0


def held_ratio(buckets: Column, without: list[list[float]]) -> Column:
    """Mean ratio by the one in ``without`` that the document's half of the
    sample is left out of.  A document outside the sample is in neither; its
    half is taken alike."""
    return F.when(_fold() == 0, mean_ratio(buckets, without[0])).otherwise(mean_ratio(buckets, without[1]))


def threshold_of(held: DataFrame, trusted: DataFrame | None) -> float:
    """The threshold from (doc_id, score) rows of the documents that pass the
    base rules; 0 without trusted documents.  Only narrow rows are joined."""
    if trusted is None:
        return 0.0
    return low_quantile(held.join(trusted, "doc_id", "left_semi"))


def fit_ratios(grams: DataFrame, labels: DataFrame | None, trusted_docs: int = TRUSTED_DOCS):
    """(trusted ids, log ratio per bucket, the ratios without each half) from
    (doc_id, buckets).  ``labels`` (doc_id, quality): rows with quality 1 are
    trusted; the ratios are fitted on the ``trusted_docs`` of them with the
    smallest hash of their id.  Without any there are no trusted ids and every
    ratio is 0."""
    none = None, [0.0] * BUCKETS, [[0.0] * BUCKETS] * 2
    if labels is None:
        return none
    trusted = materialize(
        labels.filter("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id"))
        .filter("doc_id is not null").distinct(), "trusted")
    folds = materialize(bounded_rows(trusted, trusted_docs)
                        .select("doc_id", _fold().alias("fold")), "trusted-sample")
    counts = bucket_counts(grams, folds)
    raw = [c[0] for c in counts]
    if not sum(c[1] + c[2] for c in counts):
        return none
    return (trusted, log_ratios([c[1] + c[2] for c in counts], raw),
            [log_ratios([c[k] for c in counts], raw) for k in (2, 1)])


def judge_quality(docs: DataFrame, labels: DataFrame | None,
                  trusted_docs: int = TRUSTED_DOCS) -> DataFrame:
    """One row per document: the counts, base_failed, score, threshold, kept.

    The texts are read once; their counts and n-gram buckets are written, and
    the corpus totals and the scores come from those.  Without any trusted
    document every score is 0 and the base rules decide alone.  A null text is
    empty and fails the base rules; repeated rows are judged alike; an empty
    table gives no rows; other columns are ignored.
    """
    read = id_and_text(docs).withColumn("q", _judged(F.col("text"))).select("doc_id", "q.*")
    read = materialize(read, "quality-buckets")
    trusted, ratios, without = fit_ratios(read.select("doc_id", "buckets"), labels, trusted_docs)
    out = materialize(read.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        mean_ratio(F.col("buckets"), ratios).alias("score"),
        F.when(~F.col("base_failed"), held_ratio(F.col("buckets"), without)).alias("held")), "quality-scores")
    threshold = threshold_of(out.filter(~F.col("base_failed")).select(
        "doc_id", F.col("held").alias("score")), trusted)
    return out.drop("held").withColumn("threshold", F.lit(threshold)).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= threshold))


def keep_good(docs: DataFrame, labels: DataFrame | None,
              trusted_docs: int = TRUSTED_DOCS) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that judge_quality keeps."""
    q, s = spare_name(docs, "judged"), spare_name(docs, "scores")
    text = text_or_empty()

    def of(words: Column) -> Column:
        return F.struct(_base_failed(F.size(words), repeated_words(words)).alias("base_failed"),
                        gram_buckets(words).alias("buckets"))
    read = materialize(docs.withColumn(q, let(words_of(text), of)), "quality-buckets")
    doc_id = F.col("doc_id").cast("long").alias("doc_id")
    buckets = F.col(q)["buckets"]
    trusted, ratios, without = fit_ratios(read.select(doc_id, buckets.alias("buckets")), labels, trusted_docs)
    passed = read.filter(~F.col(q)["base_failed"])
    threshold = threshold_of(passed.select(doc_id, held_ratio(buckets, without).alias("score")),
                             trusted)
    return passed.withColumn(s, mean_ratio(buckets, ratios)).filter(F.col(s) >= threshold).drop(q, s)
