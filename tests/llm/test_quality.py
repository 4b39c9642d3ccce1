import re
from collections import Counter

from arenalytics.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    c = Counter(zip(w, w[1:], w[2:]))
    hit = {k + d for k in range(len(w) - 2) if c[tuple(w[k:k + 3])] > 1 for d in range(3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(t.count(x) for x in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w))


def test_counts_match_brute_force(edge_docs, labels):
    docs, rows = edge_docs
    text = dict(rows)
    out = quality.judge_quality(docs, labels).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                r.base_failed) == brute(text[r.doc_id]), r.doc_id
        assert r.kept == (not r.base_failed and r.score >= r.threshold)


def test_filter_keeps_the_same_documents(edge_docs, labels):
    docs, _ = edge_docs
    kept = sorted(r.doc_id for r in quality.judge_quality(docs, labels).filter("kept").collect())
    left = quality.keep_good(docs, labels)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == kept


def test_ratio_follows_its_definition(spark):
    import math
    target, raw = [0] * quality.BUCKETS, [0] * quality.BUCKETS
    target[3], raw[3], raw[5] = 4, 4, 9
    got = quality.log_ratios(target, raw)
    t, r = 4 + quality.BUCKETS, 13 + quality.BUCKETS
    assert math.isclose(got[3], math.log(5 / t) - math.log(5 / r))
    assert math.isclose(got[5], math.log(1 / t) - math.log(10 / r))


def test_junk_goes_and_clean_text_stays(spark):
    import random
    rnd = random.Random(1)
    clean = [f"w{k}" for k in range(400)]
    junk = [f"{x}$$" for x in clean]
    def text(words):
        return " ".join(rnd.choice(words) for _ in range(80))
    rows = [(i, text(clean)) for i in range(200)] + [(1000 + i, text(junk)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(0, 200, 2)] + [(1000, 0), (None, 1)],
                                   "doc_id long, quality int")
    kept = {r.doc_id for r in quality.judge_quality(docs, labels).filter("kept").collect()}
    assert not any(i >= 1000 for i in kept) and len(kept) >= 198


def test_without_trusted_documents_the_base_rules_decide(edge_docs, labels, empty_docs):
    docs, _ = edge_docs
    for none in (None, labels.filter("quality = 7")):
        out = quality.judge_quality(docs, none)
        assert out.filter("kept = base_failed").count() == 0
    assert quality.judge_quality(empty_docs, labels).count() == 0
    assert quality.keep_good(empty_docs, labels).count() == 0


def brute_fit(spark, docs, trusted):
    """({doc_id: score}, threshold) in plain Python; only the hashes are Spark's."""
    import math
    from pyspark.sql import functions as F
    words = {i: WORD.findall(t or "") for i, t in docs}
    grams = {i: [(a,) for a in w] + list(zip(w, w[1:])) for i, w in words.items()}
    pairs = sorted({g for gs in grams.values() for g in gs})
    rows = spark.createDataFrame([(g[0], g[1] if len(g) > 1 else None) for g in pairs], "a string, b string") \
        .select("a", "b", F.when(F.col("b").isNull(), F.xxhash64("a"))
                .otherwise(F.xxhash64("a", "b")).alias("h")).collect()
    bucket = {(r.a,) if r.b is None else (r.a, r.b): r.h % quality.BUCKETS for r in rows}
    fold = {r.i: r.h % 2 for r in spark.createDataFrame([(i,) for i in words], "i long")
            .select("i", F.xxhash64("i", F.lit(7)).alias("h")).collect()}

    def ratios(ids):
        target, raw = (Counter(bucket[g] for i in part for g in grams[i]) for part in (ids, words))
        t, r = (sum(c.values()) + quality.BUCKETS for c in (target, raw))
        return lambda k: math.log((target[k] + 1) / t) - math.log((raw[k] + 1) / r)

    def score(i, ratio):
        return sum(ratio(bucket[g]) for g in grams[i]) / len(grams[i]) if grams[i] else 0.0
    halves = [ratios([i for i in trusted if fold[i] != k]) for k in (0, 1)]
    held = sorted(math.floor(score(i, halves[fold[i]]) * quality.SCORE_STEPS)
                  for i in trusted if not brute(dict(docs)[i])[-1])
    threshold = held[int(quality.TRUSTED_LOSS * len(held))] / quality.SCORE_STEPS
    full = ratios(trusted)
    return {i: score(i, full) for i in words}, threshold


def noisy_corpus():
    import random
    rnd = random.Random(3)
    clean = [f"w{k}" for k in range(400)]
    def text(words):
        return " ".join(rnd.choice(words) for _ in range(80))
    rows = [(i, text(clean)) for i in range(400)]
    rows += [(1000 + i, text([f"{x}$$" for x in clean])) for i in range(30)]
    return rows, [*range(400), 1000, 1001, 1002]


def test_scores_and_verdicts_match_brute_force(spark):
    import math
    rows, trusted = noisy_corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in trusted], "doc_id long, quality int")
    score, threshold = brute_fit(spark, rows, trusted)
    for r in quality.judge_quality(docs, labels).collect():
        assert math.isclose(r.score, score[r.doc_id], abs_tol=1e-9) and r.threshold == threshold
        assert r.kept == (not brute(dict(rows)[r.doc_id])[-1] and score[r.doc_id] >= threshold)


def test_a_few_wrong_labels_do_not_let_the_junk_in(spark):
    rows, trusted = noisy_corpus()                     # three of 403 trusted ones are junk
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in trusted], "doc_id long, quality int")
    kept = {r.doc_id for r in quality.judge_quality(docs, labels).filter("kept").collect()}
    assert not any(i > 1002 for i in kept) and len(kept) >= 380


def test_the_threshold_covers_trusted_documents_outside_the_sample(spark):
    rows, trusted = noisy_corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in trusted], "doc_id long, quality int")
    seen = []
    whole = quality.low_quantile
    quality.low_quantile = lambda held: seen.append(held.count()) or whole(held)
    try:
        quality.judge_quality(docs, labels, trusted_docs=40)
    finally:
        quality.low_quantile = whole
    assert seen == [len(trusted)]
