import math
import re
import zlib
from collections import Counter

import numpy as np

from arenalytics.llm import language_model as lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")
END = ("end",)


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [END]


def fold(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5


def counted(rows, keep):
    one, two = Counter(), Counter()
    for i, t in rows:
        if keep(fold(i)):
            w = tokens(t)
            one.update(w)
            two.update(zip([None, *w], w))
    return one, two


def test_matches_brute_force(edge_docs):
    docs, rows = edge_docs
    one, two = counted(rows, lambda f: f != 1)
    some, some2 = counted(rows, lambda f: f not in (0, 1))
    n, v = sum(one.values()), len(one)

    def parts(w, one, two):
        n = sum(one.values())
        for a, b in zip([None, *w], w):
            c = one[END] if a is None else one[a]
            yield min(c.bit_length(), lm.CLASSES - 1), two[a, b] / c if c else 0.0, one[b] / n

    # EM on the deleted fold, token by token
    table = [x for i, t in rows if fold(i) == 0 for x in parts(tokens(t), some, some2)]
    cells = Counter()
    sums = {}
    for b, f2, f1 in table:
        cell = int((b * lm.LEVELS + lm._level(np.array([f2]))[0]) * lm.LEVELS + lm._level(np.array([f1]))[0])
        s = sums.setdefault(cell, [0.0, 0.0, 0.0])
        for k, x in enumerate((1.0, f2, f1)):
            s[k] += x
        cells[cell] += 1
    weights = lm.fit_weights([(c, *s) for c, s in sorted(sums.items())], v)
    assert np.allclose(weights.sum(axis=1), 1)

    out = lm.score_documents(docs, chunk_bytes=100_000).collect()
    assert len(out) == len(rows)
    text = dict(rows)
    for r in out:
        w = tokens(text[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            fold(r.doc_id) == 1, len(w), sum(one[x] > 0 for x in w), n)
        base = sum(math.log10((one[x] + .5) / (n + .5 * (v + 1))) for x in w)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        score = sum(math.log10(weights[b, 0] / (v + 1) + weights[b, 1] * f1 + weights[b, 2] * f2)
                    for b, f2, f1 in parts(w, one, two))
        assert math.isclose(r.score, score, rel_tol=1e-6)


def test_mixture_beats_unigrams_on_held_out_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    s = lm.score_documents(docs).filter("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert s.s > s.b


def test_em_finds_the_weights_of_a_mixture():
    rnd = np.random.RandomState(1)
    cls = 7
    f2, f1 = 2.0 ** -rnd.randint(1, 6, 4000), 2.0 ** -rnd.randint(6, 12, 4000)
    share = f2 / (f2 + f1)
    cells = {}
    for a, b, s in zip(f2, f1, share):
        cell = int((cls * lm.LEVELS + lm._level(np.array([a]))[0]) * lm.LEVELS + lm._level(np.array([b]))[0])
        c = cells.setdefault(cell, [0.0, 0.0, 0.0])
        for k, x in enumerate((1.0, a, b)):
            c[k] += x
    got = lm.fit_weights([(c, *x) for c, x in cells.items()], 10 ** 6)[cls]
    assert got[2] > 0.9 and math.isclose(got.sum(), 1)


def test_no_training_documents(spark, empty_docs):
    assert lm.score_documents(empty_docs).count() == 0
    i = next(i for i in range(100) if fold(i) == 1)
    r = lm.score_documents(spark.createDataFrame([(i, "a b")], "doc_id long, text string")).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (True, 3, 0, 0)
    assert r.base_score == 0 and r.score <= 0
