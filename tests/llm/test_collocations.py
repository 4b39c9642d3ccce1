import random
import re
from collections import Counter

import pytest

from arenalytics.llm import collocations

SCHEMA = "lang string, text string"
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, limit=2000):
    """Counts every phrase, then ranks: no bounds, no rounds."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    cand = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= 10}
    dropped = set()
    for (lang, p), c in cand.items():
        for q in ((p[:2], p[1:]) if len(p) == 3 else ()):
            if 100 * c >= 50 * f[lang, q]:
                dropped.add((lang, q))
    out = {}
    for (lang, p), a in cand.items():
        if (lang, p) not in dropped:
            cuts = [(1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out.setdefault(lang, []).append(
                (-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, rank, p.decode(), -a, left, right, n[lang], -s)
                  for lang, ps in out.items()
                  for rank, (s, a, p, left, right) in enumerate(sorted(ps)[:limit], 1))


def check(spark, rows, limit=2000):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in collocations.mine(docs, limit).collect())
    assert got == brute(rows, limit)
    return got


def corpus(seed=1):
    """Words of very unequal frequency, fixed phrases, copies and split pieces."""
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(150):
        text = []
        for _ in range(rnd.randrange(5, 60)):
            text.append(words[min(int(rnd.expovariate(0.12)), 59)])
            if rnd.random() < 0.2:
                text.append(rnd.choice(["New York City", "king of spain", "Straße über", "of the", "a, b", "x.\ny"]))
        rows.append((rnd.choice(["en", "en", "de", None, ""]), rnd.choice([" ", "\t", "  "]).join(text)))
    rows += [("en", "seldom seen phrase of many copies, word by word")] * 12
    return rows + [("en", None), ("fr", ""), ("fr", " ,.; "), ("en", "edge " * 3000), (None, "only once here")]


def test_matches_brute_force(spark):
    assert {r[0] for r in check(spark, corpus())} >= {"en", "de", "und", ""}


def test_rounds_lower_the_key_until_the_limit_is_settled(spark, monkeypatch):
    """The first round's best pairs are all covered by worse triples."""
    rounds = []
    real = collocations.best_keys
    monkeypatch.setattr(collocations, "best_keys", lambda c, w: rounds.append(w) or real(c, w))
    rows = [r for k in range(30) for r in [("en", f"alpha{k} beta{k} gamma{k}")] * 20
            + [("en", f"alpha{k}")] * k + [("en", f"gamma{k}")] * (29 - k)]
    check(spark, rows, limit=12)
    assert len(rounds) > 1


def test_small_limit_grows_part_of_the_frontier(spark, monkeypatch):
    grown = []
    real = collocations.triple_counts
    monkeypatch.setattr(collocations, "triple_counts", lambda d, p, g: grown.append(
        (p.count(), g.count())) or real(d, p, g))
    check(spark, corpus(3), limit=2)
    assert grown[0][1] < grown[0][0]


def test_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    assert sorted(tuple(r) for r in collocations.mine(docs).collect()) == brute(rows)


def test_empty_and_clashing_columns(spark):
    assert collocations.mine(spark.createDataFrame([], SCHEMA)).collect() == []
    wide = "lang string, text string, h long, a string, f string, n string, score string, rank string, word string"
    rows = corpus(4)
    docs = spark.createDataFrame([r + (1,) + ("?",) * 6 for r in rows], wide)
    assert sorted(tuple(r) for r in collocations.mine(docs).collect()) == brute(rows)


@pytest.mark.parametrize("a,left,right", [(10, 10, 10), (3 * 10 ** 9, 4 * 10 ** 9, 5 * 10 ** 9),
                                          (10 ** 15, 10 ** 15 + 7, 10 ** 15 + 9)])
def test_score_is_exact_past_64_bits(spark, a, left, right):
    df = spark.createDataFrame([(a, left, right)], "a long, l long, r long")
    assert df.select(collocations.score("a", "l", "r")).first()[0] == 1000000 * a * a // (left * right)


HELD_BYTES = """
import resource, numpy as np, pyarrow as pa
from arenalytics.llm import collocations as C
rng = np.random.default_rng(1)
words = np.array([f"w{i}" for i in range(30000)])
texts = [" ".join(words[rng.integers(0, 30000, 200)].tolist()) for _ in range(20000)]
batches = [pa.RecordBatch.from_arrays([pa.array(["en"] * 1000), pa.array(texts[i:i + 1000])], names=["lang", "text"])
           for i in range(0, len(texts), 1000)]
count = C._counter(["h1", "h2"], lambda x, y: np.ones(len(x), bool))
top = lambda: resource.getrusage(resource.RUSAGE_SELF).ru_maxrss >> 10
sum(len(b) for b in count(iter(batches[:1])))
before = top()
sum(len(b) for b in count(iter(batches)))
print(top() - before)
"""


def test_counting_ngrams_fits_a_small_worker():
    """Two tasks of an executor of 3000 MB count at once, beside 60 % of heap."""
    import subprocess
    import sys
    from pathlib import Path
    out = subprocess.run([sys.executable, "-c", HELD_BYTES], capture_output=True, text=True, check=True,
                         cwd=Path(__file__).parents[2])
    assert int(out.stdout) < 250
