import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from arenalytics.llm import minhash, wordhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORD.findall(t)
    return frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 \
        else frozenset([tuple(w)] if w else [])


def brute(rows):
    """{doc_id: (set size, smallest reachable id)} over all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    inv = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            inv[x].append(i)
    both = Counter()
    for ids in inv.values():
        for k, a in enumerate(ids):
            for b in ids[:k]:
                both[a, b] += 1
    for (a, b), n in both.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in minhash.near_duplicates(docs).collect()}
    want = brute(rows)
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_matches_brute_force(edge_docs):
    docs, rows = edge_docs
    out = minhash.near_duplicates(docs).collect()
    assert len(out) == len(rows)
    want = brute(rows)
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r.doc_id
            assert r.kept == (r.doc_id == r.component_id)


def edited(rnd, words, n):
    w = list(words)
    for k in rnd.sample(range(len(w)), n):
        w[k] = f"edit{rnd.randrange(10 ** 9)}"
    return " ".join(w)


@pytest.mark.parametrize("least_id", [0, 500])
def test_group_around_an_original(spark, least_id):
    """Copies link to the original more than to each other; the original is
    the smallest id, or one in the middle."""
    rnd = random.Random(3)
    base = [f"w{rnd.randrange(10 ** 6)}" for _ in range(150)]
    rows = [(least_id, " ".join(base))]
    rows += [(i + 1 + 1000 * (i % 2), edited(rnd, base, rnd.randrange(1, 9))) for i in range(300)]
    rows += [(5000 + i, " ".join(f"x{rnd.randrange(10 ** 6)}" for _ in range(60))) for i in range(20)]
    check(spark, list({i: (i, t) for i, t in rows}.values()))


@pytest.mark.parametrize("block,rows", [(7, 64), (256, 4096)])
def test_many_components_in_one_bucket(spark, monkeypatch, block, rows):
    """1,500 near copies, 4 to 12 words changed, most of them no links: pairs
    across components are met once and nearly all ruled out by their bitmaps."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "CELL_ROWS", rows)
    tested = []
    real = minhash._links
    monkeypatch.setattr(minhash, "_links", lambda pairs, texts: tested.append(pairs.count()) or real(pairs, texts))
    rnd = random.Random(11)
    base = [f"w{rnd.randrange(10 ** 6)}" for _ in range(150)]
    n = 1500 if block == 256 else 300
    check(spark, [(i, edited(rnd, base, rnd.randrange(4, 13))) for i in range(n)])
    assert tested[1] < 6 * n


def test_chain_of_edits(spark):
    """Neighbours link, ends do not: the component is the whole chain."""
    rnd = random.Random(9)
    words = [f"w{k}" for k in range(200)]
    rows = []
    for i in range(40):
        rows.append((100 - i, " ".join(words)))
        for _ in range(4):
            words[rnd.randrange(200)] = f"n{rnd.randrange(10 ** 9)}"
    check(spark, rows)


def test_common_passage_is_no_link(spark):
    rnd = random.Random(4)
    shared = " ".join(f"s{k}" for k in range(60))
    rows = [(i, shared + " " + " ".join(f"u{rnd.randrange(10 ** 7)}" for _ in range(40)))
            for i in range(150)]
    check(spark, rows)


def test_words_are_split_and_lowered_by_the_contract(spark):
    check(spark, [(1, "A B\x0bC\x0cD\r\nE F"), (2, "a b c d e f"), (3, "A b c d e f"),
                  (4, "É b c d e f"), (5, "é b c d e f"), (6, "x"), (7, "X "), (8, "")])


def test_estimate_is_unbiased(spark):
    rnd = np.random.RandomState(0)
    both, own = 600, 200
    pairs = []
    for _ in range(200):
        x = rnd.randint(0, 1 << 62, both + 2 * own).astype(np.uint64)
        m = minhash._minima([x[:both + own], np.r_[x[:both], x[both + own:]]])
        a, b = minhash._packed(m)
        pairs.append((a.tolist(), b.tolist()))
    df = spark.createDataFrame(pairs, "a array<long>, b array<long>")
    mean = (df
            .select(minhash.estimated_similarity("a", "b").alias("s")).agg({"s": "avg"}).first()[0])
    assert abs(mean - both / (both + 2 * own)) < 0.02


def test_filter_keeps_one_each(edge_docs):
    docs, rows = edge_docs
    left = minhash.keep_one_each(docs)
    assert left.columns == docs.columns
    want = brute(rows)
    assert sorted(r.doc_id or -1 for r in left.collect()) == sorted(
        i or -1 for i, _ in rows if i is None or want[i][1] == i)


def test_empty(empty_docs):
    assert minhash.near_duplicates(empty_docs).count() == 0
    assert minhash.keep_one_each(empty_docs).count() == 0


def test_word_hashes_over_slices():
    texts = ["", None, "a b", "x" * 3_000_000 + " y", "A  b ", "é\tb"]
    out = {}
    for first, sets in wordhash.shingle_sets(pa.array(texts, pa.string())):
        out.update({first + k: s.tolist() for k, s in enumerate(sets)})
    assert [len(out[k]) for k in range(6)] == [0, 0, 1, 1, 1, 1]
    assert out[2] == out[4] != out[5]
