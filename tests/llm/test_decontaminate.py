import random

import numpy as np
import pytest

from arenalytics.llm import decontaminate as dc

rnd = random.Random(12)
VOCABULARY = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrst"]


def words(n):
    return [rnd.choice(VOCABULARY) for _ in range(n)]


@pytest.fixture(scope="module")
def planted(spark):
    items = {i: words(n) for i, n in enumerate([30, 20, 60, 14, 11, 7, 3])}
    docs, want = [], set()
    for i in range(60):
        filler = [words(rnd.randrange(0, 400)), words(rnd.randrange(1, 400))]
        if i % 2:
            docs.append((i, " ".join(filler[0] + filler[1])))
            continue
        item = (i // 2) % 6
        w = list(items[item])
        if i % 4 == 0 and len(w) >= 20:                      # one word in ten replaced
            for k in range(5, len(w), 10):
                w[k] = "changed"
        text = " ".join(filler[0]) + " -- " + ", ".join(x.upper() for x in w) + ". " + " ".join(filler[1])
        docs.append((i, text))
        want.add((i, item))
    # a row without an id and an item of three words are searched too
    docs += [(100, None), (101, ""), (None, " ".join(items[0])), (102, " ".join(items[6])),
             (103, " ".join(items[0][:12])), (104, " ".join([*items[6][:2], "changed"]))]
    want |= {(None, 0), (102, 6)}
    benchmark = spark.createDataFrame(
        [(i, " ".join(w), 0) for i, w in items.items()] + [(50, None, 0), (51, "", 0), (0, " ".join(items[0]), 0)],
        "item_id long, text string, pos int")
    return spark.createDataFrame([d + (1, "x") for d in docs],
                                 "doc_id long, text string, seed long, shifts string"), benchmark, want


def test_planted_items_are_found_and_clean_texts_are_not(planted):
    docs, benchmark, want = planted
    got = {(r.doc_id, r.item_id): r for r in dc.contaminated(docs, benchmark).collect()}
    assert set(got) == want
    assert all(r.overlap >= dc.MIN_OVERLAP for r in got.values())


def test_full_bitmaps_change_nothing(planted, monkeypatch):
    """Bitmaps only sieve: with every bit set the join alone decides."""
    docs, benchmark, want = planted
    real = dc.bitmap

    def full(keys, position):
        bits = real(keys, position)
        return keys.sparkSession.sparkContext.broadcast(np.full_like(bits.value, 255))
    monkeypatch.setattr(dc, "bitmap", full)
    assert {(r.doc_id, r.item_id) for r in dc.contaminated(docs.limit(30), benchmark).collect()} == {
        w for w in want if w[0] in {r.doc_id for r in docs.limit(30).collect()}}


def test_items_that_share_an_id_and_items_without_one(spark):
    a, b, c = words(12), words(15), words(9)
    benchmark = spark.createDataFrame([(1, " ".join(a)), (1, " ".join(b)), (None, " ".join(c)), (2, " ... "), (3, None)],
                                      "item_id long, text string")
    docs = spark.createDataFrame([(10, " ".join(a)), (11, " ".join(b)), (12, " ".join(c)), (13, " ".join(a + b)),
                                  (14, "clean"), (11, " ".join(b))], "doc_id long, text string")
    got = sorted(((r.doc_id, r.item_id, r.same_words) for r in dc.contaminated(docs, benchmark).collect()), key=str)
    assert got == [(10, 1, 12), (11, 1, 15), (12, None, 9), (13, 1, 15)]
    assert [r.doc_id for r in dc.decontaminate(docs, benchmark).collect()] == [14]


def brute_overlap(doc, item, rate=dc.MIN_OVERLAP):
    """Whether the words hold the item by the rule, substitutions only: some
    place at which enough of its words, or of a run, stand in order."""
    n = len(item)
    rate = 1.0 if n <= dc.EXACT_WORDS else rate
    need = min(int(np.ceil(rate * n - 1e-9)), dc.RUN_WORDS)
    for s in range(-n + 1, len(doc)):
        same = [0 <= s + k < len(doc) and doc[s + k] == item[k] for k in range(n)]
        if sum(same) >= rate * n - 1e-9:
            return True
        for a in range(n):
            for z in range(a + need, n + 1):
                if same[a] and same[z - 1] and need <= sum(same[a:z]) >= rate * (z - a) - 1e-9:
                    return True
    return False


def test_substitutions_match_brute_force(spark):
    rnd2 = random.Random(77)
    items = {k: words(n) for k, n in enumerate([2, 4, 5, 6, 8, 10, 11, 16, 33])}
    docs = {}
    for d in range(120):
        item = list(rnd2.choice(list(items.values())))
        for k in rnd2.sample(range(len(item)), rnd2.randrange(0, max(1, len(item) // 2))):
            item[k] = f"zz{rnd2.randrange(9)}"
        docs[d] = words(rnd2.randrange(0, 40)) + item + words(rnd2.randrange(0, 40))
    want = {(d, i) for d, w in docs.items() for i, item in items.items() if brute_overlap(w, item)}
    got = {(r.doc_id, r.item_id) for r in dc.contaminated(
        spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], "doc_id long, text string"),
        spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()], "item_id long, text string")).collect()}
    assert want <= got                                   # nothing the rule accepts is lost
    extra = {(d, i) for d, i in got - want}              # only overlaps with moved words
    assert all(len(dc.common_places(items[i], docs[d])[0]) >= min(
        np.ceil(dc.MIN_OVERLAP * len(items[i]) - 1e-9), dc.RUN_WORDS) for d, i in extra)


def test_filter_drops_whole_documents(planted):
    docs, benchmark, want = planted
    left = dc.decontaminate(docs, benchmark)
    assert left.columns == docs.columns
    bad = {i for i, _ in want}
    ids = [r.doc_id for r in docs.collect()]
    assert sorted(map(str, (r.doc_id for r in left.collect()))) == sorted(
        str(i) for i in ids if i not in bad)


def test_a_seed_ignores_masked_words():
    h = np.arange(1, dc.SPAN + 1, dtype=np.uint64)
    off = np.array([0, dc.SPAN])
    base, _ = dc._seeds(h, off, dc.SPAN)
    for k in range(dc.SPAN):
        changed = h.copy()
        changed[k] = 999
        same = dc._seeds(changed, off, dc.SPAN)[0] == base
        assert same.tolist() == [mask[k] == "0" for mask in dc.MASKS]


def test_empty(empty_docs, planted, spark):
    docs, benchmark, _ = planted
    assert dc.contaminated(empty_docs, benchmark).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.contaminated(docs, none).count() == 0
    assert dc.decontaminate(docs, none).count() == docs.count()


def test_edge_documents(edge_docs, spark):
    docs, rows = edge_docs
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    items = {r.item_id: r.text for r in benchmark.collect()}
    want = {(i, k) for i, t in rows if i is not None and t for k, x in items.items() if x in t}
    got = {(r.doc_id, r.item_id) for r in dc.contaminated(docs, benchmark).collect()}
    assert want <= got and {i for i, _ in got} == {i for i, _ in want}


def test_every_accepted_pattern_of_changed_words_is_hit():
    from itertools import combinations
    for n in [*range(5, 16), 20]:
        allowed = n - int(np.ceil(dc.MIN_OVERLAP * n - 1e-9))
        windows = [(a, mask) for k in dc._spans_of(n) for a in range(n - k + 1)
                   for mask in dc.MASKS_OF[k]]
        regarded = {sum(1 << (a + k) for k, c in enumerate(m) if c == "1") for a, m in windows}
        for gone in combinations(range(n), allowed):
            bits = sum(1 << k for k in gone)
            assert any(not r & bits for r in regarded), (n, gone)


def test_passages_of_long_items_and_moved_words_are_found(spark):
    items = {0: words(59), 1: words(500), 2: words(24), 3: words(24), 4: words(9), 5: words(30)}
    texts = {0: items[0][10:50], 1: items[1][100:400],                # passages
             2: items[2][:12] + ["inserted"] + items[2][12:],
             3: items[3][:11] + items[3][12:],                        # a word left out
             4: [*items[4][:4], "changed", *items[4][5:8], "changed"],   # 7 of 9
             5: items[5][:10]}                                        # too short a passage
    docs = spark.createDataFrame([(i, " ".join(words(80) + w + words(80))) for i, w in texts.items()],
                                 "doc_id long, text string")
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in items.items()],
                                      "item_id long, text string")
    got = {r.doc_id: r for r in dc.contaminated(docs, benchmark).collect()}
    assert set(got) == {0, 1, 2, 3, 4} and all(r.item_id == r.doc_id for r in got.values())
    assert got[0].same_words >= 40 and got[1].same_words >= 300
    assert got[2].same_words == 24 and got[3].same_words == 23


def test_common_places_are_a_longest_common_subsequence():
    for _ in range(100):
        a, b = ([rnd.randrange(6) for _ in range(rnd.randrange(15))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        i, j = dc.common_places(a, b)
        assert len(i) == best[-1][-1] and all(a[p] == b[q] for p, q in zip(i, j))
        assert all(np.diff(i) > 0) and all(np.diff(j) > 0)
