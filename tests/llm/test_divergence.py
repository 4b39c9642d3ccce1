import random
import re
from collections import Counter, defaultdict

import pytest

from arenalytics.llm import divergence

SCHEMA = "lang string, source string, text string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_docs=30, top=50):
    n, docs, groups = Counter(), Counter(), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall((text or "").translate(LOWER))
        for t in terms:
            n[lang, source, t] += 1
        for t in set(terms):
            docs[lang, t] += 1
    kept = defaultdict(list)
    for (lang, t), d in docs.items():
        if d >= min_docs:
            kept[lang].append(t)
    sources = defaultdict(list)
    for lang, source in groups:
        sources[lang].append(source)

    def share(lang, count):
        total, v = sum(count(t) for t in kept[lang]), len(kept[lang])
        return {t: 1 + 10 ** 9 * (count(t) + 5) // (total + 5 * v) for t in kept[lang]}
    out = []
    for lang in sources:
        p = {s: share(lang, lambda t: n[lang, s, t]) for s in sources[lang]}
        q = share(lang, lambda t: sum(n[lang, s, t] for s in sources[lang]))
        for s in sources[lang]:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept[lang]), o.encode()) for o in sources[lang] if o != s]
            terms = [(q[t] - p[s][t], t.encode()) for t in kept[lang] if n[lang, s, t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, i.decode(), -v, k) for k, (v, i) in enumerate(items, 1)]
    return sorted(out)


def corpus(seed=1, sources=9):
    rnd = random.Random(seed)
    words = ["The", "été", "Straße", "x1y", "don't", "ÀB"] + [f"w{chr(97 + k)}" for k in range(26)]
    rows = [(rnd.choice(["en", "de", None]), rnd.choice([None] + [f"s{k}" for k in range(sources)] * 2 + ["s0"] * 9),
             " ".join(words[min(int(rnd.expovariate(0.2)), len(words) - 1)] for _ in range(rnd.randrange(0, 40))))
            for _ in range(400)]
    return rows + [("en", "empty", None), ("en", "blank", " 1 2 "), ("xx", "a", "rare"), ("xx", "b", None),
                   ("yy", "lonely", "word"), (None, None, None), ("de", "s1", "lang " * 5000)] + [rows[0]] * 3


def check(spark, rows, **kw):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in divergence.audit(docs, **kw).collect())
    assert got == brute(rows, **({"min_docs": kw["min_docs"]} if "min_docs" in kw else {}))
    return got


def test_matches_brute_force(spark):
    got = check(spark, corpus())
    assert {r[2] for r in got} == {"pair", "term"}


@pytest.mark.parametrize("block,cell", [(1, 7), (2, 1000), (4, 20)])
def test_many_cells(spark, monkeypatch, block, cell):
    monkeypatch.setattr(divergence, "GROUP_BLOCK", block)
    monkeypatch.setattr(divergence, "CELL_ROWS", cell)
    check(spark, corpus(2, sources=23), min_docs=3)


def test_empty_and_clashing_columns(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = corpus(3)
    docs = spark.createDataFrame([r + ("?",) * 5 for r in rows],
                                 SCHEMA + ", term string, p string, n string, block string, rank string")
    assert sorted(tuple(r) for r in divergence.audit(docs).collect()) == brute(rows)
