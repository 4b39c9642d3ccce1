import random

import numpy as np
from pyspark.sql import functions as F

from arenalytics.llm import toxicity


def corpus(n, seed):
    rnd = random.Random(seed)
    plain, rude, junk = [f"w{k}" for k in range(300)], ["nasty", "vile", "horrid"], ["zz9", "qq8"]
    rows = []
    for i in range(n):
        toxic, low = rnd.random() < .25, rnd.random() < .2
        w = [rnd.choice(plain) for _ in range(rnd.randrange(20, 200))]
        if toxic:
            w[rnd.randrange(len(w))] = rnd.choice(rude)
        if low:
            w += [rnd.choice(junk)] * 3
        rows.append((i, " ".join(w), int(not low), int(toxic)))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus(1500, 2)
    docs = spark.createDataFrame([(i, t, "x", 0.0) for i, t, _, _ in rows],
                                 "doc_id long, text string, features string, p_toxic double")
    labels = spark.createDataFrame([(i, q, x) for i, _, q, x in rows if i < 800],
                                   "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in toxicity.classify(docs, labels).collect()}
    assert len(out) == len(rows)
    held = [(out[i].toxic, bool(x)) for i, _, _, x in rows if i >= 800]
    assert np.mean([a == b for a, b in held]) > 0.98
    assert all(r.toxic == (r.p_toxic >= toxicity.THRESHOLD) for r in out.values())


def test_table_toxic_documents(spark):
    """Models fitted on half the labels, judged on the other half."""
    d = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    out = toxicity.classify(docs, labels.filter("doc_id % 2 = 0"))
    r = out.join(labels.filter("doc_id % 2 = 1").withColumnRenamed("toxic", "label"), "doc_id").agg(
        F.avg((F.col("toxic") == (F.col("label") == 1)).cast("double")).alias("right")).first()
    assert r.right > 0.92          # 17 % of them are toxic, 182 labels to learn from


def test_earlier_odds_reach_later_models():
    """The second category is the first one's odds: the dense weight decides."""
    rnd = np.random.RandomState(0)
    odds = rnd.normal(0, 4, (400, 1))
    sets = [np.unique(rnd.randint(0, 5000, 20)).astype(np.int32) for _ in range(400)]
    y = (odds[:, 0] > 0).astype(float)
    w = toxicity.fit_linear(sets, odds, y)
    assert w[toxicity.DIMENSIONS] > 0.5
    assert np.mean((toxicity._odds(sets, odds, w) > 0) == (y > 0)) > 0.95


def test_out_of_fold_models_do_not_see_the_fold(spark, monkeypatch):
    rows = corpus(300, 5)
    docs = spark.createDataFrame([(i, t) for i, t, _, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q, x) for i, _, q, x in rows], "doc_id long, quality int, toxic int")
    a = toxicity.fit_chain(docs, labels)
    assert len(a) == len(toxicity.CATEGORIES)
    assert [len(w) - toxicity.DIMENSIONS for w in a] == [1, 2]
    b = toxicity.fit_chain(docs.repartition(5), labels.repartition(3))
    assert all(np.allclose(x, y) for x, y in zip(a, b))


def test_edges(edge_docs, labels, empty_docs):
    docs, rows = edge_docs
    assert toxicity.classify(docs, labels).count() == len(rows)
    assert toxicity.classify(empty_docs, labels).count() == 0
    none = toxicity.classify(docs, labels.filter("doc_id < 0"))
    assert none.filter("p_toxic <> 0 or toxic").count() == 0 and none.count() == len(rows)
