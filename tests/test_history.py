"""The bucketed history of loaded ids: no shuffle of it, and what holds after
loads that were repeated or ended between matches and history."""

import os
import re

from pyspark.sql import functions as F

from arenalytics.operators.load import tag_existing
from arenalytics.plans.explain import plan_text
from arenalytics.sources.history import MatchHistory, committed_batches


def ids(spark, values):
    return spark.createDataFrame([(v,) for v in values], "match_id string")


def commit(spark, path, run, batch, values):
    ids(spark, values).withColumns({"run_id": F.lit(run), "batch_id": F.lit(batch)}) \
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
        .partitionBy("run_id", "batch_id").parquet(path)


def history(spark, root):
    return MatchHistory(spark, root, os.path.join(root, "matches"), buckets=8)


def loaded(h, **kw):
    return sorted(r.match_id for r in h.ids(**kw).collect())


def test_ids_of_committed_batches_only(spark, tmp_dir):
    h = history(spark, tmp_dir)
    assert loaded(h) == []
    commit(spark, h.matches, "batch", 1, ["a", "b"])
    h.append(("batch", 1), ids(spark, ["a", "b"]))
    assert loaded(h) == ["a", "b"] and loaded(h, but=("batch", 1)) == []
    # a second load ends after its matches: its ids come from them
    commit(spark, h.matches, "batch", 2, ["c"])
    assert committed_batches(spark, h.matches) == [("batch", 1), ("batch", 2)]
    assert loaded(history(spark, tmp_dir)) == ["a", "b", "c"]
    # batch 1 is loaded again with other matches: the old ids no longer hold
    h.forget(("batch", 1))
    commit(spark, h.matches, "batch", 1, ["b", "d"])
    h.append(("batch", 1), ids(spark, ["b", "d"]))
    assert loaded(h) == ["b", "c", "d"]
    # it begins once more and fails before its matches: what is committed holds
    h.forget(("batch", 1))
    assert loaded(h) == ["b", "c", "d"]


def test_lookup_moves_only_the_batch(spark, tmp_dir):
    h = history(spark, tmp_dir)
    for k in range(3):
        h.append(("batch", k), ids(spark, [f"m{i}" for i in range(k * 100, k * 100 + 100)]))
    batch = ids(spark, [f"m{i}" for i in range(250, 350)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        tagged = tag_existing(batch, h.ids())
        plan = plan_text(tagged)
        flags = {r.match_id: r["_exists"] for r in tagged.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert flags == {f"m{i}": i < 300 for i in range(250, 350)}
    tree = plan.split("\n\n")[0].splitlines()
    scan = next(k for k, line in enumerate(tree) if "match_history_" in line or "Scan parquet" in line)
    # from the history's scan up to the semi-join there is no exchange of rows
    depth = re.search(r"\w", tree[scan]).start()
    above = []
    for line in reversed(tree[:scan]):
        at = re.search(r"[A-Z]", line).start()
        if at < depth:
            depth = at
            above.append(line)
            if "SortMergeJoin" in line:
                break
    assert "SortMergeJoin" in above[-1] and not any("Exchange" in line for line in above), above
    assert "Bucketed: true" in plan


def test_bytes_read_grow_with_the_ids_not_the_documents(spark, tmp_dir):
    h = history(spark, tmp_dir)
    sizes = []
    for k in range(3):
        h.append(("batch", k), ids(spark, [f"EUW1_{i}" for i in range(k * 1000, k * 1000 + 1000)]))
        files = [f for d, _, names in os.walk(h.path) for f in (os.path.join(d, n) for n in names)
                 if f.endswith(".parquet")]
        sizes.append(sum(map(os.path.getsize, files)))
        assert len(files) <= 8 * (k + 1)
    assert sizes[0] < sizes[1] < sizes[2] < 3 * 40_000
