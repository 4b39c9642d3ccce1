"""Atomic refresh, the file-level delete and the mergeable sketches."""

import os

import pytest
from pyspark.sql import functions as F

from arenalytics.operators import sketches as S
from arenalytics.plans import build, registry
from arenalytics.sources.adapter import load_raw
from arenalytics.sources.file_table import FileTable
from arenalytics.sources.published import Published

SF = "/root/testdata/sf0.001"


def test_a_failed_refresh_leaves_the_old_tables(spark, tmp_dir, monkeypatch):
    m, p = load_raw(spark, SF)
    tables = Published(spark, tmp_dir)
    with pytest.raises(LookupError):
        tables.read("champion_stats")
    build.refresh(spark, m, p, tmp_dir, registry.AS_OF)
    first = tables.current()
    before = sorted(map(str, tables.read("champion_stats").collect()))
    reader = tables.read("role_distribution")          # began before the next refresh
    # the next refresh fails after some of its tables are written
    monkeypatch.setattr(build.marts, "dim_summoners", lambda *a, **k: 1 / 0)
    half = m.limit(100)
    with pytest.raises(ZeroDivisionError):
        build.refresh(spark, half, p, tmp_dir, registry.AS_OF)
    assert tables.current() == first
    assert sorted(map(str, tables.read("champion_stats").collect())) == before
    monkeypatch.undo()
    build.refresh(spark, half, p, tmp_dir, registry.AS_OF)
    assert tables.current() != first and tables.read("stg_matches").count() <= 100
    assert reader.count() > 0                           # the old version's files are still there
    gone = tables.drop_old(keep=1)
    assert len(gone) == 2 and not os.path.exists(first) and tables.read("stg_matches").count() <= 100


def test_stored_order_is_read_back(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    spark.range(1000).withColumn("v", F.col("id") % 17).repartition(5) \
        .orderBy(F.col("v").desc(), "id").write.parquet(path)
    rows = build.in_stored_order(spark.read.parquet(path), ["v", "id"]).orderBy("position").collect()
    assert [r.position for r in rows] == list(range(1, 1001))
    assert [(r.v, r.id) for r in rows] == sorted(((i % 17, i) for i in range(1000)), key=lambda x: (-x[0], x[1]))


def test_delete_rewrites_only_files_with_the_key(spark, tmp_dir):
    df = spark.range(4000).select(F.when(F.col("id") % 50 != 0, F.col("id") % 40).alias("k"), "id")
    table = FileTable(spark, tmp_dir)
    with pytest.raises(LookupError):
        table.read()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table.write(df.repartition(3), cluster_by=["k", "id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    before = set(table.files())
    running = table.read()
    touched = table.delete(F.col("k") == 7)
    after = set(table.files())
    assert 0 < len(touched) < len(before)
    assert before - set(touched) == before & after
    want = sorted(r.id for r in df.filter("k is null or k <> 7").collect())
    assert sorted(r.id for r in table.read().collect()) == want         # null keys stay
    assert running.count() == 4000
    assert table.delete(F.col("k") == 1000) == [] and set(table.files()) == after
    assert table.vacuum() == len(touched) and sorted(r.id for r in table.read().collect()) == want
    table.delete(F.lit(True))
    assert table.read().count() == 0


def test_sketches_merge_over_batches(spark):
    df = spark.range(60_000).select((F.col("id") % 3).cast("int").alias("k"), (F.col("id") % 14_000).alias("v"))
    df = df.union(spark.createDataFrame([(9, None), (9, 1), (9, 1)], "k int, v long"))
    halves = [S.distinct_sketches(df.filter(F.col("v") % 2 == i), ["k"], "v") for i in range(2)] \
        + [S.distinct_sketches(df.filter("v is null"), ["k"], "v")]
    got = {r.k: r.n for r in S.estimates(S.merge_sketches(halves, ["k"]), "n").collect()}
    want = {r.k: r.n for r in df.groupBy("k").agg(F.countDistinct("v").alias("n")).collect()}
    assert got.keys() == want.keys() and got[9] == 1
    assert all(abs(got[k] - n) <= max(1, 5 * S.standard_error() * n) for k, n in want.items())
