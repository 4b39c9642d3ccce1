"""A load leaves document texts where they are; lines are dealt by match once."""

import datetime as dt
import glob

from pyspark.sql import functions as F

from arenalytics.operators import load as L
from arenalytics.plans import ingest, staging
from arenalytics.sources.adapter import raw_matches_from_orders, raw_participants_from_lines

DAY = dt.datetime(1999, 5, 1)


def tables(spark):
    orders = spark.createDataFrame(
        [(k, 7, "F", 1000.5 + k, d, "1-URGENT") for k, d in
         [(1, dt.datetime(1996, 1, 1)), (2, dt.datetime(1997, 6, 1)), (3, DAY), (4, DAY)]],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string")
    lines = spark.createDataFrame(
        [(k, 5, 6, n, 3.0, 99.9, 0.07, "R", "O", DAY) for k in (1, 2, 3) for n in (1, 2)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
    part = spark.createDataFrame([(5, "Brand#12", "LARGE", 9)],
                                 "p_partkey long, p_brand string, p_type string, p_size int")
    return orders, lines, part


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def without_broadcasts(spark, build):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return plan(build())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_lines_are_dealt_by_match_once(spark):
    orders, lines, part = tables(spark)

    def staged():
        return staging.stg_participants(raw_participants_from_lines(lines, orders, part),
                                        staging.stg_matches(raw_matches_from_orders(orders)))
    # lines and parts by the part, lines, orders and matches by the match
    assert without_broadcasts(spark, staged).count("Exchange hashpartitioning") == 5
    got = staged().select("match_id", "kills", "assists", "gold_earned", "win", "champion_id").distinct().collect()
    assert sorted(map(tuple, got)) == [(m, 3, 7, 99, True, 1209) for m in "123"]


def test_texts_stay_where_they_are(spark):
    parsed = ingest.materialize(spark.range(200).select(
        F.col("id").alias("row"), F.concat(F.lit("text"), "id").alias("value")), "parsed")
    chosen = parsed.select("row", (F.col("row") % 3 == 0).alias("_exists")).filter("row % 2 = 0")
    rows = ingest.chosen_rows(chosen)
    new = ingest.inserted_documents(parsed, rows)
    assert "Exchange hashpartitioning" not in plan(new)
    assert sorted(r.row for r in new.collect()) == [i for i in range(200) if i % 2 == 0 and i % 3]


def test_only_texts_that_differ_are_compared(spark):
    rows = [("a", 1 << 33, "same"), ("a", 7, "same"), ("b", 9, "y"), ("b", 70, "x"), ("b", 71, "x"), ("c", 63, "z")]
    got = L.choose_documents(spark.createDataFrame(rows, "match_id string, row long, value string"))
    assert sorted(map(tuple, got.collect())) == [("a", 7, 2), ("b", 70, 3), ("c", 63, 1)]


def test_landing_is_packed_and_whole(spark, tmp_dir, monkeypatch):
    by_name = dict(zip(("orders", "lineitem", "part"), tables(spark)))
    monkeypatch.setattr(ingest, "read_table", lambda spark, sf_dir, name: by_name[name])
    parts = ingest.write_stand_in_landing(spark, "", f"{tmp_dir}/landing")
    assert all(glob.glob(f"{p}/*.gz") for p in parts.values())
    ids = {name: sorted(r[0] for r in spark.read.text(p).select(
        F.get_json_object("value", "$.metadata.matchId")).collect()) for name, p in parts.items()}
    assert ids == {"b1": ["1", "2"], "b2a": ["2", "3", "4"], "b2b": ["3", "4"]}
    again = spark.read.text(f"{tmp_dir}/landing/*")
    assert again.columns == ["value"] and again.count() == 7


def test_a_load_leaves_only_its_sink(spark, tmp_dir, monkeypatch):
    """Scratch tables of a batch go when it is committed, or when it fails."""
    import os

    import pytest

    from arenalytics.session import ensure_checkpoint_dir
    from test_ingest import _batch1, _write

    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(root))
    _write(f"{tmp_dir}/b1", _batch1())
    ingest.ingest_batch(spark, f"{tmp_dir}/b1", f"{tmp_dir}/sink", 1, DAY)
    assert set(os.listdir(root)) == before

    def fails(*_):
        raise RuntimeError("no room")

    monkeypatch.setattr(ingest, "commit_matches", fails)
    with pytest.raises(RuntimeError, match="no room"):
        ingest.ingest_batch(spark, f"{tmp_dir}/b1", f"{tmp_dir}/sink", 2, DAY)
    assert set(os.listdir(root)) == before


def test_stand_in_landing_goes_when_it_is_loaded(spark, tmp_dir, monkeypatch):
    import os
    names = dict(zip(("orders", "lineitem", "part"), tables(spark)))
    monkeypatch.setattr(ingest, "read_table", lambda _spark, _dir, name: names[name])
    sink = ingest.run_two_batches(spark, "", tmp_dir)
    assert os.listdir(tmp_dir) == ["sink"]
    assert sorted(r.match_id for r in ingest.read_sink(spark, sink, "matches").collect()) == ["1", "2", "3", "4"]
