"""Marts over participants that are dealt by match: matches counted in place."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from arenalytics.plans import analytics, marts
from arenalytics.plans.registry import Models
from arenalytics.sources.adapter import raw_participants_from_lines

from helpers import match, matches_df, participant, participants_df
from test_text_in_place import plan, tables, without_broadcasts

AS_OF = dt.date(2024, 4, 1)


def staged(spark):
    """Players and champions that come twice in a match, NULL keys, a NULL match."""
    from arenalytics.plans import staging
    rows = [("m1", "p1", 1, "Ahri"), ("m1", "p1", 1, "Ahri"), ("m1", "p2", 2, "Zed"), ("m1", None, None, "Zed"),
            ("m2", "p1", 1, "Ahri"), ("m2", "p2", None, "Zed"), ("m2", "p2", None, "Zed"), ("m3", None, 2, "Ahri"),
            ("m3", None, 2, "Ahri"), ("m4", "p3", 2, "Zed"), ("m4", "p1", 1, "Ahri")]
    p = staging.stg_participants(
        participants_df(spark, [participant(i, m, puuid=u, champ_id=c, champ=n, k=i, win=i % 3 == 0)
                                for i, (m, u, c, n) in enumerate(rows)]),
        staging.stg_matches(matches_df(spark, [match(m) for m in ("m1", "m2", "m3", "m4")])))
    return p.withColumn("match_id", F.when(F.col("match_id") != "m4", F.col("match_id")))


def sorted_rows(df):
    return sorted(map(repr, df.collect()))


def test_marks_count_as_distinct_counts_do(spark):
    p = staged(spark)
    plain, dealt = marts.dim_champions(p), marts.dim_champions(p, dealt=True)
    assert sorted_rows(dealt.drop("_first_of_match")) == sorted_rows(plain)
    assert dealt.agg(F.sum("_first_of_match")).first()[0] == 3
    assert sorted_rows(analytics.champion_stats(dealt, None, AS_OF)) == \
        sorted_rows(analytics.champion_stats(plain, p, AS_OF))
    assert sorted_rows(marts.summoner_aggregates(p, dealt=True).select(sorted(marts.summoner_aggregates(p).columns))) == \
        sorted_rows(marts.summoner_aggregates(p).select(sorted(marts.summoner_aggregates(p).columns)))


@pytest.fixture
def models(spark, tmp_dir):
    for name, df in zip(("orders", "lineitem", "part"), tables(spark)):
        df.write.parquet(os.path.join(tmp_dir, f"{name}.parquet"))
    return Models(spark, tmp_dir)


def test_few_orders_are_dealt_as_many_are(models):
    # the same joins and two scans of the lines, however small the orders are
    for df in (models.dim_champions(), marts.summoner_aggregates(models.dealt_participants, dealt=True)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.count("lineitem.parquet") == 2 and plan.count("SortMergeJoin") >= 4
        assert plan.count("Exchange hashpartitioning(_match") == 2


def test_pick_rate_is_of_all_matches(models):
    assert [r.pick_rate for r in models.champion_stats().select(F.col("pick_rate").cast("double").alias("pick_rate"))
            .collect()] == [200.0]


def test_packed_lines_give_the_same_participants(spark):
    orders, lines, part = tables(spark)
    at_noon, before = dt.datetime(1999, 5, 1, 12, 30), dt.datetime(1960, 2, 3)
    odd = [(1, 5, 6, 7, 3.9, 1e6, 0.1, "N", "O", at_noon), (1, 5, None, 1, 255.0, 1048575.0, 2.55, "R", "F", before),
           (2, 5, 6, 15, 256.0, 5e8, 9.0, None, None, None), (2, 5, 39999, 3, -4.0, -1.5, -0.5, "A", "O", at_noon.date()),
           (3, 5, 6, None, None, None, None, "NN", "O", dt.datetime(2150, 1, 1)), (3, None, 6, 2, 1.0, 1.0, 0.0, "A", "O", None),
           (None, 5, 6, 2, 1.0, 1.0, 0.0, "A", "O", None), (4, 5, 6, 16, 0.0, 0.0, 0.0, "", "F", dt.datetime(1970, 1, 1))]
    odd = [(*r[:-1], dt.datetime.combine(r[-1], dt.time()) if type(r[-1]) is dt.date else r[-1]) for r in odd]
    lines = lines.union(spark.createDataFrame(odd + odd[:2], lines.schema))
    whole, packed = (raw_participants_from_lines(lines, orders, part, packed=x) for x in (False, True))
    assert whole.schema == packed.schema and whole.count() == 14
    assert sorted_rows(packed) == sorted_rows(whole)
    # one long in place of seven columns on the way to the matches
    moved = [x for x in without_broadcasts(spark, lambda: packed.drop("id")).splitlines() if "hashpartitioning(_match" in x]
    assert len(moved) == 1 and "_word" in plan(packed)
