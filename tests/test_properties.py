"""Property checks on the driver's smallest tables and plan
guards for the scale-relevant shapes."""

import pytest
from pyspark.sql import functions as F

from arenalytics.plans import analytics, marts, registry
from arenalytics.plans.explain import plan_text
from helpers import match, matches_df, participant, participants_df
from arenalytics.plans.staging import stg_matches, stg_participants

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def models(spark):
    return registry.Models(spark, SF)


def test_games_add_up(models):
    sp = models.stg_participants
    n = sp.count()
    dc = marts.dim_champions(sp)
    assert dc.agg(F.sum("total_games")).first()[0] == n
    ds = marts.summoner_aggregates(sp)
    assert ds.agg(F.sum("total_games")).first()[0] == n
    # every player's distinct matches ≤ games, distinct champions ≤ games
    assert ds.filter((F.col("total_matches") > F.col("total_games"))
                     | (F.col("unique_champions_played") > F.col("total_games"))).count() == 0


def test_percentiles_and_deciles(models):
    pp = models.player_performance()
    ds = models.dim_summoners()
    bad = ds.filter((F.col("kda_percentile") < 0) | (F.col("kda_percentile") > 1)
                    | (F.col("winrate_percentile") < 0) | (F.col("winrate_percentile") > 1))
    assert bad.count() == 0
    sizes = [r["count"] for r in pp.groupBy("kda_decile").count().collect()]
    assert len(sizes) == min(10, pp.count()) and max(sizes) - min(sizes) <= 1


def test_fact_counts_match_participants(models):
    f = models.fact_matches()
    sp = models.stg_participants
    with_players = f.filter(F.col("avg_kills").isNotNull())
    assert with_players.agg(F.sum("total_players")).first()[0] == sp.count()


def test_hot_player_and_hot_champion(spark):
    """One player and one champion own most rows: results stay exact."""
    ms = [match(f"m{i}") for i in range(300)]
    ps = [participant(i, f"m{i}", puuid="hot", champ="Hot", k=i % 7, d=1 + i % 3)
          for i in range(300)]
    ps += [participant(1000 + i, f"m{i}", puuid=f"p{i}", champ=f"C{i % 5}") for i in range(20)]
    sp = stg_participants(participants_df(spark, ps), stg_matches(matches_df(spark, ms)))
    ds = {r.puuid: r for r in marts.summoner_aggregates(sp).collect()}
    assert ds["hot"].total_games == 300 and ds["hot"].total_matches == 300
    assert ds["hot"].unique_champions_played == 1 and ds["hot"].most_played_champion == "Hot"
    dc = {r.champion_name: r for r in marts.dim_champions(sp).collect()}
    assert dc["Hot"].total_games == 300 and dc["Hot"].unique_players == 1
    assert dc["C0"].total_matches == 4


def test_measure_aggregates_stay_hash_based(models):
    """No string buffer or Expand drags the wide measure aggregate into a
    sort-based aggregate."""
    sp = models.stg_participants
    for df in (marts.dim_champions(sp), marts.summoner_aggregates(sp)):
        text = plan_text(df, "simple")
        assert "Expand" not in text
        sort_aggs = [ln for ln in text.split("\n") if "SortAggregate" in ln]
        assert all("sum(" not in ln for ln in sort_aggs), sort_aggs


def test_fact_join_reads_aggregated_participants(models):
    text = plan_text(models.fact_matches(), "simple")
    join_at = text.index("Join")
    assert "HashAggregate" in text[join_at:]


def test_meta_lists_are_top_k_not_full_sorts(models):
    text = plan_text(analytics.meta_top_champions(models.champion_stats()), "simple")
    assert "TakeOrderedAndProject" in text
