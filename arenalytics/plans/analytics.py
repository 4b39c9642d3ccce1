"""Analytics: champion ranking, player performance, meta report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions.exact import round_ratio, unscaled
from ..functions.timeutil import date_literal, ntz_literal
from ..operators.ranking import RankSpec, add_rankings
from ..session import materialize

CHAMPION_STATS_COLUMNS = [
    "champion_name", "champion_id", "total_games", "pick_rate", "win_rate",
    "total_wins", "winrate_rank", "popularity_rank", "avg_kills", "avg_deaths",
    "avg_assists", "avg_kda", "avg_damage_dealt", "avg_damage_taken",
    "avg_gold_earned", "avg_cs", "avg_cs_per_min", "avg_vision_score",
    "most_played_role", "tier", "first_seen", "last_seen", "calculated_at"]

PLAYER_COLUMNS = [
    "puuid", "summoner_name", "total_games", "recent_games",
    "unique_champions_played", "win_rate", "total_wins", "avg_kills",
    "avg_deaths", "avg_assists", "avg_kda", "avg_gold", "avg_gold_per_min",
    "avg_damage", "avg_damage_taken", "avg_cs", "avg_cs_per_min",
    "avg_vision_score", "preferred_role", "most_played_champion", "kda_decile",
    "winrate_decile", "skill_tier", "first_game", "last_game",
    "days_since_last_game", "activity_status", "calculated_at"]


def as_of_timestamp(as_of: dt.datetime | dt.date) -> Column:
    """The injectable 'now' (CURRENT_TIMESTAMP) as a timestamp_ntz literal."""
    return ntz_literal(as_of)


def as_of_date(as_of: dt.datetime | dt.date) -> Column:
    """CURRENT_DATE for the given 'now'."""
    return date_literal(as_of)


def total_matches(stg_p: DataFrame) -> Column:
    """``SELECT COUNT(DISTINCT match_id)`` over all participants, as a scalar
    subquery (two-phase distinct aggregate, evaluated once; a count of the marks
    where they are stored)."""
    if "_first_of_match" in stg_p.columns:
        return stg_p.agg(F.count_if("_first_of_match").alias("total_matches")).scalar()
    return stg_p.agg(F.countDistinct("match_id").alias("total_matches")).scalar()


def champion_stats(dim_c: DataFrame, stg_p: DataFrame | None, as_of,
                   buckets: int | None = None) -> DataFrame:
    """Ranked champion table with pick rate and tier (23 columns).

    ``dim_c`` is ``marts.dim_champions`` with the staged participants, or without
    them that of dealt participants: then its marks hold the number of matches,
    which is summed over the champions, written once for it."""
    if stg_p is None:
        dim_c = materialize(dim_c, "champions")
        matches = dim_c.agg(F.coalesce(F.sum("_first_of_match"), F.lit(0))).scalar()
    else:
        matches = total_matches(stg_p)
    c = dim_c.withColumn("pick_rate", round_ratio(F.col("total_games") * 100, matches, 2))
    ranked = add_rankings(c, [
        RankSpec("winrate_rank", "rank", "win_rate", descending=True),
        RankSpec("popularity_rank", "rank", "total_games", descending=True),
    ], ["champion_id", "champion_name"], buckets)
    return ranked.select(
        *[F.col(x) for x in CHAMPION_STATS_COLUMNS[:19]],
        C.champion_tier("win_rate", "total_games").alias("tier"),
        "first_seen", "last_seen",
        as_of_timestamp(as_of).alias("calculated_at"))


def recent_games(stg_p: DataFrame, as_of) -> DataFrame:
    """Games per player loaded in the last 30 days before ``as_of``'s date."""
    return (stg_p.filter(is_recent(as_of))
                 .groupBy("puuid").agg(F.count(F.lit(1)).alias("games_last_30_days")))


def is_recent(as_of) -> Column:
    """Whether a row was loaded in the last 30 days before ``as_of``'s date."""
    since = F.date_sub(as_of_date(as_of), C.RECENT_DAYS).cast("timestamp_ntz")
    return F.col("loaded_at") >= since


def player_performance(dim_s: DataFrame, stg_p: DataFrame | None, as_of,
                       buckets: int | None = None) -> DataFrame:
    """Player report with deciles, skill tier and activity (28 columns).

    ``dim_s`` is ``marts.dim_summoners`` with the staged participants, or without
    them ``marts.summoner_aggregates`` with ``is_recent``: then the percentile of
    the skill tier is ranked here, beside the deciles."""
    specs = [RankSpec("kda_decile", "ntile", "avg_kda", tiebreak=("puuid",)),
             RankSpec("winrate_decile", "ntile", "win_rate", tiebreak=("puuid",))]
    if stg_p is None:
        p = dim_s
        specs.append(RankSpec("kda_percentile", "percent_rank", "_kda_key"))
    else:
        p = dim_s.join(recent_games(stg_p, as_of), "puuid", "left")
    ranked = add_rankings(p, specs, ["puuid"], buckets)
    days = F.datediff(as_of_date(as_of), F.to_date("last_game"))
    return ranked.select(
        "puuid", "summoner_name", "total_games",
        F.coalesce("games_last_30_days", F.lit(0)).alias("recent_games"),
        "unique_champions_played", "win_rate", "total_wins", "avg_kills",
        "avg_deaths", "avg_assists", "avg_kda", "avg_gold", "avg_gold_per_min",
        "avg_damage", "avg_damage_taken", "avg_cs", "avg_cs_per_min",
        "avg_vision_score", "preferred_role", "most_played_champion",
        "kda_decile", "winrate_decile",
        C.skill_tier("kda_percentile").alias("skill_tier"),
        "first_game", "last_game",
        days.alias("days_since_last_game"),
        C.activity_status(days).alias("activity_status"),
        as_of_timestamp(as_of).alias("calculated_at"))


# --- meta report -----------------------------------------------------------

MIN_GAMES_FOR_RANKING = 20   # sample-size threshold of the best/worst lists
TOP_K = 10


def _top_k(df: DataFrame, order: list[Column], fields: list[tuple[str, str]]) -> DataFrame:
    """Top-k rows (k = 10) in ``order`` with a (name, id) tiebreak — the
    champion key, so the cut is deterministic — numbered 1..k.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its
    own k best rows and a single task merges at most k × tasks rows.
    """
    full = order + [F.col("champion_name").asc_nulls_last(),
                    F.col("champion_id").asc_nulls_last()]
    top = df.orderBy(*full).limit(TOP_K)
    return top.select(
        F.row_number().over(Window.orderBy(*full)).alias("position"),
        *[F.col(src).alias(dst) for dst, src in fields])


def meta_top_champions(cs: DataFrame) -> DataFrame:
    return _top_k(cs.filter(F.col("total_games") >= MIN_GAMES_FOR_RANKING),
                  [F.col("win_rate").desc_nulls_first()],
                  [("champion", "champion_name"), ("winrate", "win_rate"),
                   ("games", "total_games")])


def meta_worst_champions(cs: DataFrame) -> DataFrame:
    return _top_k(cs.filter(F.col("total_games") >= MIN_GAMES_FOR_RANKING),
                  [F.col("win_rate").asc_nulls_last()],
                  [("champion", "champion_name"), ("winrate", "win_rate"),
                   ("games", "total_games")])


def meta_most_popular(cs: DataFrame) -> DataFrame:
    return _top_k(cs, [F.col("pick_rate").desc_nulls_first()],
                  [("champion", "champion_name"), ("pick_rate", "pick_rate"),
                   ("winrate", "win_rate")])


def _as_json_list(top: DataFrame) -> Column:
    """JSON_AGG(JSON_BUILD_OBJECT(...)) in list order; NULL over no rows."""
    fields = [c for c in top.columns if c != "position"]
    arr = F.transform(
        F.sort_array(F.collect_list(F.struct("position", *fields))),
        lambda s: F.struct(*[s[f].alias(f) for f in fields]))
    one = top.agg(F.when(F.size(arr) > 0, arr).alias("v"))
    return one.scalar()


def meta_global_stats(cs: DataFrame, as_of) -> DataFrame:
    """Global averages over champions (unweighted means of the rounded
    per-champion values, exact sums then one division) and the count."""
    n = F.count(F.lit(1))
    return cs.agg(
        (F.sum(unscaled("win_rate", 2)).cast("double") / (n * 100)).alias("global_avg_winrate"),
        (F.sum(unscaled("avg_kda", 2)).cast("double") / (n * 100)).alias("global_avg_kda"),
        n.alias("total_champions_played"),
    ).select("*", as_of_timestamp(as_of).alias("calculated_at"))


def meta_analysis(cs: DataFrame, as_of) -> DataFrame:
    """One-row meta report: three ordered top-10 lists plus global stats.

    Each list is a scalar subquery over a ≤10-row top-k, so no join or cross
    product is needed to assemble the row.
    """
    g = meta_global_stats(cs, as_of)
    return g.select(
        _as_json_list(meta_top_champions(cs)).alias("top_champions"),
        _as_json_list(meta_worst_champions(cs)).alias("worst_champions"),
        _as_json_list(meta_most_popular(cs)).alias("most_popular_champions"),
        "global_avg_winrate", "global_avg_kda", "total_champions_played",
        "calculated_at")


def meta_analysis_json(meta: DataFrame) -> DataFrame:
    """JSON text for the sink; NULL fields inside objects are kept."""
    opts = {"ignoreNullFields": "false"}
    return meta.select(
        *[F.to_json(c, opts).alias(c) for c in
          ("top_champions", "worst_champions", "most_popular_champions")],
        "global_avg_winrate", "global_avg_kda", "total_champions_played",
        "calculated_at")


def role_distribution(cs: DataFrame) -> DataFrame:
    """Champions per most-played role and their mean win rate (unrounded)."""
    n = F.count(F.lit(1))
    return cs.groupBy(F.col("most_played_role").alias("role")).agg(
        n.alias("champion_count"),
        (F.sum(unscaled("win_rate", 2)).cast("double") / (n * 100)).alias("avg_role_winrate"))
