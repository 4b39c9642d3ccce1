"""Marts: per-match fact, per-champion and per-player dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exact import mean_double, rounded_mean, rounded_rate
from ..functions.classify import STANDARD_ROLES
from ..operators.mode import mode_of_domain
from ..operators.ranking import RankSpec, add_rankings

MATCH_KEYS = ["match_id", "game_datetime", "game_date", "duration_minutes",
              "game_length_category", "queue_type", "game_version", "region",
              "loaded_at"]


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str],
                   how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` where NULL keys match each other (group keys of
    an aggregate may be NULL); output keeps the left key columns once."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b,
                  [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


class EntityKeys:
    """Group keys of a per-entity mart, encoded so that NULL is a value.

    Every aggregate of the mart groups by (coalesce(key, default), key IS
    NULL); the aggregates are then joined with a plain equi-join on those
    columns.  That is NULL-safe (a NULL key meets the other NULL key) and,
    unlike ``<=>`` join keys, matches the hash partitioning every aggregate
    already has — the joins add no shuffle.
    """

    def __init__(self, df: DataFrame, keys: list[str]):
        self.keys = keys
        types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        self.encoded = []
        for i, k in enumerate(keys):
            default = F.lit("") if types[k] == "string" else F.lit(0).cast(types[k])
            self.encoded += [F.coalesce(F.col(k), default).alias(f"_key{i}"),
                             F.col(k).isNull().alias(f"_null{i}")]
        self.cols = [f"_key{i}" for i in range(len(keys))] + \
                    [f"_null{i}" for i in range(len(keys))]

    def on(self, df: DataFrame, *extra: str) -> DataFrame:
        """``df`` with the encoded key columns (and ``extra`` columns kept)."""
        keep = [c for c in df.columns if c not in self.cols]
        return df.select(*keep, *self.encoded) if not extra else \
            df.select(*extra, *self.encoded)

    def decoded(self) -> list:
        return [F.when(~F.col(f"_null{i}"), F.col(f"_key{i}")).alias(k)
                for i, k in enumerate(self.keys)]


def distinct_count(df: DataFrame, keys: list[str], value: str, alias: str,
                   ek: EntityKeys | None = None) -> DataFrame:
    """``COUNT(DISTINCT value)`` per key as two narrow aggregates: distinct
    (key, value) pairs — shuffled on both, so one hot key spreads over many
    tasks — then a map-side-combined count per key.  Keys without a non-NULL
    value get no row (0 after a left join).  With ``ek`` the result is keyed
    by the encoded key columns."""
    if ek is None:
        return (df.filter(F.col(value).isNotNull())
                  .select(*keys, value).distinct()
                  .groupBy(*keys).agg(F.count(F.lit(1)).alias(alias)))
    rows = ek.on(df.filter(F.col(value).isNotNull()), value)
    return (rows.distinct()
                .groupBy(*ek.cols).agg(F.count(F.lit(1)).alias(alias)))


def mark_first_of_match(stg_p: DataFrame, keys: list[str]) -> DataFrame:
    """``stg_p`` with two marks: ``_first_of_match`` on one row of every match and
    ``_first_of_key`` on one row of every (match, key).  A conditional count of
    the marks is the distinct count of matches, in the same aggregate as the
    other measures; for participants that are dealt by match this moves nothing.
    Rows without a match are not marked (a distinct count leaves NULL out).
    Marks that ``with_match_marks`` stored are taken as they are."""
    if mark_name(keys) in stg_p.columns:
        return stg_p.withColumn("_first_of_key", F.col(mark_name(keys)))
    key = F.struct(*keys)
    w = Window.partitionBy("match_id").orderBy(*keys)
    at, before = F.row_number().over(w), F.lag(key).over(w)
    known = F.col("match_id").isNotNull()
    return (stg_p.withColumns({"_at": at, "_before": before})
            .withColumn("_first_of_match", known & (F.col("_at") == 1))
            .withColumn("_first_of_key", known & ((F.col("_at") == 1) | ~key.eqNullSafe(F.col("_before"))))
            .drop("_at", "_before"))


def mark_name(keys: list[str]) -> str:
    return "_first_of_" + "_".join(keys)


def with_match_marks(stg_p: DataFrame) -> DataFrame:
    """``stg_p`` with the marks of the marts, to be stored with the participants:
    on one row of every match, (match, champion name), (match, champion) and
    (match, player).  Once stored the rows are no longer dealt by match; with the
    marks no distinct count of a mart has to move them again."""
    known = F.col("match_id").isNotNull()
    for order, groups in ((CHAMPION_KEYS, [[], CHAMPION_KEYS[:1], CHAMPION_KEYS]), (["puuid"], [["puuid"]])):
        w = Window.partitionBy("match_id").orderBy(*order)
        before = {k: f"_before_{k}" for k in order}
        stg_p = stg_p.withColumns({"_at": F.row_number().over(w)} | {b: F.lag(k).over(w) for k, b in before.items()})
        for keys in groups:
            new = reduce(lambda a, b: a | b, [~F.col(k).eqNullSafe(F.col(before[k])) for k in keys], F.col("_at") == 1)
            stg_p = stg_p.withColumn(mark_name(keys or ["match"]), known & new)
        stg_p = stg_p.drop("_at", *before.values())
    return stg_p


def fact_matches(stg_m: DataFrame, stg_p: DataFrame) -> DataFrame:
    """stg_matches ⟕ stg_participants, grouped per match (18 columns).

    Aggregate first, join second: participants are reduced to one row per
    match (map-side combined, so even a match holding a huge share of the rows
    collapses before the shuffle) and the distinct champions per match come
    from stored marks in the same aggregate, or without them from distinct
    (match, champion) pairs.  The left join then pairs one match
    row with at most one aggregate row on each side — no skewed join input.
    Semantics of the grouped left join are kept: a match without players has
    total_players 1 (COUNT(*) counts the NULL-extended row), wins 0, distinct
    champions 0 and NULL averages and CS.
    """
    def wins(side):
        return F.sum(F.when((F.col("team_side") == side) & F.col("win"), 1).otherwise(0))

    def mean(c):
        return (F.sum(c).cast("double") / F.count(c)).alias(f"avg_{c}")

    marked = mark_name(["champion_name"])
    stored = marked in stg_p.columns
    per_match = stg_p.groupBy("match_id").agg(
        mean("kills"), mean("deaths"), mean("assists"),
        F.sum("total_cs").alias("total_cs"),
        mean("vision_score"),
        F.count(F.lit(1)).alias("_players"),
        wins("Blue").alias("_blue"),
        wins("Red").alias("_red"),
        *([F.count_if(F.col(marked) & F.col("champion_name").isNotNull()).alias("_champs")] if stored else []),
    )
    j = stg_m.select(*MATCH_KEYS).join(per_match, "match_id", "left")
    if not stored:
        j = j.join(distinct_count(stg_p, ["match_id"], "champion_name", "_champs"), "match_id", "left")
    return j.select(
        "match_id", "game_datetime", "game_date", "duration_minutes",
        "game_length_category", "queue_type", "game_version", "region",
        "avg_kills", "avg_deaths", "avg_assists", "total_cs", "avg_vision_score",
        F.coalesce("_players", F.lit(1)).alias("total_players"),
        F.coalesce("_blue", F.lit(0)).alias("blue_wins"),
        F.coalesce("_red", F.lit(0)).alias("red_wins"),
        F.coalesce("_champs", F.lit(0)).alias("unique_champions"),
        "loaded_at")


CHAMPION_KEYS = ["champion_name", "champion_id"]
CHAMPION_COLUMNS = [
    "champion_name", "champion_id", "total_games", "total_matches", "total_wins",
    "win_rate", "avg_kills", "avg_deaths", "avg_assists", "avg_kda", "avg_cs",
    "avg_cs_per_min", "avg_damage_dealt", "avg_damage_taken", "avg_gold_earned",
    "avg_vision_score", "most_played_role", "first_seen", "last_seen",
    "unique_players"]


def dim_champions(stg_p: DataFrame, dealt: bool = False) -> DataFrame:
    """Per (champion_name, champion_id) statistics (20 columns).

    The measures are one hash aggregate combined map-side (a popular champion
    collapses to one partial row per task); the role mode is six conditional
    counts inside it (the standardised role has a fixed set of labels).  The
    two exact distinct counts are separate (champion, value) aggregates — a
    champion is a hot key by nature, and these shuffle on the pair.  All three
    share the encoded champion key, so joining them adds no shuffle.

    With ``dealt`` (participants already dealt by match, or stored with their
    marks) matches are counted by marks beside the measures, and a 21st column ``_first_of_match`` holds the
    matches a champion is the first one of: its sum is the number of matches.
    """
    ek = EntityKeys(stg_p, CHAMPION_KEYS)
    marked = mark_first_of_match(stg_p, CHAMPION_KEYS) if dealt else stg_p
    base = ek.on(marked).groupBy(*ek.cols).agg(
        F.count(F.lit(1)).alias("total_games"),
        F.sum(F.when(F.col("win"), 1).otherwise(0)).alias("total_wins"),
        rounded_rate("win").alias("win_rate"),
        rounded_mean("kills", 2).alias("avg_kills"),
        rounded_mean("deaths", 2).alias("avg_deaths"),
        rounded_mean("assists", 2).alias("avg_assists"),
        rounded_mean("kda", 2, in_scale=2).alias("avg_kda"),
        rounded_mean("total_cs", 1).alias("avg_cs"),
        rounded_mean("cs_per_min", 1, in_scale=1).alias("avg_cs_per_min"),
        rounded_mean("damage_dealt", 0).alias("avg_damage_dealt"),
        rounded_mean("damage_taken", 0).alias("avg_damage_taken"),
        rounded_mean("gold_earned", 0).alias("avg_gold_earned"),
        rounded_mean("vision_score", 1).alias("avg_vision_score"),
        F.min("loaded_at").alias("first_seen"),
        F.max("loaded_at").alias("last_seen"),
        mode_of_domain("standardized_role", STANDARD_ROLES).alias("most_played_role"),
        *([F.count_if("_first_of_key").alias("total_matches"),
           F.count_if("_first_of_match").alias("_first_of_match")] if dealt else []),
    )
    if not dealt:
        base = base.join(distinct_count(stg_p, CHAMPION_KEYS, "match_id", "total_matches", ek), ek.cols, "left")
    out = base.join(distinct_count(stg_p, CHAMPION_KEYS, "puuid", "unique_players", ek), ek.cols, "left")
    out = out.select(*ek.decoded(), *[c for c in out.columns if c not in ek.cols])
    return out.select(
        *[F.coalesce(c, F.lit(0)).alias(c) if c in ("total_matches", "unique_players")
          else F.col(c) for c in CHAMPION_COLUMNS],
        *(["_first_of_match"] if dealt else []))


SUMMONER_COLUMNS = [
    "puuid", "summoner_name", "total_games", "total_matches",
    "unique_champions_played", "total_wins", "win_rate", "avg_kills",
    "avg_deaths", "avg_assists", "avg_kda", "avg_gold", "avg_gold_per_min",
    "avg_damage", "avg_damage_taken", "avg_cs", "avg_cs_per_min",
    "avg_vision_score", "preferred_role", "most_played_champion", "first_game",
    "last_game", "kda_percentile", "winrate_percentile"]


def summoner_aggregates(stg_p: DataFrame, recent: Column | None = None, dealt: bool = False) -> DataFrame:
    """Per-player aggregates plus the two unrounded ordering keys of the
    percentiles (``_kda_key``, ``_wr_key``: exact sums, one division); with
    ``recent`` also ``games_last_30_days``, the number of rows it marks.

    Three narrow aggregates, joined per player:

    * the numeric measures — fixed-width buffers, one hash aggregate that
      combines map-side, so a heavy player collapses before the shuffle;
    * a (player, champion) count: its groups give the distinct champions, the
      champion mode and ``MAX(summoner_name)`` (string buffers need a
      sort-based aggregate; they stay off the wide measure rows);
    * distinct (player, match) pairs, counted per player.
    Both distinct counts therefore shuffle on (player, value) first, which
    spreads a heavy player over many tasks, and never drag the measure
    buffers through a row-multiplying Expand.  All three are keyed by the
    encoded player key, so joining them adds no shuffle.  With ``dealt``
    (participants already dealt by match, or stored with their marks) the
    matches are counted by marks beside the measures instead.
    """
    ek = EntityKeys(stg_p, ["puuid"])
    marked = mark_first_of_match(stg_p, ["puuid"]) if dealt else stg_p
    base = ek.on(marked).groupBy(*ek.cols).agg(
        F.count(F.lit(1)).alias("total_games"),
        F.sum(F.when(F.col("win"), 1).otherwise(0)).alias("total_wins"),
        rounded_rate("win").alias("win_rate"),
        rounded_mean("kills", 2).alias("avg_kills"),
        rounded_mean("deaths", 2).alias("avg_deaths"),
        rounded_mean("assists", 2).alias("avg_assists"),
        rounded_mean("kda", 2, in_scale=2).alias("avg_kda"),
        rounded_mean("gold_earned", 0).alias("avg_gold"),
        rounded_mean("gold_per_min", 0).alias("avg_gold_per_min"),
        rounded_mean("damage_dealt", 0).alias("avg_damage"),
        rounded_mean("damage_taken", 0).alias("avg_damage_taken"),
        rounded_mean("total_cs", 1).alias("avg_cs"),
        rounded_mean("cs_per_min", 1, in_scale=1).alias("avg_cs_per_min"),
        rounded_mean("vision_score", 1).alias("avg_vision_score"),
        F.min("loaded_at").alias("first_game"),
        F.max("loaded_at").alias("last_game"),
        mean_double("kda", in_scale=2).alias("_kda_key"),
        (F.count_if(F.col("win")).cast("double") / F.count(F.lit(1))).alias("_wr_key"),
        mode_of_domain("standardized_role", STANDARD_ROLES).alias("preferred_role"),
        *([] if recent is None else [F.count_if(recent).alias("games_last_30_days")]),
        *([F.count_if("_first_of_key").alias("total_matches")] if dealt else []),
    )
    per_champ = ek.on(stg_p, "champion_name", "summoner_name").groupBy(
        *ek.cols, "champion_name").agg(
        F.count(F.lit(1)).alias("_n"), F.max("summoner_name").alias("_name"))
    champs = per_champ.groupBy(*ek.cols).agg(
        F.max("_name").alias("summoner_name"),
        F.count("champion_name").alias("unique_champions_played"),
        F.min_by(F.col("champion_name"),
                 F.struct(F.col("champion_name").isNull(), -F.col("_n"),
                          F.col("champion_name"))).alias("most_played_champion"))
    out = base.join(champs, ek.cols, "left")
    if not dealt:
        out = out.join(distinct_count(stg_p, ["puuid"], "match_id", "total_matches", ek), ek.cols, "left")
    out = out.select(*ek.decoded(), *[c for c in out.columns if c not in ek.cols])
    return out.withColumn("total_matches", F.coalesce("total_matches", F.lit(0)))


def dim_summoners(stg_p: DataFrame, buckets: int | None = None, dealt: bool = False) -> DataFrame:
    """Per-player profile with KDA and win-rate percentiles (24 columns)."""
    agg = summoner_aggregates(stg_p, dealt=dealt)
    ranked = add_rankings(agg, [
        RankSpec("kda_percentile", "percent_rank", "_kda_key"),
        RankSpec("winrate_percentile", "percent_rank", "_wr_key"),
    ], ["puuid"], buckets)
    return ranked.select(*SUMMONER_COLUMNS)
