"""Staging layer: cleaned, typed and classified matches and participants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import classify as C
from ..functions.exact import (
    from_unscaled, half_up_quotient, int_div, nullif_zero, round_ratio, unscaled)


def stg_matches(matches: DataFrame) -> DataFrame:
    """raw.matches → one cleaned row per match (14 columns).

    The validity filter sits right on the raw columns so Catalyst pushes it
    into the Parquet scan.
    """
    m = matches.filter((F.col("game_duration") > 0) & (F.col("game_creation") > 0))
    game_dt = F.timestamp_seconds(int_div("game_creation", F.lit(1000)))
    return m.select(
        "match_id",
        F.col("platform_id").alias("region"),
        game_dt.alias("game_datetime"),
        F.to_date(game_dt).alias("game_date"),
        F.col("game_creation").alias("game_creation_timestamp"),
        "game_mode",
        "game_type",
        "queue_id",
        "game_version",
        F.col("game_duration").alias("duration_seconds"),
        round_ratio("game_duration", F.lit(60), 1, precision=12, wide=False)
        .alias("duration_minutes"),
        C.duration_bucket("game_duration").alias("game_length_category"),
        C.queue_label("queue_id").alias("queue_type"),
        "loaded_at",
    )


def stg_participants(participants: DataFrame, matches: DataFrame) -> DataFrame:
    """raw.participants ⋈ stg_matches → one row per participant (28 columns).

    ``matches`` is the staged match table; only ``match_id`` and
    ``duration_minutes`` are taken from it (column pruning reaches the scan).
    Per-minute rates divide by the *rounded* duration as the model does:
    ``x / (D/10)`` with ``D = duration_minutes × 10`` is ``10·x / D``.

    Two projection layers: first the exact rounded values as scaled longs,
    then decimals and labels from those longs.  Each rounded value is
    computed once (the CS rating reads the rounded rate), and each layer's
    generated code stays small enough for the JIT compiler.  18 digits hold any
    of them, and are kept and stored as a long.
    """
    p = participants.filter(
        (F.col("kills") >= 0) & (F.col("deaths") >= 0) & (F.col("assists") >= 0)
        & F.col("champion_name").isNotNull())
    m = matches.select("match_id", unscaled("duration_minutes", 1).alias("_dur10"))
    j = p.join(m, "match_id", "inner")

    takedowns = F.col("kills") + F.col("assists")
    dur10 = nullif_zero("_dur10")

    def per_minute(c, scale):
        # round(x / (D/10), scale) = round(10^(scale+1)·x / D) / 10^scale
        return half_up_quotient(F.col(c).cast("long") * (10 ** (scale + 1)), dur10,
                                wide=False)

    scaled = j.select(
        "*",
        F.when(F.col("deaths") == 0, takedowns.cast("long") * 100)
         .otherwise(half_up_quotient(takedowns.cast("long") * 100, "deaths", wide=False))
         .alias("_kda100"),
        per_minute("cs", 1).alias("_cs10"),
        per_minute("vision_score", 1).alias("_vision10"),
        per_minute("gold_earned", 0).alias("_gold_pm"),
        half_up_quotient(F.col("total_damage_dealt").cast("long") * 100,
                         "gold_earned", wide=False).alias("_dpg100"),
    )
    return scaled.select(
        F.col("id").alias("participant_id"),
        "match_id",
        "puuid",
        F.coalesce("summoner_name", F.lit("Unknown")).alias("summoner_name"),
        "champion_id",
        "champion_name",
        "team_id",
        C.team_side("team_id").alias("team_side"),
        F.coalesce("role", F.lit("UNKNOWN")).alias("role"),
        F.coalesce("lane", F.lit("UNKNOWN")).alias("lane"),
        C.standardized_role("role", "lane").alias("standardized_role"),
        "kills",
        "deaths",
        "assists",
        from_unscaled("_kda100", 2, precision=18).alias("kda"),
        C.kda_rating("kills", "deaths", "assists").alias("kda_rating"),
        "gold_earned",
        F.col("total_damage_dealt").alias("damage_dealt"),
        F.col("total_damage_taken").alias("damage_taken"),
        F.col("cs").alias("total_cs"),
        from_unscaled("_cs10", 1, precision=18).alias("cs_per_min"),
        C.cs_rating("_cs10", scale=1).alias("cs_rating"),
        "vision_score",
        from_unscaled("_vision10", 1, precision=18).alias("vision_per_min"),
        "win",
        from_unscaled("_gold_pm", 0, precision=18).alias("gold_per_min"),
        from_unscaled("_dpg100", 2, precision=18).alias("damage_per_gold"),
        "loaded_at",
    )
