"""Configuration lookup tables as small DataFrames.

The source declares three dictionaries (region code → name, routing → its
platforms, queue id → label).  Each becomes a tiny relation joined with
``broadcast`` — its size is fixed by the configuration, not by the data, so the
broadcast is bounded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.classify import QUEUE_LABELS, QUEUE_OTHER

# Fixed values of the source configuration (original order).
REGIONS = [
    ("euw1", "Europe West"),
    ("na1", "North America"),
    ("kr", "Korea"),
    ("br1", "Brazil"),
]
ROUTINGS = [
    ("europe", ["euw1", "eun1", "tr1", "ru"]),
    ("americas", ["na1", "br1", "la1", "la2"]),
    ("asia", ["kr", "jp1"]),
]
DEFAULT_REGION = "euw1"
DEFAULT_ROUTING = "europe"
MATCHES_PER_RUN = 20
DEFAULT_QUEUE_ID = 420
# Declared run variables of the model project (unused by its models).
START_DATE = "2024-01-01"
RANKED_QUEUE_IDS = [420, 440]


def regions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REGIONS, "region_code string, region_name string")


def routings(spark: SparkSession) -> DataFrame:
    """routing → array of platforms (the dictionary as declared)."""
    return spark.createDataFrame(ROUTINGS, "routing string, platforms array<string>")


def platform_routing(spark: SparkSession) -> DataFrame:
    """Inverted: one row per platform with its routing (``explode``)."""
    return routings(spark).select(F.explode("platforms").alias("platform"), "routing")


def queues(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(QUEUE_LABELS, "queue_id int, queue_label string")


def label_queues(matches: DataFrame, queue_col: str = "queue_id") -> DataFrame:
    """Broadcast lookup of the queue label; unknown or NULL ids → 'Other'."""
    q = queues(matches.sparkSession)
    return (matches.join(F.broadcast(q), matches[queue_col] == q["queue_id"], "left")
                   .drop(q["queue_id"])
                   .withColumn("queue_label", F.coalesce("queue_label", F.lit(QUEUE_OTHER))))


def with_routing(matches: DataFrame, platform_col: str = "platform_id") -> DataFrame:
    """Add routing and region name for each match's platform (broadcast
    lookups; platforms outside the configuration get NULLs)."""
    spark = matches.sparkSession
    pr = platform_routing(spark)
    rg = regions(spark)
    out = matches.join(F.broadcast(pr), matches[platform_col] == pr["platform"], "left") \
                 .drop("platform")
    return out.join(F.broadcast(rg), out[platform_col] == rg["region_code"], "left") \
              .drop("region_code")


def apply_run_vars(stg_matches: DataFrame, start_date: str | None = None,
                   queue_ids: list[int] | None = None) -> DataFrame:
    """Optional run filters of the model project (declared, off by default):
    games on/after ``start_date`` and/or in ``queue_ids``.  Both are plain
    predicates on staged columns and reach the Parquet scan."""
    out = stg_matches
    if start_date:
        out = out.filter(F.col("game_date") >= F.lit(start_date).cast("date"))
    if queue_ids:
        out = out.filter(F.col("queue_id").isin(list(queue_ids)))
    return out
