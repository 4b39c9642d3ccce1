"""Small operators of the source project that are not part of the model chain:
the starter models, the smoke script's table operations, the player lookup
and JSON field access."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# --- starter models -------------------------------------------------------

def first_model(spark: SparkSession) -> DataFrame:
    """``SELECT 1 AS id UNION ALL SELECT NULL AS id`` (inline literal rows)."""
    one = spark.range(1).select(F.lit(1).cast("int").alias("id"))
    null = spark.range(1).select(F.lit(None).cast("int").alias("id"))
    return one.unionByName(null)


def second_model(first: DataFrame) -> DataFrame:
    """``SELECT * FROM first WHERE id = 1`` (NULL ids drop out)."""
    return first.filter(F.col("id") == 1)


# --- smoke-script operations ----------------------------------------------

def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) per table, one union of global counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def delete_by_key(df: DataFrame, column: str, value) -> DataFrame:
    """``DELETE … WHERE column = value`` as the rewrite keeping every other
    row (NULL keys are not equal to anything and stay)."""
    c = F.col(column)
    return df.filter(c.isNull() | (c != F.lit(value)))


# --- player lookup ---------------------------------------------------------

def resolve_players(tracked: DataFrame, accounts: DataFrame) -> DataFrame:
    """Tracked (name, tag) → puuid; unresolved players keep a NULL puuid.

    Tags arrive as numbers or text, so both sides compare as strings.
    """
    t = tracked.select(F.col("name").cast("string").alias("name"),
                       F.col("tag").cast("string").alias("tag"))
    a = accounts.select(F.col("name").cast("string").alias("name"),
                        F.col("tag").cast("string").alias("tag"), "puuid")
    return a.join(t, ["name", "tag"], "right").select("name", "tag", "puuid")


def unresolved_players(resolved: DataFrame) -> DataFrame:
    """Players whose lookup failed (the source raises 'not found' for each)."""
    return resolved.filter(F.col("puuid").isNull())


# --- JSON field access -----------------------------------------------------

def flatten_event_props(events: DataFrame) -> DataFrame:
    """``events.props`` (a JSON object text) → its field ``k`` as a column."""
    return events.select("event_id",
                         F.from_json("props", "k INT").getField("k").alias("k"))
