"""One full model run (the daily refresh): staging → marts → analytics.

Staging is computed once and written (it has five consumers; recomputing its
scan + join per consumer would multiply the heaviest work), then every mart
and report reads the stored table.  ``refresh`` writes all of them to a new
version and publishes it at the end (``sources/published.py``): readers see the
old tables or the new ones, never a mixture, and a failed run leaves the old.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.published import Published
from ..sources.tables import write_layer
from . import analytics, marts, staging


def build_all(spark: SparkSession, raw_matches: DataFrame, raw_participants: DataFrame,
              out_dir: str, as_of) -> dict[str, str]:
    """Write every dataset below ``out_dir``; returns name → path."""
    paths: dict[str, str] = {}

    def put(name: str, df: DataFrame, by_date: bool = False) -> DataFrame:
        path = os.path.join(out_dir, name)
        if by_date:
            write_layer(df, path, cluster_by=["game_date", "match_id"])
        else:
            write_layer(df, path)
        paths[name] = path
        return spark.read.parquet(path)

    # match-grain tables are stored in the order of game date: date-bounded
    # reads (e.g. the project's start-date variable) skip files and row groups
    # by their statistics, without a folder per day
    sm = put("stg_matches", staging.stg_matches(raw_matches), by_date=True)
    # participants are stored with marks (``_first_of_...``), taken while they are
    # dealt by match: every distinct count over matches reads them in place
    sp = put("stg_participants", marts.with_match_marks(
        staging.stg_participants(raw_participants, sm.hint("merge"))))
    put("fact_matches", marts.fact_matches(sm, sp), by_date=True)
    dc = put("dim_champions", marts.dim_champions(sp, dealt=True).drop("_first_of_match"))
    ds = put("dim_summoners", marts.dim_summoners(sp, dealt=True))
    # the two reports are stored ordered by games played (a distributed range
    # sort; readers scanning the files in order see the report order)
    by_games = [F.col("total_games").desc(), F.col("champion_name").asc()]
    cs = put("champion_stats", analytics.champion_stats(dc, sp, as_of)
             .orderBy(*by_games))
    put("player_performance",
        analytics.player_performance(ds, sp, as_of)
        .orderBy(F.col("total_games").desc(), F.col("puuid").asc()))
    put("meta_analysis", analytics.meta_analysis_json(analytics.meta_analysis(cs, as_of)))
    put("role_distribution", analytics.role_distribution(cs))
    return paths


def refresh(spark: SparkSession, raw_matches: DataFrame, raw_participants: DataFrame,
            root: str, as_of) -> dict[str, str]:
    """A full refresh below ``root``, visible when all of it is written;
    returns name → path of the version now published."""
    published = Published(spark, root)
    version = published.new_version()
    paths = build_all(spark, raw_matches, raw_participants, version, as_of)
    published.publish(version)
    return paths


def in_stored_order(stored: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of a stored table with ``position``, their place in it (files in
    the order of their names, rows as they stand).  The writer numbers its part
    files by the range of its order, so a reader who goes through the files
    meets the rows in that order.

    The row number inside a file comes from the scan; only the row counts per
    file are summed up over the files."""
    where = stored.select(*columns, F.col("_metadata.file_name").alias("_file"),
                          F.col("_metadata.row_index").alias("_at"))
    files = where.groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    return where.join(files, "_file").select(
        (F.col("_before") + F.col("_at") + 1).alias("position"), *columns)
