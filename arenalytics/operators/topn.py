"""Newest-N per group (the per-player match listing cap)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n_per_group(df: DataFrame, group: list[str], order: list[Column], n: int,
                    rank_col: str = "rn") -> DataFrame:
    """Rows with ``row_number() <= n`` per group in ``order``.

    Spark plans the filter on a row_number as a WindowGroupLimit: every task
    keeps at most n rows per group before the shuffle, so a player owning a
    third of all rows ships at most n rows per map task, not all of them.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def latest_matches_per_player(participants: DataFrame, matches: DataFrame,
                              n: int = 20, queue_id: int | None = 420) -> DataFrame:
    """Newest ``n`` match ids per player, optionally of one queue only (a
    falsy ``queue_id`` lists all queues).  Newest = highest game_creation;
    equal times are ordered by match id.

    A player listed twice in one match must count that match once: the rank
    is a ``dense_rank`` over (time, match id), so copies tie, and the cap runs
    as a WindowGroupLimit before the shuffle; the copies are dropped only in
    the ≤ n rows per player that survive (that de-duplication reuses the
    window's partitioning by player — no extra shuffle).
    """
    m = matches.select("match_id", "game_creation", "queue_id")
    if queue_id:
        m = m.filter(F.col("queue_id") == queue_id)
    return _newest(participants.select("puuid", "match_id").join(m, "match_id"), n)


def latest_listed(listings: DataFrame, n: int = 20, queue_id: int | None = 420) -> DataFrame:
    """The same from listings (puuid, match_id, game_creation, queue_id)."""
    return _newest(listings.filter(F.col("queue_id") == queue_id) if queue_id else listings, n)


def _newest(listed: DataFrame, n: int) -> DataFrame:
    w = Window.partitionBy("puuid").orderBy(F.col("game_creation").desc(),
                                            F.col("match_id").asc())
    top = listed.withColumn("rn", F.dense_rank().over(w)).filter(F.col("rn") <= n)
    return (top.dropDuplicates(["puuid", "match_id"])
               .select("puuid", "match_id", "game_creation", F.col("rn").cast("int")))
