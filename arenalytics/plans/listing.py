"""Match load driven by player listings: tracked players → requests → tables.

One run:

1. **Players.**  Tracked (name, tag) pairs are looked up.  A player without an
   account, or without an answer to the listing, fails alone: it gets an error
   row, the others go on.
2. **Requests.**  Each player lists its newest ``n`` matches of a queue; the cap
   is applied before the shuffle.  A match listed by several players is one
   request with so many ``copies``.
3. **History.**  Requests already loaded are skipped (bucketed lookup,
   ``sources/history.py``).
4. **Documents.**  The rest meets the landed answers (outer join): without one,
   or with an empty one, the match is *missing*; a document that cannot be read
   is an *error* of that match alone; the others are *inserted*.
5. Participants, quarantine, player errors, outcomes and the statistics row are
   written to this run's partitions and, last, the matches, which commit it.

A listed match that several players share is inserted for the first of them
and then found in the table by the others, so its other copies count as
skipped; a missing or unreadable one is asked for again by each.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timeutil import ntz_literal
from ..operators import load as L
from ..operators.topn import latest_listed
from ..session import materialize, scratch_scope
from ..sources.adapter import raw_matches_from_orders
from ..sources.documents import responses_from_tables
from ..sources.lookups import DEFAULT_QUEUE_ID, MATCHES_PER_RUN
from ..sources.tables import read_table
from .examples import resolve_players
from .ingest import (
    commit_matches, loaded_match_ids, parse_once, sink_paths, _write_partition)

LISTING_RUN = "listing"

# What became of a tracked player, and of a request.
PROCESSED, UNKNOWN_PLAYER, NO_LISTING = "processed", "unknown player", "no listing"
SKIPPED, MISSING = "skipped", "missing"

COUNTERS = ["summoners_processed", "matches_found", "matches_inserted", "matches_skipped",
            "participants_inserted", "errors"]
MORE_COUNTERS = ["players_failed", "matches_missing"]


def look_up(tracked: DataFrame, accounts: DataFrame, answered: DataFrame) -> DataFrame:
    """(name, tag, entries, puuid, outcome) of every tracked pair; ``entries`` is
    how often the pair is tracked.  ``answered`` (puuid): players whose listing
    was answered, be it with no match."""
    pairs = tracked.select(F.col("name").cast("string").alias("name"), F.col("tag").cast("string").alias("tag")) \
                   .groupBy("name", "tag").agg(F.count(F.lit(1)).alias("entries"))
    found = resolve_players(pairs, accounts.dropDuplicates(["name", "tag"]))
    found = found.join(pairs, ["name", "tag"])
    listed = answered.select("puuid").distinct().withColumn("_listed", F.lit(True))
    outcome = (F.when(F.col("puuid").isNull(), UNKNOWN_PLAYER)
               .when(F.col("_listed").isNull(), NO_LISTING).otherwise(PROCESSED))
    return found.join(listed, "puuid", "left").select("name", "tag", "entries", "puuid", outcome.alias("outcome"))


def plan_requests(players: DataFrame, listings: DataFrame, n: int = MATCHES_PER_RUN,
                  queue_id: int | None = DEFAULT_QUEUE_ID) -> DataFrame:
    """(match_id, copies): the matches to ask for, and how many listings of
    processed players hold each.  ``listings``: (puuid, match_id, game_creation,
    queue_id)."""
    wanted = players.filter(F.col("outcome") == PROCESSED).groupBy("puuid").agg(F.sum("entries").alias("entries"))
    listed = latest_listed(listings.join(wanted.select("puuid"), "puuid", "left_semi"), n, queue_id)
    return listed.join(wanted, "puuid").groupBy("match_id").agg(F.sum("entries").alias("copies"))


def load_listed(spark: SparkSession, tracked: DataFrame, accounts: DataFrame, answered: DataFrame,
                listings: DataFrame, responses: DataFrame | Callable[[DataFrame], DataFrame],
                sink: str, batch_id: int,
                loaded_at: dt.datetime, n: int = MATCHES_PER_RUN,
                queue_id: int | None = DEFAULT_QUEUE_ID, run_id: str = LISTING_RUN) -> DataFrame:
    """One run; returns its statistics row.  ``responses``: (match_id, value),
    the landed answer of each match asked for; of several the smallest text.  Or
    a function that gives them for the ids (``match_id``) to ask for."""
    paths = sink_paths(sink) | {t: os.path.join(sink, t) for t in ("player_errors", "outcomes", "listing_stats")}
    loaded = ntz_literal(loaded_at)

    def write(df: DataFrame, table: str) -> None:
        _write_partition(df, paths[table], run_id, batch_id)

    with scratch_scope(spark, "listing-run"):
        players = materialize(look_up(tracked, accounts, answered), "listing-players")
        requests = materialize(plan_requests(players, listings, n, queue_id), "listing-requests")
        requests = materialize(L.tag_existing(requests, loaded_match_ids(spark, sink, run_id, batch_id)),
                               "listing-requests")
        asked = requests.filter(~F.col("_exists")).select("match_id", "copies")
        ids = asked.select("match_id")
        landed = responses if isinstance(responses, DataFrame) else responses(ids)
        answers = landed.join(ids, "match_id", "left_semi") \
            .groupBy("match_id").agg(F.min("value").alias("value"))
        parsed = parse_once(answers, "match_id")
        new = parsed.filter("status is null")

        status = parsed.select("match_id", "status", F.size("players").alias("players"))
        fate = (F.when(F.col("_exists"), SKIPPED)
                .when(F.col("players").isNull() & F.col("status").isNull(), MISSING)
                .when(F.col("status") == L.EMPTY, MISSING).when(F.col("status") == L.ERROR, L.ERROR)
                .otherwise(L.INSERTED))
        outcomes = materialize(requests.join(status, "match_id", "left").select(
            "match_id", "copies", fate.alias("outcome"),
            F.when(fate == L.INSERTED, F.col("players")).alias("participants")), "listing-outcomes")

        write(L.explode_participants(new, loaded), "participants")
        write(parsed.filter(F.col("status") == L.ERROR).select(
            "match_id", F.col("value").alias("document"), loaded.alias("loaded_at")), "quarantine")
        write(players.filter(F.col("outcome") != PROCESSED).select(
            "name", "tag", "entries", F.col("outcome").alias("error")), "player_errors")
        write(outcomes, "outcomes")
        write(listing_statistics(players, outcomes), "listing_stats")
        commit_matches(L.flatten_match(new, loaded), sink, run_id, batch_id)
    return spark.read.parquet(paths["listing_stats"]).filter(
        (F.col("run_id") == run_id) & (F.col("batch_id") == batch_id)).select(
        "batch_id", *COUNTERS, *MORE_COUNTERS)


def listing_statistics(players: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The six counters of a run, and the failed players and missing matches."""
    def copies(*fates: str):
        return F.sum(F.when(F.col("outcome").isin(*fates), F.col("copies")))

    inserted = F.count_if(F.col("outcome") == L.INSERTED)
    per_player = players.agg(F.struct(
        F.sum(F.when(F.col("outcome") == PROCESSED, F.col("entries"))).alias("processed"),
        F.sum(F.when(F.col("outcome") != PROCESSED, F.col("entries"))).alias("failed")).alias("p")).scalar()
    s = outcomes.agg(
        F.sum("copies").alias("found"), inserted.alias("inserted"),
        copies(SKIPPED).alias("existing"), copies(L.INSERTED).alias("listed"),
        F.sum("participants").alias("participants"),
        copies(L.ERROR).alias("unreadable"), copies(MISSING).alias("missing"))

    def n(c: str | Column) -> Column:
        return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0)).cast("long")

    failed = n(per_player["failed"])
    return s.select(
        n(per_player["processed"]).alias("summoners_processed"), n("found").alias("matches_found"),
        n("inserted").alias("matches_inserted"), (n("existing") + n("listed") - n("inserted")).alias("matches_skipped"),
        n("participants").alias("participants_inserted"), (n("unreadable") + failed).alias("errors"),
        failed.alias("players_failed"), n("missing").alias("matches_missing"))


# --- stand-in services for the registered queries ---------------------------

RUN1_BEFORE = dt.datetime(1998, 1, 1)        # the first run lists games before this date
RUN1_LOADED, RUN2_LOADED = dt.datetime(2001, 11, 5), dt.datetime(2001, 11, 6)
STAND_IN_CAP = 3                             # reached by many of the stand-in's players


def stand_in_services(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Tracked players, accounts, answered listings, listings and responses from
    the driver's tables.

    Every customer is tracked, one in ten twice; a fifth of the tags belongs to
    no account; one listing in seven is not answered.  A match is listed by its
    player and by the next player."""
    c = read_table(spark, sf_dir, "customer")
    orders = read_table(spark, sf_dir, "orders")
    key = F.col("c_custkey")
    tag = F.when(key % 5 == 0, F.col("c_nationkey") + 100).otherwise(F.col("c_nationkey"))
    tracked = c.select(F.col("c_name").alias("name"), tag.alias("tag"), F.explode(
        F.when(key % 10 == 1, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    listed = orders.select("o_orderkey", F.explode(F.array(
        F.col("o_custkey").cast("string"), (F.col("o_custkey") + 1).cast("string"))).alias("puuid"))
    matches = raw_matches_from_orders(orders).select("match_id", "game_creation", "queue_id")
    return {
        "tracked": tracked.select("name", "tag"),
        "accounts": c.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("tag"),
                             key.cast("string").alias("puuid")),
        "answered": c.filter(key % 7 != 0).select(key.cast("string").alias("puuid")),
        "listings": listed.select("puuid", F.col("o_orderkey").cast("string").alias("match_id"))
                          .join(matches, "match_id"),
        "responses": lambda asked: responses_from_tables(orders, read_table(spark, sf_dir, "lineitem"),
                                                         read_table(spark, sf_dir, "part"), asked)}


def run_two_listings(spark: SparkSession, sf_dir: str, sink: str) -> str:
    """A run over the games before RUN1_BEFORE, then one over all; returns the sink."""
    services = stand_in_services(spark, sf_dir)
    before = F.col("game_creation") < int(RUN1_BEFORE.replace(tzinfo=dt.timezone.utc).timestamp()) * 1000
    first = services | {"listings": services["listings"].filter(before)}
    load_listed(spark, **first, sink=sink, batch_id=1, loaded_at=RUN1_LOADED, n=STAND_IN_CAP)
    load_listed(spark, **services, sink=sink, batch_id=2, loaded_at=RUN2_LOADED, n=STAND_IN_CAP)
    return sink
