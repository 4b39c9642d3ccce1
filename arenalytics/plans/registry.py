"""Registered queries: name → (spark, sf_dir) → DataFrame.

Each query reads the driver tables of ``sf_dir`` through the stand-in adapter
and runs the library's own models on them.  The output boundary
(``oracle_types``) only changes representation: exact decimals leave as
DOUBLE and the zone-aware game timestamp as TIMESTAMP_NTZ, the forms the
DuckDB oracle produces.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, TimestampType

from ..functions.timeutil import ntz_literal
from ..operators import quality as Q
from ..operators import sketches as S
from ..operators.load import insert_if_absent
from ..operators.topn import latest_matches_per_player
from ..session import remove_folder, scratch_path
from ..sources import lookups
from ..sources.adapter import load_raw
from ..sources.file_table import FileTable
from ..sources.published import Published
from ..sources.tables import read_table, register_view, write_layer
from ..streaming.incremental import run_incremental_stream
from . import analytics, build, examples, ingest, listing, marts, staging

# Fixed 'now' for reproducible reports: the day after the newest load
# timestamp of the driver tables (max l_shipdate is 2001-11-04).
AS_OF = dt.date(2001, 11, 5)


def oracle_types(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


class Models:
    """Lazily built model chain for one (session, sf_dir).

    Each query starts at the raw tables, and each aggregate of a mart is a scan
    of its own columns.  The full refresh, ``plans/build.py``, stores the staging
    table and every mart reads the stored copy.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, buckets: int | None = None):
        self.spark, self.sf_dir = spark, sf_dir
        self.buckets = buckets
        self.raw_matches, self.raw_participants = load_raw(spark, sf_dir)

    @property
    def stg_matches(self) -> DataFrame:
        return staging.stg_matches(self.raw_matches)

    @property
    def stg_participants(self) -> DataFrame:
        return staging.stg_participants(self.raw_participants, self.stg_matches)

    @property
    def dealt_participants(self) -> DataFrame:
        """The staged participants for the marts: dealt by match at every size, so
        that what they move grows with the input and matches are counted in place."""
        _, participants = load_raw(self.spark, self.sf_dir, dealt=True)
        return staging.stg_participants(participants, self.stg_matches.hint("merge"))

    def fact_matches(self) -> DataFrame:
        return marts.fact_matches(self.stg_matches, self.stg_participants)

    def dim_champions(self) -> DataFrame:
        return self._dealt_champions().drop("_first_of_match")

    def _dealt_champions(self) -> DataFrame:
        return marts.dim_champions(self.dealt_participants, dealt=True)

    def dim_summoners(self) -> DataFrame:
        return marts.dim_summoners(self.dealt_participants, buckets=self.buckets, dealt=True)

    def champion_stats(self) -> DataFrame:
        return analytics.champion_stats(self._dealt_champions(), None, AS_OF, buckets=self.buckets)

    def player_performance(self) -> DataFrame:
        players = marts.summoner_aggregates(self.dealt_participants, analytics.is_recent(AS_OF), dealt=True)
        return analytics.player_performance(players, None, AS_OF, buckets=self.buckets)


def _q(build: Callable[[Models], DataFrame], **model_opts):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return oracle_types(build(Models(spark, sf_dir, **model_opts)))
    run.__doc__ = build.__doc__
    return run


# Ranking with few buckets: ties and NULL-free runs cross
# bucket borders even on small data, so the oracle checks the offset logic.
DISTRIBUTED = {"buckets": 7}


def _rank_winrate(m: Models) -> DataFrame:
    """RANK() over win rate and over games, distributed form."""
    return m.champion_stats().select("champion_name", "champion_id",
                                     "winrate_rank", "popularity_rank")


def _percent_rank_kda(m: Models) -> DataFrame:
    """PERCENT_RANK() over unrounded mean KDA and win ratio, distributed."""
    return m.dim_summoners().select("puuid", "kda_percentile", "winrate_percentile")


def _ntile_kda(m: Models) -> DataFrame:
    """NTILE(10) over rounded mean KDA and win rate, distributed."""
    return m.player_performance().select("puuid", "kda_decile", "winrate_decile")


def _mode_role(m: Models) -> DataFrame:
    """MODE() WITHIN GROUP (ORDER BY standardized_role) per champion."""
    from ..operators.mode import mode_by
    return mode_by(m.stg_participants, marts.CHAMPION_KEYS, "standardized_role",
                   "most_played_role")


def _meta_analysis(m: Models) -> DataFrame:
    """The one-row meta report, its lists as JSON text."""
    return analytics.meta_analysis_json(analytics.meta_analysis(m.champion_stats(), AS_OF))


def _meta_analysis_small_samples(m: Models) -> DataFrame:
    """The same report over champions under the sample size: no champion
    qualifies for the best and worst lists, which are NULL then."""
    cs = m.champion_stats().filter(F.col("total_games") < analytics.MIN_GAMES_FOR_RANKING)
    return analytics.meta_analysis_json(analytics.meta_analysis(cs, AS_OF))


# --- loading ---------------------------------------------------------------

def _incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping batches of match documents (with repeats, empty and
    malformed lines) loaded insert-if-absent; the resulting raw.matches."""
    sink = ingest.run_two_batches(spark, sf_dir, scratch_path(spark, "ingest"))
    return ingest.read_sink(spark, sink, "matches").drop("run_id", "batch_id")


def _explode_participants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw.participants after the two-batch load (participant arrays
    exploded only for newly inserted matches)."""
    sink = ingest.run_two_batches(spark, sf_dir, scratch_path(spark, "ingest"))
    return ingest.read_sink(spark, sink, "participants").drop("run_id", "batch_id")


def _load_inserted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys that the second (overlapping) batch really inserted."""
    sink = ingest.run_two_batches(spark, sf_dir, scratch_path(spark, "ingest"))
    return ingest.inserted_match_ids(spark, sink, 2)


def _listing_sink(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    sink = listing.run_two_listings(spark, sf_dir, scratch_path(spark, "listing"))
    return spark.read.parquet(f"{sink}/{table}").drop("run_id") \
                .withColumn("batch_id", F.col("batch_id").cast("long"))


def _listing_load_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters of two runs driven by tracked players' listings."""
    return _listing_sink(spark, sf_dir, "listing_stats")


def _listing_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every requested match of both runs."""
    return _listing_sink(spark, sf_dir, "outcomes")


def _listing_player_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracked players that failed alone, with the reason."""
    return _listing_sink(spark, sf_dir, "player_errors")


def _player_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracked (name, tag) pairs resolved to player ids; a fifth of the tags
    belongs to no account and stays unresolved."""
    c = read_table(spark, sf_dir, "customer")
    accounts = c.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("tag"),
                        F.col("c_custkey").cast("string").alias("puuid"))
    tag = F.when(F.col("c_custkey") % 5 == 0, F.col("c_nationkey") + 100).otherwise(F.col("c_nationkey"))
    return examples.resolve_players(c.select(F.col("c_name").alias("name"), tag.alias("tag")), accounts)


def _sink_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """stg_matches through the view sink and the table sink, read back."""
    path = scratch_path(spark, "sink-round-trip")
    register_view(Models(spark, sf_dir).stg_matches, "stg_matches_view")
    write_layer(spark.table("stg_matches_view"), path)
    return oracle_types(spark.read.parquet(path))


def _stored_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A published full refresh: the place of every row of the two reports that
    are stored in order of games."""
    root = scratch_path(spark, "published")
    build.refresh(spark, *load_raw(spark, sf_dir, dealt=True), root, AS_OF)
    tables = Published(spark, root)
    reports = [("champion_stats", "champion_name"), ("player_performance", "puuid")]
    return Q.union_all([
        build.in_stored_order(tables.read(t), ["total_games", key]).select(
            F.lit(t).alias("report"), "position", F.col(key).alias("name"), "total_games")
        for t, key in reports])


def _delete_by_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``DELETE … WHERE queue_id = 420`` on stored matches: only the files that
    hold the key are rewritten."""
    stored = FileTable(spark, scratch_path(spark, "delete"))
    stored.write(Models(spark, sf_dir).stg_matches, cluster_by=["queue_id", "match_id"])
    stored.delete(F.col("queue_id") == 420)
    return stored.read()


def _approx_unique_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players per champion from the stored sketches of two batches, beside the
    exact count: whether the estimate is within five standard errors (or one)."""
    p = Models(spark, sf_dir).stg_participants
    split = F.col("loaded_at") < F.lit("1997-01-01").cast("timestamp_ntz")
    batches = []
    for batch in (p.filter(split), p.filter(~split)):
        path = scratch_path(spark, "sketches")
        write_layer(S.distinct_sketches(batch, marts.CHAMPION_KEYS, "puuid"), path)
        batches.append(spark.read.parquet(path))
    merged = S.estimates(S.merge_sketches(batches, marts.CHAMPION_KEYS), "estimate")
    exact = marts.dim_champions(p).select(*marts.CHAMPION_KEYS, "unique_players")
    off = F.abs(F.col("estimate") - F.col("unique_players"))
    return marts.join_null_safe(exact, merged, marts.CHAMPION_KEYS).select(
        *marts.CHAMPION_KEYS, "unique_players",
        (off <= F.greatest(F.lit(1.0), F.col("unique_players") * (5 * S.standard_error()))).alias("within_bound"))


def _load_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load statistics of both batches."""
    sink = ingest.run_two_batches(spark, sf_dir, scratch_path(spark, "ingest"))
    return ingest.read_sink(spark, sink, "load_stats").select(*ingest.STATS_COLUMNS)


STREAM_LOADED = dt.datetime(2001, 11, 7)


def _stream_incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same landing folders consumed by a Structured Streaming query
    (availableNow, sixteen files per micro-batch, foreachBatch loader)."""
    root = scratch_path(spark, "stream")
    ingest.write_stand_in_landing(spark, sf_dir, f"{root}/landing")
    sink = f"{root}/sink"
    run_incremental_stream(spark, f"{root}/landing/*", sink, f"{root}/checkpoint",
                           STREAM_LOADED, max_files_per_trigger=16)
    remove_folder(spark, f"{root}/landing")     # stand-ins, all loaded
    return ingest.read_sink(spark, sink, "matches").drop("run_id", "batch_id")


ANTI_JOIN_NEW_FROM = dt.datetime(1997, 1, 1)
ANTI_JOIN_EXISTING_BEFORE = dt.datetime(1998, 1, 1)


def _anti_join_new_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Insert-if-absent: matches of a new batch not already stored."""
    matches, _ = load_raw(spark, sf_dir)
    ts = F.col("loaded_at")
    new = matches.filter(ts >= ntz_literal(ANTI_JOIN_NEW_FROM))
    existing = matches.filter(ts < ntz_literal(ANTI_JOIN_EXISTING_BEFORE))
    return insert_if_absent(new, existing).drop("raw_data")


def _latest_n_per_player(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest 20 ranked solo/duo matches per player."""
    matches, participants = load_raw(spark, sf_dir)
    return latest_matches_per_player(participants, matches,
                                     n=lookups.MATCHES_PER_RUN,
                                     queue_id=lookups.DEFAULT_QUEUE_ID)


def _json_flatten_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON object field access on ``events.props``."""
    return examples.flatten_event_props(read_table(spark, sf_dir, "events"))


def _queue_lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged matches per queue label via the broadcast queue lookup."""
    m = Models(spark, sf_dir).stg_matches
    return (lookups.label_queues(m).groupBy("queue_label")
            .agg(F.count(F.lit(1)).alias("matches")))


def _platform_routing_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged matches per routing / region via the exploded routing map."""
    m = Models(spark, sf_dir).stg_matches
    return (lookups.with_routing(m, "region")
            .groupBy("routing", "region", "region_name")
            .agg(F.count(F.lit(1)).alias("matches")))


def _table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of the raw tables."""
    matches, participants = load_raw(spark, sf_dir)
    return examples.table_row_counts({"matches": matches, "participants": participants})


# --- data-quality checks (one row per check instance) ----------------------

def _dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Models(spark, sf_dir)
    return Q.union_all([
        Q.unique_failures(m.raw_matches, "raw_matches.match_id", ["match_id"]),
        Q.unique_failures(m.stg_matches, "stg_matches.match_id", ["match_id"]),
        Q.unique_failures(m.dim_champions(), "dim_champions.champion_name", ["champion_name"]),
        Q.unique_failures(marts.summoner_aggregates(m.stg_participants), "dim_summoners.puuid", ["puuid"]),
    ])


def _dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All null checks: one scan per table."""
    m = Models(spark, sf_dir)

    def nulls(df: DataFrame, table: str, *columns: str) -> DataFrame:
        return Q.count_failures(df, {f"{table}.{c}": Q.null_counter(c) for c in columns})

    return Q.union_all([
        nulls(m.raw_matches, "raw_matches", "match_id", "game_creation", "game_duration"),
        nulls(m.raw_participants, "raw_participants", "match_id", "champion_name"),
        nulls(m.stg_matches, "stg_matches", "match_id", "duration_seconds"),
        nulls(m.stg_participants, "stg_participants", "kills", "deaths", "kda"),
        nulls(m.dim_champions(), "dim_champions", "champion_name"),
        nulls(m.fact_matches(), "fact_matches", "match_id"),
    ])


def _dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Models(spark, sf_dir)
    return Q.summarize([
        Q.Check("raw_participants.match_id->raw_matches",
                Q.relationships(m.raw_participants, "match_id", m.raw_matches, "match_id")),
        Q.Check("raw_participants.match_id->stg_matches",
                Q.relationships(m.raw_participants, "match_id", m.stg_matches, "match_id")),
    ])


def _dq_accepted_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All range checks: one scan per table."""
    m = Models(spark, sf_dir)
    return Q.union_all([
        Q.count_failures(m.stg_matches, {
            "stg_matches.duration_seconds": Q.range_counter("duration_seconds", 60, 10800)}),
        Q.count_failures(m.stg_participants, {
            f"stg_participants.{c}": Q.range_counter(c, 0, 100) for c in ("kills", "deaths")}),
    ])


def _dq_unique_combination(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = Models(spark, sf_dir)
    return Q.summarize([
        Q.Check("stg_matches(match_id)", Q.unique_combination(m.stg_matches, ["match_id"])),
        Q.Check("stg_participants(match_id,puuid)",
                Q.unique_combination(m.stg_participants, ["match_id", "puuid"])),
    ])


def _direct(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return oracle_types(fn(spark, sf_dir))
    run.__doc__ = fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "stg_matches": _q(lambda m: m.stg_matches),
        "stg_participants": _q(lambda m: m.stg_participants),
        "fact_matches": _q(lambda m: m.fact_matches()),
        "dim_champions": _q(lambda m: m.dim_champions()),
        "dim_summoners": _q(lambda m: m.dim_summoners()),
        "champion_stats": _q(lambda m: m.champion_stats()),
        "player_performance": _q(lambda m: m.player_performance()),
        "meta_top_champions": _q(lambda m: analytics.meta_top_champions(m.champion_stats())),
        "meta_worst_champions": _q(lambda m: analytics.meta_worst_champions(m.champion_stats())),
        "meta_most_popular": _q(lambda m: analytics.meta_most_popular(m.champion_stats())),
        "meta_global_stats": _q(lambda m: analytics.meta_global_stats(m.champion_stats(), AS_OF)),
        "delete_by_queue": _direct(_delete_by_queue),
        "approx_unique_players": _direct(_approx_unique_players),
        "run_variables": _q(lambda m: lookups.apply_run_vars(m.stg_matches, "1997-01-01", [420, 440])),
        "meta_analysis": _q(_meta_analysis),
        "meta_analysis_small_samples": _q(_meta_analysis_small_samples),
        "role_distribution": _q(lambda m: analytics.role_distribution(m.champion_stats())),
        "rank_winrate": _q(_rank_winrate, **DISTRIBUTED),
        "percent_rank_kda": _q(_percent_rank_kda, **DISTRIBUTED),
        "ntile_kda": _q(_ntile_kda, **DISTRIBUTED),
        "mode_role": _q(_mode_role),
        "incremental_load": _direct(_incremental_load),
        "explode_participants": _direct(_explode_participants),
        "load_stats": _direct(_load_stats),
        "load_inserted_ids": _direct(_load_inserted_ids),
        "listing_load_stats": _direct(_listing_load_stats),
        "listing_outcomes": _direct(_listing_outcomes),
        "listing_player_errors": _direct(_listing_player_errors),
        "player_lookup": _direct(_player_lookup),
        "sink_round_trip": _direct(_sink_round_trip),
        "stored_order": _direct(_stored_order),
        "stream_incremental_load": _direct(_stream_incremental_load),
        "anti_join_new_matches": _direct(_anti_join_new_matches),
        "latest_n_per_player": _direct(_latest_n_per_player),
        "json_flatten_events": _direct(_json_flatten_events),
        "queue_lookup_join": _direct(_queue_lookup_join),
        "platform_routing_explode": _direct(_platform_routing_explode),
        "table_row_counts": _direct(_table_row_counts),
        "dq_unique": _direct(_dq_unique),
        "dq_not_null": _direct(_dq_not_null),
        "dq_relationships": _direct(_dq_relationships),
        "dq_accepted_range": _direct(_dq_accepted_range),
        "dq_unique_combination": _direct(_dq_unique_combination),
    }
