"""The listing-driven load on hand-made players, listings and answers."""

import datetime as dt

from arenalytics.plans import ingest, listing

from test_ingest import _doc, _p

LOADED = dt.datetime(2024, 5, 1)


def services(spark, responses, listings, answered=("u1", "u2", "u4")):
    return {
        "tracked": spark.createDataFrame(
            [("Ann", "EUW"), ("Bob", "8555"), ("Nobody", "EUW"), ("Silent", "EUW"), ("Idle", "EUW"), ("Ann", "EUW")],
            "name string, tag string"),
        "accounts": spark.createDataFrame(
            [("Ann", "EUW", "u1"), ("Bob", "8555", "u2"), ("Silent", "EUW", "u3"), ("Idle", "EUW", "u4")],
            "name string, tag string, puuid string"),
        "answered": spark.createDataFrame([(a,) for a in answered], "puuid string"),
        "listings": spark.createDataFrame(listings, "puuid string, match_id string, game_creation long, queue_id int"),
        "responses": spark.createDataFrame(responses, "match_id string, value string")}


LISTINGS = [("u1", "A", 9, 420), ("u1", "B", 8, 420), ("u1", "C", 7, 420), ("u1", "old", 1, 420),
            ("u1", "other queue", 10, 400), ("u2", "A", 9, 420), ("u2", "D", 6, 420), ("u2", "E", 5, 420),
            ("u3", "never asked", 9, 420), ("stranger", "X", 9, 420)]
RESPONSES = [("A", _doc("A", [_p("u1"), _p("u2")])), ("B", "{}"), ("D", '{"info": {'),
             ("E", _doc("E", [_p("u2", kills=...)])), ("X", _doc("X", [])), ("old", _doc("old", []))]


def load(spark, sink, batch, listings=LISTINGS, responses=RESPONSES, **kw):
    return listing.load_listed(spark, **services(spark, responses, listings), sink=sink,
                               batch_id=batch, loaded_at=LOADED, n=3, **kw).first().asDict()


def test_counters_and_isolation(spark, tmp_dir):
    sink = f"{tmp_dir}/sink"
    # Ann is tracked twice, Nobody has no account, Silent's listing is not answered
    assert load(spark, sink, 1) == {
        "batch_id": 1, "summoners_processed": 4, "matches_found": 9, "matches_inserted": 1,
        "matches_skipped": 2, "participants_inserted": 2, "errors": 2 + 2, "players_failed": 2,
        "matches_missing": 4}
    assert [r.match_id for r in ingest.read_sink(spark, sink, "matches").collect()] == ["A"]
    assert sorted(r.match_id for r in ingest.read_sink(spark, sink, "quarantine").collect()) == ["D", "E"]
    errors = {r.name: r.error for r in spark.read.parquet(f"{sink}/player_errors").collect()}
    assert errors == {"Nobody": "unknown player", "Silent": "no listing"}
    fate = {r.match_id: (r.copies, r.outcome) for r in spark.read.parquet(f"{sink}/outcomes").collect()}
    assert fate == {"A": (3, "inserted"), "B": (2, "missing"), "C": (2, "missing"), "D": (1, "error"), "E": (1, "error")}


def test_next_run_skips_what_is_loaded_and_asks_again_for_the_rest(spark, tmp_dir):
    sink = f"{tmp_dir}/sink"
    load(spark, sink, 1)
    mended = [r for r in RESPONSES if r[0] != "D"] + [("C", _doc("other id", [_p("u1")])), ("D", _doc("D", []))]
    s = load(spark, sink, 2, responses=mended)
    assert (s["matches_found"], s["matches_inserted"], s["matches_skipped"], s["errors"],
            s["matches_missing"]) == (9, 2, 3 + 1, 1 + 2, 2)
    assert sorted(r.match_id for r in ingest.read_sink(spark, sink, "matches").collect()) == ["A", "C", "D"]
    again = load(spark, sink, 2, responses=mended)        # a replay rewrites the same rows
    assert again == s
    assert ingest.read_sink(spark, sink, "matches").count() == 3


def test_without_players_or_answers(spark, tmp_dir):
    nothing = services(spark, [], [], answered=("u9",))
    s = listing.load_listed(spark, **nothing, sink=f"{tmp_dir}/sink", batch_id=1, loaded_at=LOADED).first()
    assert (s.summoners_processed, s.matches_found, s.matches_inserted, s.errors) == (0, 0, 0, 6)


def test_all_queues_without_a_queue(spark, tmp_dir):
    s = load(spark, f"{tmp_dir}/sink", 1, queue_id=None)
    assert s["matches_found"] == 9                       # the cap of three still holds
    fate = {r.match_id for r in spark.read.parquet(f"{tmp_dir}/sink/outcomes").collect()}
    assert "other queue" in fate and "C" not in fate


def test_only_the_matches_to_ask_for_are_answered(spark, tmp_dir):
    seen = []

    def answer(asked):
        seen.append(sorted(r.match_id for r in asked.collect()))
        return spark.createDataFrame(RESPONSES, "match_id string, value string")

    sink = f"{tmp_dir}/sink"
    asking = services(spark, [], LISTINGS) | {"responses": answer}
    for batch in (1, 2):
        listing.load_listed(spark, **asking, sink=sink, batch_id=batch, loaded_at=LOADED, n=3)
    assert seen == [["A", "B", "C", "D", "E"], ["B", "C", "D", "E"]]
    fate = {r.match_id: r.outcome for r in spark.read.parquet(f"{sink}/outcomes").filter("batch_id = 1").collect()}
    assert fate == {"A": "inserted", "B": "missing", "C": "missing", "D": "error", "E": "error"}


def test_stand_in_answers_are_built_for_the_asked_only(spark):
    """The same rows as building all answers and choosing after, whatever the
    ids: unknown ones, no numbers, null, repeated orders, orders without lines."""
    from pyspark.sql import functions as F

    from arenalytics.sources.documents import responses_from_tables
    from test_text_in_place import tables

    orders, lines, part = tables(spark)
    orders = orders.union(orders.filter("o_orderkey = 2")).union(
        orders.limit(1).withColumn("o_orderkey", F.lit(None).cast("long")))
    asked = spark.createDataFrame([("2",), ("4",), ("02",), ("99",), ("x",), (None,)], "match_id string")
    every = responses_from_tables(orders, lines, part).join(asked, "match_id", "left_semi")
    some = responses_from_tables(orders, lines, part, asked)
    assert sorted(some.collect()) == sorted(every.collect())
    assert len(some.collect()) == 3
