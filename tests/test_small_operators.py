from pyspark.sql import functions as F

from arenalytics.operators import quality as Q
from arenalytics.operators.mode import mode_by
from arenalytics.operators.topn import latest_matches_per_player
from arenalytics.plans import examples
from arenalytics.plans.staging import stg_matches
from arenalytics.sources import lookups
from helpers import match, matches_df, participant, participants_df


def test_starter_models_and_their_tests(spark):
    first = examples.first_model(spark)
    assert sorted(r.id for r in first.collect() if r.id is not None) == [1]
    assert first.count() == 2
    second = examples.second_model(first)
    assert [r.id for r in second.collect()] == [1]
    # unique passes; not_null fails by design on the first model (id NULL)
    assert Q.unique(first, "id").count() == 0
    assert Q.not_null(first, "id").count() == 1
    assert Q.not_null(second, "id").count() == 0


def test_quality_checks(spark):
    df = spark.createDataFrame(
        [("a", "x", 5), ("a", "x", 150), ("b", None, -1), (None, None, None), (None, None, 7)],
        "k string, j string, v int")
    assert [r.k for r in Q.unique(df, "k").collect()] == ["a"]        # NULLs ignored
    assert Q.not_null(df, "k").count() == 2
    assert Q.accepted_range(df, "v", 0, 100).count() == 2              # NULL passes
    combos = {(r.k, r.j): r.n_records for r in Q.unique_combination(df, ["k", "j"]).collect()}
    assert combos == {("a", "x"): 2, (None, None): 2}                  # NULLs group
    parent = spark.createDataFrame([("a",)], "k string")
    orphans = Q.relationships(df, "k", parent, "k")
    assert sorted(r.k for r in orphans.collect()) == ["b"]
    summary = {r.check_name: r.failures for r in Q.summarize([
        Q.Check("u", Q.unique(df, "k")), Q.Check("n", Q.not_null(df, "k"))]).collect()}
    assert summary == {"u": 1, "n": 2}


def test_mode_by_ignores_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "b"), (2, None)], "k int, v string")
    out = {r.k: r.m for r in mode_by(df, ["k"], "v", "m").collect()}
    assert out == {1: "b"}


def test_table_counts_and_delete(spark):
    m = matches_df(spark, [match("a"), match("TEST_123"), match(None)])
    counts = {r.table_name: r.row_count for r in examples.table_row_counts({"m": m}).collect()}
    assert counts == {"m": 3}
    kept = examples.delete_by_key(m, "match_id", "TEST_123")
    assert sorted(str(r.match_id) for r in kept.collect()) == ["None", "a"]


def test_resolve_players(spark):
    tracked = spark.createDataFrame([("Alpha", "8555"), ("Beta", "EUW"), ("Gamma", "1")],
                                    "name string, tag string")
    accounts = spark.createDataFrame([("Alpha", 8555, "pa"), ("Beta", None, "pb"),
                                      ("Beta", "EUW", "pb2"), ("Zed", "1", "pz")],
                                     "name string, tag string, puuid string")
    out = {r.name: r.puuid for r in examples.resolve_players(tracked, accounts).collect()}
    assert out == {"Alpha": "pa", "Beta": "pb2", "Gamma": None}
    assert [r.name for r in examples.unresolved_players(
        examples.resolve_players(tracked, accounts)).collect()] == ["Gamma"]


def test_lookups(spark):
    m = stg_matches(matches_df(spark, [match("a", queue=420, platform="euw1"),
                                       match("b", queue=999, platform="jp1"),
                                       match("c", queue=None, platform="zz")]))
    lab = {r.match_id: r.queue_label for r in lookups.label_queues(m).collect()}
    assert lab == {"a": "Ranked Solo/Duo", "b": "Other", "c": "Other"}
    rt = {r.match_id: (r.routing, r.region_name)
          for r in lookups.with_routing(m, "region").collect()}
    assert rt == {"a": ("europe", "Europe West"), "b": ("asia", None), "c": (None, None)}
    assert lookups.apply_run_vars(m, start_date="2024-01-01").count() == 0
    assert lookups.apply_run_vars(m, queue_ids=lookups.RANKED_QUEUE_IDS).count() == 1


def test_event_props(spark):
    ev = spark.createDataFrame([(1, '{"k": 76}'), (2, "{}"), (3, None)],
                               "event_id long, props string")
    assert {r.event_id: r.k for r in examples.flatten_event_props(ev).collect()} == \
        {1: 76, 2: None, 3: None}


def test_latest_matches_per_player(spark):
    base = 1_700_000_000_000
    ms = [match(f"m{i}", creation=base + i * 1000, queue=420 if i % 4 else 440)
          for i in range(40)]
    ps = [participant(i, f"m{i}", puuid="hot") for i in range(40)]
    ps += [participant(100 + i, f"m{i}", puuid="cold") for i in range(3)]
    ps.append(participant(999, "m39", puuid="hot"))              # listed twice in a match
    out = latest_matches_per_player(participants_df(spark, ps), matches_df(spark, ms),
                                    n=20, queue_id=420).collect()
    hot = [r for r in out if r.puuid == "hot"]
    assert len(hot) == 20 and [r.rn for r in sorted(hot, key=lambda r: r.rn)] == list(range(1, 21))
    assert sorted(hot, key=lambda r: r.rn)[0].match_id == "m39"
    assert all(int(r.match_id[1:]) % 4 for r in hot)             # queue 440 excluded
    assert sorted(r.match_id for r in out if r.puuid == "cold") == ["m1", "m2"]
    all_q = latest_matches_per_player(participants_df(spark, ps), matches_df(spark, ms),
                                      n=5, queue_id=None)
    assert all_q.filter(F.col("puuid") == "cold").count() == 3


def test_window_group_limit_before_shuffle(spark):
    """The per-player cap is applied map-side before the shuffle."""
    from arenalytics.plans.explain import plan_text
    ms = matches_df(spark, [match(f"m{i}", creation=1_700_000_000_000 + i) for i in range(30)])
    ps = participants_df(spark, [participant(i, f"m{i}", puuid="p") for i in range(30)])
    text = plan_text(latest_matches_per_player(ps, ms, n=20))
    assert "WindowGroupLimit" in text


def test_mode_of_domain_matches_general_mode(spark):
    from arenalytics.operators.mode import mode_of_domain
    rows = [(1, "Mid"), (1, "ADC"), (1, "Mid"), (1, "ADC"), (1, "Top"),   # tie → ADC
            (2, "Top"), (2, None), (2, None),                              # NULLs ignored
            (3, None)]                                                     # only NULLs
    df = spark.createDataFrame(rows, "k int, v string")
    fixed = {r.k: r.m for r in df.groupBy("k").agg(
        mode_of_domain("v", ["Top", "Jungle", "Mid", "ADC", "Support", "Unknown"]).alias("m"))
        .collect()}
    general = {r.k: r.m for r in mode_by(df, ["k"], "v", "m").collect()}
    assert fixed == {1: "ADC", 2: "Top", 3: None}
    assert {k: v for k, v in fixed.items() if v is not None} == general


def test_counters_of_a_table_from_one_scan(spark, tmp_dir):
    from arenalytics.operators import quality as Q

    def scans(x):
        return x._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
    rows = [(1, 5, "a"), (1, None, None), (None, 101, "b"), (None, -1, "c"), (2, 0, None), (3, 7, "d"), (3, 8, "d")]
    path = f"{tmp_dir}/t"
    spark.createDataFrame(rows, "id int, v int, s string").write.parquet(path)
    df = spark.read.parquet(path)
    counters = {"id null": Q.null_counter("id"), "s null": Q.null_counter("s"), "v range": Q.range_counter("v", 0, 100)}
    out = Q.count_failures(df, counters)
    want = {"id null": Q.not_null(df, "id").count(), "s null": Q.not_null(df, "s").count(),
            "v range": Q.accepted_range(df, "v", 0, 100).count()}
    assert {r.check_name: r.failures for r in out.collect()} == want == {"id null": 2, "s null": 2, "v range": 2}
    assert scans(out) == 1
    both = Q.unique_failures(df, "unique", ["id"], counters=counters)
    assert {r.check_name: r.failures for r in both.collect()} == want | {"unique": Q.unique(df, "id").count()}
    assert scans(both) == 1
    with_nulls = Q.unique_failures(df, "unique", ["id"], nulls=True).first().failures
    assert with_nulls == Q.unique_combination(df, ["id"]).count() == 3
    empty = Q.unique_failures(df.limit(0), "unique", ["id"], counters=counters)
    assert {r.failures for r in empty.collect()} == {0}
    observed, seen = Q.counting(df, counters)
    observed.write.parquet(f"{tmp_dir}/copy")
    assert seen.get == want
