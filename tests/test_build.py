import datetime as dt

from arenalytics.plans import analytics, build, marts, registry, staging
from arenalytics.sources.adapter import load_raw
from arenalytics.sources.published import Published

from helpers import match, matches_df, participant, participants_df

SF = "/root/testdata/sf0.001"


def test_full_build_writes_every_layer(spark, tmp_dir):
    m, p = load_raw(spark, SF)
    paths = build.build_all(spark, m, p, f"{tmp_dir}/out", registry.AS_OF)
    assert set(paths) == {"stg_matches", "stg_participants", "fact_matches", "dim_champions",
                          "dim_summoners", "champion_stats", "player_performance",
                          "meta_analysis", "role_distribution"}
    cs = spark.read.parquet(paths["champion_stats"])
    ref = registry.Models(spark, SF).champion_stats()
    assert cs.count() == ref.count()
    games = [r.total_games for r in cs.collect()]
    assert games == sorted(games, reverse=True)
    meta = spark.read.parquet(paths["meta_analysis"]).first()
    assert meta.calculated_at == dt.datetime(2001, 11, 5)
    # match-grain tables are stored in date order: few files, disjoint date ranges
    import os
    from pyspark.sql import functions as F
    from arenalytics.plans.explain import plan_text
    files = [f for f in os.listdir(paths["fact_matches"]) if f.endswith(".parquet")]
    assert 0 < len(files) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    fact = spark.read.parquet(paths["fact_matches"])
    ranges = sorted(tuple(r)[1:] for r in fact.groupBy(F.input_file_name()).agg(
        F.min("game_date"), F.max("game_date")).collect())
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    text = plan_text(fact.filter(F.col("game_date") >= F.lit("2000-01-01").cast("date")))
    assert "GreaterThanOrEqual(game_date" in text
    assert fact.count() == registry.Models(spark, SF).fact_matches().count()
    # a re-run replaces the tables instead of appending
    build.build_all(spark, m, p, f"{tmp_dir}/out", registry.AS_OF)
    assert spark.read.parquet(paths["champion_stats"]).count() == ref.count()


def test_build_counts_matches_by_stored_marks(spark, tmp_dir):
    # players and champions that come twice in a match, NULL players and ids, a match without players
    rows = [("m1", "p1", 1, "Ahri"), ("m1", "p1", 1, "Ahri"), ("m1", "p2", 2, "Ahri"), ("m1", None, None, "Zed"),
            ("m2", "p1", 1, "Ahri"), ("m2", "p2", None, "Zed"), ("m2", "p2", None, "Zed"), ("m3", None, 2, "Zed"),
            ("m3", None, 2, "Zed"), ("m9", "p3", 2, "Zed")]
    raw_m = matches_df(spark, [match(m) for m in ("m1", "m2", "m3", "m4")])
    raw_p = participants_df(spark, [participant(i, m, puuid=u, champ_id=c, champ=n, k=i, win=i % 3 == 0)
                                    for i, (m, u, c, n) in enumerate(rows)])
    m = staging.stg_matches(raw_m)
    p = staging.stg_participants(raw_p, m)
    paths = build.build_all(spark, raw_m, raw_p, f"{tmp_dir}/out", registry.AS_OF)
    stored = spark.read.parquet(paths["stg_participants"])
    first = {c: sum(r[c] for r in stored.collect()) for c in stored.columns if c.startswith("_")}
    assert first == {"_first_of_match": 3, "_first_of_champion_name": 5, "_first_of_champion_name_champion_id": 6,
                     "_first_of_puuid": 6}

    def same(df, name):
        got = spark.read.parquet(paths[name])
        assert got.columns == df.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, df.collect()))

    same(marts.fact_matches(m, p), "fact_matches")
    same(marts.dim_champions(p), "dim_champions")
    same(marts.dim_summoners(p), "dim_summoners")
    same(analytics.champion_stats(marts.dim_champions(p), p, registry.AS_OF), "champion_stats")
    # no mart moves participants for a count of matches
    for df in (marts.fact_matches(m, stored), marts.dim_champions(stored, dealt=True),
               marts.summoner_aggregates(stored, dealt=True)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "match_id" in x
                    and ("champion_name" in x or "_key0" in x)]


def test_published_tables_come_without_the_marks(spark, tmp_dir):
    m, p = load_raw(spark, SF)
    build.refresh(spark, m, p, tmp_dir, registry.AS_OF)
    tables = Published(spark, tmp_dir)
    want = staging.stg_participants(p, staging.stg_matches(m))
    assert tables.read("stg_participants").columns == want.columns
    assert tables.read("stg_participants").count() == want.count()
    assert len(tables.read("dim_champions").columns) == len(marts.CHAMPION_COLUMNS)
