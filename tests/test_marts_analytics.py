import datetime as dt
from decimal import Decimal

from arenalytics.functions import classify as C
from arenalytics.plans import analytics, marts
from arenalytics.plans.staging import stg_matches, stg_participants
from helpers import T0, match, matches_df, participant, participants_df

AS_OF = dt.date(2024, 3, 10)


def _stg(spark, parts, matches):
    m = stg_matches(matches_df(spark, matches))
    return m, stg_participants(participants_df(spark, parts), m)


def test_win_rate_exact_and_null_win_is_loss(spark):
    # 5 wins of 11 → 45.45 (a double-rounded average would give 45.46)
    parts = [participant(i, f"m{i}", champ="A", win=(i < 5)) for i in range(11)]
    # NULL win: counted in the denominator, not as a win
    parts += [participant(100 + i, f"m{i}", champ="B", puuid=f"q{i}", win=w)
              for i, w in enumerate([True, None, False, True])]
    matches = [match(f"m{i}") for i in range(11)]
    _, sp = _stg(spark, parts, matches)
    out = {r.champion_name: r for r in marts.dim_champions(sp).collect()}
    assert out["A"].win_rate == Decimal("45.45")
    assert out["A"].total_wins == 5 and out["A"].total_games == 11
    assert out["B"].win_rate == Decimal("50.00") and out["B"].total_wins == 2


def test_mode_tie_takes_smallest(spark):
    parts = [participant(1, "m1", champ="A", role="TOP", lane=""),
             participant(2, "m2", champ="A", role="MIDDLE", lane=""),
             participant(3, "m3", champ="A", role="UTILITY", lane=""),
             participant(4, "m4", champ="A", role="UTILITY", lane=""),
             participant(5, "m5", champ="A", role="MIDDLE", lane="")]
    _, sp = _stg(spark, parts, [match(f"m{i}") for i in range(1, 6)])
    r = marts.dim_champions(sp).first()
    assert r.most_played_role == "Mid"      # Mid 2, Support 2 → smaller name
    assert r.total_matches == 5 and r.unique_players == 1


def test_rounded_means(spark):
    parts = [participant(1, "m1", champ="A", k=1, d=1, a=0, cs=100),
             participant(2, "m2", champ="A", k=2, d=2, a=0, cs=101),
             participant(3, "m3", champ="A", k=2, d=3, a=0, cs=None)]
    _, sp = _stg(spark, parts, [match(f"m{i}", duration=1800) for i in range(1, 4)])
    r = marts.dim_champions(sp).first()
    assert r.avg_kills == Decimal("1.67")
    assert r.avg_deaths == Decimal("2.00")
    assert r.avg_kda == Decimal("0.89")      # (1.00 + 1.00 + 0.67) / 3 = 0.89
    assert r.avg_cs == Decimal("100.5")      # NULL cs ignored
    assert r.avg_cs_per_min == Decimal("3.4")  # (3.3 + 3.4) / 2 = 3.35 → 3.4


def test_fact_match_without_players(spark):
    parts = [participant(1, "m1", team=100, win=True, champ="A"),
             participant(2, "m1", team=100, win=True, champ="A", puuid="p2"),
             participant(3, "m1", team=200, win=False, champ="B", puuid="p3")]
    sm, sp = _stg(spark, parts, [match("m1"), match("m2")])
    out = {r.match_id: r for r in marts.fact_matches(sm, sp).collect()}
    assert out["m1"].total_players == 3 and out["m1"].blue_wins == 2
    assert out["m1"].red_wins == 0 and out["m1"].unique_champions == 2
    e = out["m2"]
    assert e.total_players == 1 and e.blue_wins == 0 and e.red_wins == 0
    assert e.unique_champions == 0 and e.avg_kills is None and e.total_cs is None


def test_champion_tiers(spark):
    cases = [(53, 50, "S"), (53, 49, "A"), (51, 30, "A"), (49, 20, "B"), (47, 10, "C"),
             (47, 9, "D"), (60, 9, "D"), (52.99, 100, "A")]
    df = spark.createDataFrame([(Decimal(str(w)), g) for w, g, _ in cases],
                               "w decimal(20,2), g long")
    got = [r.t for r in df.select(C.champion_tier("w", "g").alias("t")).collect()]
    assert got == [t for _, _, t in cases]


def test_tier_and_rank_columns(spark):
    rows = []
    pid = 0
    # champion → (games, wins)
    spec = {"S": (50, 27), "A1": (49, 26), "A2": (30, 16), "B": (20, 10), "C": (10, 5),
            "D1": (9, 9), "D2": (10, 4)}
    matches = []
    for champ, (games, wins) in spec.items():
        for g in range(games):
            pid += 1
            matches.append(match(f"{champ}-{g}"))
            rows.append(participant(pid, f"{champ}-{g}", champ=champ, win=g < wins,
                                    puuid=f"p{pid % 7}"))
    _, sp = _stg(spark, rows, matches)
    cs = analytics.champion_stats(marts.dim_champions(sp), sp, AS_OF)
    out = {r.champion_name: r for r in cs.collect()}
    assert {k: out[k].tier for k in spec} == {
        "S": "S", "A1": "A", "A2": "A", "B": "B", "C": "C", "D1": "D", "D2": "D"}
    assert out["D1"].winrate_rank == 1 and out["S"].popularity_rank == 1
    # ties in win rate share a rank: B and C are both 50.00
    assert out["B"].winrate_rank == out["C"].winrate_rank
    assert out["S"].calculated_at == dt.datetime(2024, 3, 10)
    total_matches = len(matches)
    assert out["S"].pick_rate == Decimal(50 * 100 / total_matches).quantize(Decimal("0.01"))


def test_skill_and_activity_boundaries(spark):
    df = spark.createDataFrame([(0.9, 7), (0.7, 8), (0.5, 30), (0.3, 31), (0.29, 0)],
                               "p double, d int")
    got = df.select(C.skill_tier("p").alias("s"), C.activity_status("d").alias("a")).collect()
    assert [r.s for r in got] == ["Elite", "Advanced", "Intermediate", "Beginner", "Learning"]
    assert [r.a for r in got] == ["Active", "Occasional", "Occasional", "Inactive", "Active"]


def test_player_performance_recent_and_days(spark):
    t = [T0, T0 - dt.timedelta(days=20), T0 - dt.timedelta(days=40)]
    parts = [participant(1, "m1", puuid="a", loaded_at=t[0]),
             participant(2, "m2", puuid="a", loaded_at=t[2]),
             participant(3, "m3", puuid="b", loaded_at=t[2])]
    _, sp = _stg(spark, parts, [match("m1"), match("m2"), match("m3")])
    pp = analytics.player_performance(marts.dim_summoners(sp), sp, AS_OF)
    players = marts.summoner_aggregates(sp, analytics.is_recent(AS_OF))
    in_one = analytics.player_performance(players, None, AS_OF)
    assert sorted(pp.collect()) == sorted(in_one.collect())
    out = {r.puuid: r for r in pp.collect()}
    assert out["a"].recent_games == 1 and out["b"].recent_games == 0
    assert out["a"].days_since_last_game == 9 and out["a"].activity_status == "Occasional"
    assert out["b"].days_since_last_game == 49 and out["b"].activity_status == "Inactive"


def _cs_rows(spark, rows):
    schema = ("champion_name string, win_rate decimal(20,2), total_games long, "
              "pick_rate decimal(20,2), avg_kda decimal(20,2), champion_id int")
    return spark.createDataFrame([r + (i,) for i, r in enumerate(rows)], schema)


def test_top_k_threshold_ties_and_empty(spark):
    rows = [(f"c{i:02d}", Decimal(50 + (i % 3)), 20 if i != 5 else 19,
             Decimal(i), Decimal("1.00")) for i in range(15)]
    cs = _cs_rows(spark, rows)
    top = analytics.meta_top_champions(cs).collect()
    assert len(top) == 10
    assert [r.position for r in top] == list(range(1, 11))
    assert all(r.champion != "c05" for r in top)         # 19 games excluded
    wr = [r.winrate for r in top]
    assert wr == sorted(wr, reverse=True)
    # ties at the cut are broken by name
    names52 = [r.champion for r in top if r.winrate == Decimal(52)]
    assert names52 == sorted(names52)
    meta = analytics.meta_analysis(_cs_rows(spark, [("x", Decimal(1), 3, Decimal(1),
                                                     Decimal("1.00"))]), AS_OF).first()
    assert meta.top_champions is None and meta.worst_champions is None
    assert len(meta.most_popular_champions) == 1
    js = analytics.meta_analysis_json(analytics.meta_analysis(cs, AS_OF)).first()
    assert js.top_champions.startswith('[{"champion":')


def test_role_distribution_unrounded(spark):
    schema = "most_played_role string, win_rate decimal(20,2)"
    cs = spark.createDataFrame([("Top", Decimal("50.01")), ("Top", Decimal("50.02")),
                                ("Top", Decimal("50.02")), ("Mid", Decimal("1.00"))], schema)
    out = {r.role: r for r in analytics.role_distribution(cs).collect()}
    assert out["Top"].champion_count == 3
    assert out["Top"].avg_role_winrate == 15005 / 300


def test_null_group_keys_are_one_group(spark):
    """NULL player ids / champion ids form their own group and still get
    their distinct counts and modes (the joins of the narrow aggregates are
    NULL-safe)."""
    parts = [participant(1, "m1", puuid=None, champ="A", champ_id=None),
             participant(2, "m2", puuid=None, champ="A", champ_id=None),
             participant(3, "m2", puuid=None, champ="B", champ_id=None),
             participant(4, "m3", puuid="x", champ="A", champ_id=1)]
    _, sp = _stg(spark, parts, [match("m1"), match("m2"), match("m3")])
    ds = {r.puuid: r for r in marts.summoner_aggregates(sp).collect()}
    assert ds[None].total_games == 3 and ds[None].total_matches == 2
    assert ds[None].unique_champions_played == 2 and ds[None].most_played_champion == "A"
    dc = {(r.champion_name, r.champion_id): r for r in marts.dim_champions(sp).collect()}
    assert dc[("A", None)].total_games == 2 and dc[("A", None)].total_matches == 2
    assert dc[("A", None)].unique_players == 0        # only NULL players
    assert dc[("A", 1)].unique_players == 1
