import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from arenalytics.functions.exact import half_up_quotient, round_ratio
from arenalytics.plans.explain import plan_summary
from arenalytics.plans.staging import stg_matches, stg_participants
from helpers import match, matches_df, participant, participants_df


def test_round_ratio_half_away_from_zero(spark):
    df = spark.createDataFrame(
        [(5, 11), (1, 8), (-3, 8), (1845, 60), (7, 0), (None, 3), (3, -8)], "a long, b long")
    got = df.select(round_ratio(F.col("a") * 100, "b", 2).alias("r"),
                    round_ratio("a", "b", 1).alias("r1"),
                    half_up_quotient("a", "b").alias("q")).collect()
    assert [r.r for r in got] == [Decimal("45.45"), Decimal("12.50"), Decimal("-37.50"),
                                  Decimal("3075.00"), None, None, Decimal("-37.50")]
    assert [r.r1 for r in got] == [Decimal("0.5"), Decimal("0.1"), Decimal("-0.4"),
                                   Decimal("30.8"), None, None, Decimal("-0.4")]
    assert [r.q for r in got] == [0, 0, 0, 31, None, None, 0]


def test_stg_matches_buckets_filters_and_labels(spark):
    durations = [1, 2, 899, 900, 1799, 1800, 2699, 2700, 0, -1, None]
    rows = [match(f"m{i}", duration=d) for i, d in enumerate(durations)]
    rows.append(match("nocreation", creation=0))
    out = {r.match_id: r for r in stg_matches(matches_df(spark, rows)).collect()}
    assert set(out) == {f"m{i}" for i in range(8)}
    cats = [out[f"m{i}"].game_length_category for i in range(8)]
    assert cats == ["short", "short", "short", "medium", "medium", "long", "long",
                    "very_long"]
    assert out["m0"].duration_minutes == Decimal("0.0")
    assert out["m2"].duration_minutes == Decimal("15.0")   # 899/60 = 14.983


def test_stg_matches_queue_labels_and_time(spark):
    queues = [420, 440, 400, 430, 450, 0, None]
    rows = [match(f"q{i}", queue=q) for i, q in enumerate(queues)]
    rows.append(match("ms", creation=1699876543999))
    out = {r.match_id: r for r in stg_matches(matches_df(spark, rows)).collect()}
    labels = [out[f"q{i}"].queue_type for i in range(len(queues))]
    assert labels == ["Ranked Solo/Duo", "Ranked Flex", "Normal Draft", "Normal Blind",
                      "ARAM", "Other", "Other"]
    r = out["ms"]
    assert r.game_datetime.replace(tzinfo=None) == dt.datetime(2023, 11, 13, 11, 55, 43)
    assert r.game_date == dt.date(2023, 11, 13)


def test_smoke_row_of_source_project(spark):
    """The source's probe row: 1845 s → 30.8 min, 'long', ranked solo/duo."""
    r = stg_matches(matches_df(spark, [match("TEST_123", duration=1845,
                                              creation=1699876543000)])).first()
    assert r.duration_minutes == Decimal("30.8")
    assert r.game_length_category == "long"
    assert r.queue_type == "Ranked Solo/Duo"


def _stage(spark, parts, matches=None):
    m = stg_matches(matches_df(spark, matches or [match("M", duration=1800)]))
    return {r.participant_id: r for r in
            stg_participants(participants_df(spark, parts), m).collect()}


def test_team_side_and_roles(spark):
    teams = [100, 200, 300, None]
    parts = [participant(i, "M", team=t) for i, t in enumerate(teams)]
    out = _stage(spark, parts)
    assert [out[i].team_side for i in range(4)] == ["Blue", "Red", "Unknown", "Unknown"]

    cases = [("TOP", "x", "Top"), ("JUNGLE", "JUNGLE", "Jungle"), ("NONE", "JUNGLE", "Jungle"),
             ("JUNGLE", "TOP", "Unknown"), ("JUNGLE", None, "Unknown"), ("MIDDLE", "", "Mid"),
             ("MID", None, "Mid"), ("BOTTOM", "", "ADC"), ("CARRY", "", "ADC"),
             ("UTILITY", "", "Support"), ("SUPPORT", "", "Support"), ("", "", "Unknown"),
             (None, None, "Unknown")]
    parts = [participant(i, "M", role=r, lane=ln) for i, (r, ln, _) in enumerate(cases)]
    out = _stage(spark, parts)
    assert [out[i].standardized_role for i in range(len(cases))] == [c[2] for c in cases]
    assert out[len(cases) - 1].role == "UNKNOWN" and out[len(cases) - 1].lane == "UNKNOWN"
    assert out[len(cases) - 2].role == ""


def test_kda_and_rating(spark):
    cases = [  # (k, a, d) → (kda, rating)
        (3, 3, 0, Decimal("6.00"), "Perfect"),
        (3, 2, 0, Decimal("5.00"), "Poor"),
        (3, 0, 1, Decimal("3.00"), "Excellent"),
        (2, 0, 1, Decimal("2.00"), "Good"),
        (1, 0, 1, Decimal("1.00"), "Average"),
        (0, 0, 1, Decimal("0.00"), "Poor"),
        (2, 1, 8, Decimal("0.38"), "Poor"),      # 0.375 → 0.38
        (5, 0, 2, Decimal("2.50"), "Good"),
    ]
    parts = [participant(i, "M", k=k, a=a, d=d) for i, (k, a, d, _, _) in enumerate(cases)]
    out = _stage(spark, parts)
    assert [(out[i].kda, out[i].kda_rating) for i in range(len(cases))] == \
        [(c[3], c[4]) for c in cases]


def test_negative_stats_and_missing_champion_dropped(spark):
    parts = [participant(1, "M", k=-1), participant(2, "M", d=-1), participant(3, "M", a=-1),
             participant(4, "M", champ=None), participant(5, "M", k=None),
             participant(6, "M"), participant(7, "nomatch")]
    assert set(_stage(spark, parts)) == {6}


def test_per_minute_rates(spark):
    # duration 1 s → 0.0 min → rates NULL, cs rating Poor
    out = _stage(spark, [participant(1, "S", cs=100)], [match("S", duration=1)])
    r = out[1]
    assert r.cs_per_min is None and r.cs_rating == "Poor"
    assert r.vision_per_min is None and r.gold_per_min is None
    # 30-minute game
    parts = [participant(1, "M", cs=240), participant(2, "M", cs=239),
             participant(3, "M", cs=180), participant(4, "M", cs=120),
             participant(5, "M", cs=119, gold=0), participant(6, "M", cs=None)]
    out = _stage(spark, parts, [match("M", duration=1800)])
    assert out[1].cs_per_min == Decimal("8.0") and out[1].cs_rating == "Excellent"
    assert out[2].cs_per_min == Decimal("8.0")       # 7.9667 rounds up to 8.0
    assert out[3].cs_per_min == Decimal("6.0") and out[3].cs_rating == "Good"
    assert out[4].cs_per_min == Decimal("4.0") and out[4].cs_rating == "Average"
    assert out[5].cs_per_min == Decimal("4.0")       # 3.9667 → 4.0
    assert out[5].damage_per_gold is None            # gold 0
    assert out[6].cs_per_min is None and out[6].cs_rating == "Poor"
    assert out[1].gold_per_min == Decimal("333")     # 10000 / 30
    assert out[1].damage_per_gold == Decimal("2.00")


def test_cs_rating_uses_rounded_rate(spark):
    # 7.95 exactly: duration 20 min, cs 159 → 7.95 → rounds to 8.0 → Excellent
    out = _stage(spark, [participant(1, "M", cs=159)], [match("M", duration=1200)])
    assert out[1].cs_per_min == Decimal("8.0") and out[1].cs_rating == "Excellent"


def test_filters_reach_parquet_scan(spark, tmp_dir):
    """B1/B2 are plain predicates on raw columns: they must be pushed down."""
    path = f"{tmp_dir}/m"
    matches_df(spark, [match("a"), match("b", duration=0)]).write.parquet(path)
    pushed = plan_summary(stg_matches(spark.read.parquet(path)))["pushed_filters"]
    assert pushed and "GreaterThan(game_duration,0)" in pushed[0] \
        and "GreaterThan(game_creation,0)" in pushed[0]
