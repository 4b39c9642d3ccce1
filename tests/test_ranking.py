"""Distributed RANK / PERCENT_RANK / NTILE / ROW_NUMBER equal the built-in
single-partition window functions (property check over many shapes)."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from arenalytics.operators.ranking import RankSpec, _ntile, add_rankings

SPECS = [
    RankSpec("rk_desc", "rank", "v", descending=True),
    RankSpec("rk_asc", "rank", "v"),
    RankSpec("pr", "percent_rank", "v"),
    RankSpec("nt", "ntile", "v", tiebreak=("id",)),
    RankSpec("rn", "row_number", "v", descending=True, tiebreak=("id",)),
]


def _data(n, distinct, null_share, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        v = None if rnd.random() < null_share else float(rnd.randrange(distinct))
        rows.append((i, v))
    return rows


def _window_columns(df, specs):
    """The same columns by the built-in global windows."""
    for s in specs:
        value, full = Window.orderBy(s.value_order()), Window.orderBy(*s.full_order())
        df = df.withColumn(s.out, {
            "rank": lambda: F.rank().over(value).cast("long"),
            "percent_rank": lambda: F.percent_rank().over(value),
            "ntile": lambda: F.ntile(s.tiles).over(full),
            "row_number": lambda: F.row_number().over(full).cast("long")}[s.kind]())
    return df


def _collect(df):
    return {r.id: tuple(r[s.out] for s in SPECS) for r in df.collect()}


@pytest.mark.parametrize("n,distinct,null_share,buckets", [
    (1, 1, 0.0, 3),
    (9, 3, 0.0, 4),
    (10, 10, 0.0, 4),
    (23, 2, 0.2, 5),
    (200, 3, 0.1, 7),        # heavy ties spanning many buckets
    (300, 300, 0.0, 6),
    (257, 1, 0.0, 8),        # one value holds every row
    (150, 5, 0.9, 4),        # mostly NULLs
    (20000, 5000, 0.01, 7),  # large enough that range bounds come from a sample
    (20000, 3, 0.0, 9),      # large, heavy ties
])
def test_distributed_equals_window(spark, n, distinct, null_share, buckets):
    df = spark.createDataFrame(_data(n, distinct, null_share, n), "id int, v double")
    want = _collect(_window_columns(df, SPECS))
    got = _collect(add_rankings(df, SPECS, ["id"], buckets))
    assert got == want


def test_rows_never_meet_in_one_task(spark):
    """Only the per-bucket summary (≤ buckets rows) is gathered."""
    from arenalytics.operators import ranking
    from arenalytics.plans.explain import plan_text
    df = spark.createDataFrame(_data(100, 10, 0.0, 2), "id int, v double")
    text = plan_text(ranking._ranks(df, SPECS[0], ["id"], 4), "simple")
    # the exchange of the rows themselves is behind the written buckets
    assert "rank-buckets" in text or "FileScan" in text
    assert "RoundRobin" not in text


def test_a_hot_value_is_split(spark, monkeypatch):
    """A third of the rows share a value: no bucket holds more than twice the mean."""
    from arenalytics.operators import ranking
    kept = []
    write = ranking.write_once

    def keep(df, name):
        out = write(df, name)
        kept.append((name, out))
        return out
    monkeypatch.setattr(ranking, "write_once", keep)
    df = spark.range(60_000).select(F.col("id").cast("int").alias("id"), F.when(
        F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") * 1.0).alias("v"))
    add_rankings(df, [SPECS[0], SPECS[2]], ["id"], 12).count()
    for name, out in kept:
        if name == "rank-buckets":
            sizes = [r["count"] for r in out.groupBy("_b").count().collect()]
            assert len(sizes) >= 11 and max(sizes) <= 2 * 60_000 / 12


def test_ntile_formula_matches_builtin(spark):
    for n in [1, 2, 9, 10, 11, 23, 101]:
        df = spark.range(n).withColumn("rn", F.col("id") + 1)
        got = df.select(_ntile(F.col("rn"), F.lit(n), 10).alias("t"),
                        F.ntile(10).over(Window.orderBy("id")).alias("b")).collect()
        assert all(r.t == r.b for r in got), n


def test_value_ranks_need_no_key(spark):
    """Repeated keys and whole repeated rows keep their number and get their ranks."""
    rows = [(k % 7, None if k % 11 == 0 else float(k % 5)) for k in range(500)] + [(1, 2.0)] * 30
    df = spark.createDataFrame(rows, "id int, v double")
    specs = SPECS[:3]
    names = [s.out for s in specs]
    got = add_rankings(df, specs, ["id"], 6).select("id", "v", *names).collect()
    want = _window_columns(df, specs).select("id", "v", *names).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)
    assert add_rankings(df.limit(0), specs, ["id"], 6).columns == ["id", "v", *names]
    assert add_rankings(df.limit(0), specs, ["id"], 6).count() == 0


def test_numbering_by_a_repeated_key_is_an_error(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 3.0)], "id int, v double")
    with pytest.raises(ValueError, match="repeat a key"):
        add_rankings(df, [SPECS[3]], ["id"], 3)


def test_a_hot_value_is_split_when_rows_are_numbered(spark, monkeypatch):
    from arenalytics.operators import ranking
    kept = []
    write = ranking.write_once
    monkeypatch.setattr(ranking, "write_once", lambda df, name: kept.append((name, write(df, name))) or kept[-1][1])
    df = spark.range(60_000).select(F.col("id").cast("int").alias("id"), F.when(
        F.col("id") % 3 == 0, 0.5).otherwise(F.col("id") * 1.0).alias("v"))
    add_rankings(df, [SPECS[0], SPECS[3]], ["id"], 12).count()
    sizes = {name: [r["count"] for r in out.groupBy("_b").count().collect()] for name, out in kept if name != "rank-input"}
    assert len(sizes["rank-buckets"]) >= 11 and max(sizes["rank-buckets"]) <= 2 * 60_000 / 12
    assert max(sizes["rank-histogram"]) <= 2 * 40_001 / 12
