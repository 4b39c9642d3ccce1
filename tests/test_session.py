from arenalytics.session import (
    RUNTIME_CONF, apply_runtime_conf, cluster_conf, ensure_checkpoint_dir, materialize,
    scratch_path)


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    current = ensure_checkpoint_dir(spark)
    # the test session names a folder; the library uses it instead of its own
    assert configured.rstrip("/").split("/")[-1] in current
    assert ensure_checkpoint_dir(spark) == current
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and configured.rstrip("/").split("/")[-1] in a


def test_runtime_conf_applies_to_any_session(spark):
    apply_runtime_conf(spark)
    for k, v in RUNTIME_CONF.items():
        assert spark.conf.get(k) == v


def test_cluster_conf_scales_with_input():
    small = cluster_conf(1 << 30, total_cores=16)
    big = cluster_conf(100 << 40, total_cores=8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 32          # two waves of tasks
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_materialize_cuts_lineage(spark):
    df = spark.range(100).selectExpr("id", "id % 7 AS k")
    m = materialize(df, "t")
    assert m.count() == 100
    assert "Scan parquet" in m._jdf.queryExecution().executedPlan().toString()
