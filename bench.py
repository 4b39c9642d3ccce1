"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is run to completion with the ``noop`` sink (every row computed,
nothing collected to the driver).  ``full_build`` is one complete refresh of
all layers written as Parquet.  The suite runs twice; ``queries``/``value``
are the second (warm JVM, compiled code cached) pass, ``cold_value`` the
first.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from arenalytics.plans import build, registry  # noqa: E402
from arenalytics.session import build_session, scratch_path  # noqa: E402
from arenalytics.sources.adapter import load_raw  # noqa: E402

HEADLINE = [
    "stg_participants", "fact_matches", "dim_champions", "dim_summoners",
    "champion_stats", "player_performance", "meta_top_champions", "meta_global_stats",
    "role_distribution", "latest_n_per_player", "dq_unique_combination",
    "anti_join_new_matches", "incremental_load",
]


def stage_metrics(spark, tag: str) -> dict[str, dict[str, int]]:
    """Per job group (= query of one pass): completed stages and bytes
    written to shuffle, from Spark's in-memory application status store (no
    event log on disk, no UI)."""
    store = spark.sparkContext._jsc.sc().statusStore()
    jobs = store.jobsList(None)
    out: dict[str, dict[str, int]] = {}
    seen: set[int] = set()
    for i in range(jobs.size()):
        job = jobs.apply(i)
        group = job.jobGroup()
        if not group.isDefined() or not group.get().startswith(tag + ":"):
            continue
        name = group.get()[len(tag) + 1:]
        rec = out.setdefault(name, {"stages": 0, "shuffle_bytes": 0})
        ids = job.stageIds()
        for k in range(ids.size()):
            sid = ids.apply(k)
            if sid in seen:
                continue
            seen.add(sid)
            try:
                stage = store.lastStageAttempt(sid)
            except Exception:  # noqa: BLE001 - evicted or never run
                continue
            if stage.status().toString() != "COMPLETE":
                continue                  # skipped (reused) stages
            rec["stages"] += 1
            rec["shuffle_bytes"] += int(stage.shuffleWriteBytes())
    return out


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(f"local[{cpus}]", app="arenalytics-bench",
                          shuffle_partitions=max(8, cpus * 2),
                          extra={"spark.driver.memory": "16g",
                                 "spark.ui.retainedJobs": "10000",
                                 "spark.ui.retainedStages": "10000"})
    sc = spark.sparkContext
    qs = registry.queries()

    def suite(tag: str) -> dict[str, float]:
        times: dict[str, float] = {}
        for name in HEADLINE:
            sc.setJobGroup(f"{tag}:{name}", name)
            t0 = time.time()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.time() - t0, 3)
        sc.setJobGroup(f"{tag}:full_build", "full_build")
        t0 = time.time()
        m, p = load_raw(spark, sf_dir)
        build.build_all(spark, m, p, scratch_path(spark, "bench-build"), registry.AS_OF)
        times["full_build"] = round(time.time() - t0, 3)
        return times

    cold = suite("cold")
    warm = suite("warm")
    try:
        metrics = stage_metrics(spark, "warm")
    except Exception:  # noqa: BLE001 - metrics are informative only
        metrics = {}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(warm.values()), 3),
                      "unit": "sec", "queries": warm, "sf": sf,
                      "cold_value": round(sum(cold.values()), 3),
                      "stages": {k: v["stages"] for k, v in sorted(metrics.items())},
                      "shuffle_bytes": {k: v["shuffle_bytes"]
                                        for k, v in sorted(metrics.items())}}))


if __name__ == "__main__":
    main()
