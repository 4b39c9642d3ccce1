"""Write PLANS.md: the physical shape of every registered query.

    python tools/plan_report.py [sf_dir] > PLANS.md

Counts come from the initial (pre-AQE) physical plan: hash/range shuffles,
single-partition exchanges, broadcasts, sort-merge joins and Python nodes,
plus the filters pushed into Parquet scans.  Queries whose plan is built over
already-checkpointed data (rankings, loads) show only the part after the
checkpoint.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from arenalytics.plans import registry  # noqa: E402
from arenalytics.plans.explain import plan_summary  # noqa: E402
from arenalytics.session import build_session  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8,
                          extra={"spark.driver.memory": "8g"})
    rows = []
    for name, fn in registry.queries().items():
        s = plan_summary(fn(spark, sf_dir))
        pushed = "; ".join(p for p in s["pushed_filters"] if p) or "–"
        rows.append(f"| `{name}` | {s['exchanges']} | {s['single_partition']} | "
                    f"{s['broadcasts']} | {s['sort_merge_joins']} | {s['python_nodes']} | "
                    f"{pushed[:160]} |")
    print("# Physical plan shapes\n")
    print(f"Generated by `tools/plan_report.py` on `{sf_dir}` (local mode, pre-AQE plan).\n")
    print("Single-partition exchanges are global aggregates of one row, and offsets over one")
    print("row per shuffle partition in the rankings.  Queries that rank or load run jobs when")
    print("they are built and show only the part after their eager writes.  A mart with several")
    print("aggregates (measures and distinct counts) repeats the stand-in scan per aggregate; in")
    print("the full build those aggregates read the stored staging table instead.\n")
    print("| Query | Shuffles | Single-partition | Broadcasts | Sort-merge joins "
          "| Python nodes | Pushed filters |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    print("\n".join(rows))


if __name__ == "__main__":
    main()
