"""Plan inspection helpers (no UI needed): the formatted physical plan as
text, and counts of the operators that matter at scale."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def plan_summary(df: DataFrame) -> dict:
    """Exchanges (shuffles), broadcasts, single-partition exchanges, Python
    evaluation nodes and scans with their pushed filters."""
    text = plan_text(df, "simple")
    return {
        "exchanges": len(re.findall(r"Exchange (?:hashpartitioning|rangepartitioning"
                                    r"|RoundRobinPartitioning)", text)),
        "single_partition": len(re.findall(r"Exchange SinglePartition", text)),
        "broadcasts": len(re.findall(r"BroadcastExchange", text)),
        "python_nodes": len(re.findall(r"ArrowEvalPython|BatchEvalPython|MapInPandas"
                                       r"|FlatMapGroupsInPandas", text)),
        "sort_merge_joins": len(re.findall(r"SortMergeJoin", text)),
        "pushed_filters": re.findall(r"PushedFilters: \[([^\]]*)\]", plan_text(df)),
    }
