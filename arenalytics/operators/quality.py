"""Data-quality checks: each returns the failing rows; a check passes when
none remain.  Semantics follow the generic tests of the model project:

* unique — non-NULL values occurring more than once
* not_null — rows where the column is NULL
* relationships — non-NULL child keys absent from the parent
* accepted_range — values outside [min, max] (inclusive; NULL passes)
* unique_combination — column tuples occurring more than once (NULLs group)

All are one aggregate or one anti-join; ``summarize`` turns a list of checks
into one row per check (check name, failure count) in a single job.

Checks that look at one row at a time (not_null, accepted_range) also come as
counters (``null_counter``, ``range_counter``): ``count_failures`` takes all
counters of a table in one aggregate, so a table is read once whatever the
number of its checks, and ``counting`` lets them ride along while the table is
written (``DataFrame.observe``), without any read of their own.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def unique(df: DataFrame, column: str) -> DataFrame:
    return (df.filter(F.col(column).isNotNull())
              .groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
              .filter(F.col("n_records") > 1))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def relationships(child: DataFrame, column: str, parent: DataFrame,
                  field: str) -> DataFrame:
    keys = parent.select(F.col(field).alias("_parent_key")).distinct()
    return (child.filter(F.col(column).isNotNull())
                 .join(keys, F.col(column) == F.col("_parent_key"), "left_anti"))


def _outside(column: str, min_value, max_value) -> Column:
    c = F.col(column)
    bad = F.lit(False)
    if min_value is not None:
        bad = bad | (c < F.lit(min_value))
    if max_value is not None:
        bad = bad | (c > F.lit(max_value))
    return bad


def accepted_range(df: DataFrame, column: str, min_value=None, max_value=None) -> DataFrame:
    return df.filter(_outside(column, min_value, max_value))


def null_counter(column: str) -> Column:
    """The number of rows that ``not_null`` returns."""
    return F.count_if(F.col(column).isNull())


def range_counter(column: str, min_value=None, max_value=None) -> Column:
    """The number of rows that ``accepted_range`` returns."""
    return F.count_if(_outside(column, min_value, max_value))


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    return (df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
              .filter(F.col("n_records") > 1))


@dataclass
class Check:
    name: str
    failures: DataFrame


def summarize(checks: list[Check]) -> DataFrame:
    """(check_name, failures) per check, as one union of global counts."""
    rows = [c.failures.agg(F.count(F.lit(1)).alias("failures"))
             .select(F.lit(c.name).alias("check_name"), "failures") for c in checks]
    return reduce(lambda a, b: a.unionByName(b), rows)


def count_failures(df: DataFrame, counters: dict[str, Column]) -> DataFrame:
    """(check_name, failures) of all ``counters`` of one table, from one scan."""
    names = list(counters)
    row = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(counters.values())])
    pairs = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"c{i}").alias("failures"))
                      for i, n in enumerate(names)])
    return row.select(F.inline(pairs))


def unique_failures(df: DataFrame, name: str, columns: list[str], nulls: bool = False,
                    counters: dict[str, Column] | None = None) -> DataFrame:
    """(check_name, failures) of a uniqueness check on ``columns`` and of the
    ``counters`` of the same table, from one scan: the counters are summed per
    key first (map-side combined), and the keys that occur more than once are
    counted with them.  With ``nulls`` null keys are values like any."""
    counters = counters or {}
    n = F.count(F.lit(1))
    per_key = df.groupBy(*columns).agg(n.alias("_n"), *[c.alias(f"_c{i}") for i, c in enumerate(counters.values())])
    known = F.lit(True) if nulls else reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    totals = {name: F.count_if((F.col("_n") > 1) & known)} | {
        check: F.coalesce(F.sum(f"_c{i}"), F.lit(0)) for i, check in enumerate(counters)}
    return count_failures(per_key, totals)


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def counting(df: DataFrame, counters: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """``df`` whose next action also takes the ``counters``, and where to read
    them afterwards (``observation.get``)."""
    seen = Observation()
    return df.observe(seen, *[c.alias(name) for name, c in counters.items()]), seen
