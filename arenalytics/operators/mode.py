"""``MODE() WITHIN GROUP (ORDER BY value)`` as a two-level aggregate.

Counting (key, value) pairs first lets partial aggregation collapse a hot key
before the shuffle; the second level keeps, per key, the value with the highest
count and the smallest value among ties — the ordered-set mode's tie rule.
NULL values are ignored; a key with only NULLs gets no row (NULL after a left
join), as the ordered-set aggregate returns NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mode_by(df: DataFrame, keys: list[str], value: str, alias: str) -> DataFrame:
    counts = (df.filter(F.col(value).isNotNull())
                .groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_mode_n")))
    return counts.groupBy(*keys).agg(
        F.min_by(F.col(value), F.struct(-F.col("_mode_n"), F.col(value))).alias(alias))


def mode_of_domain(value: str, domain: list[str]) -> Column:
    """Aggregate expression: the mode of a column whose values come from a
    fixed, small set (e.g. the labels of a CASE).

    One conditional count per possible value inside the same aggregate as the
    other measures — no second pass, no (key, value) shuffle.  Highest count
    wins; ties go to the smallest value; NULL when the group has no non-NULL
    value (all counts 0).
    """
    ordered = sorted(domain)
    cands = [F.struct(F.count_if(F.col(value) == v).alias("n"),
                      F.lit(-i).alias("rank"), F.lit(v).alias("v"))
             for i, v in enumerate(ordered)]
    best = F.array_max(F.array(*cands))
    return F.when(best["n"] > 0, best["v"])
