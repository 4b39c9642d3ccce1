"""Global RANK / PERCENT_RANK / NTILE / ROW_NUMBER without one-task windows.

A window with no PARTITION BY puts every row in one task
(``Exchange SinglePartition``).  That is right for a few thousand champions and
wrong for a player table at cluster scale.

RANK and PERCENT_RANK depend on the value alone, so they come from a histogram:

1. Count the rows of every distinct value; a value shared by a third of all
   rows is combined map-side.
2. Range-partition the distinct values, sum their counts inside each partition,
   and add the totals of the partitions before (at most P rows).  That is the
   number of rows before each value.
3. Join back on the value.  Rows need no key and may repeat.

NTILE and ROW_NUMBER also order the rows inside a value:

1. The input is written once; each ranking then works on a narrow projection
   (entity key, value).  ``repartitionByRange(P, value, key)`` — sampled bounds
   on the value and the key, so even a value shared by a third of all rows is
   split over many buckets; the bucket id is ``spark_partition_id()``.
2. Inside each bucket, ordinary windows give the local row number and the
   local rank (ties on the value only).
3. A one-row-per-bucket summary (row count, first and last value, rows tied
   at the last value) becomes prefix offsets with tiny windows; it has at most
   P rows, one per task of the shuffle.
4. Global row number = offset + local row number.  Global rank = offset +
   local rank − (rows of earlier buckets tied with this bucket's first value).
   NTILE follows from row number and the total N.
5. The ranks are joined back to the input by the entity key, which must be
   unique: rows that repeat one would multiply, so they raise an error.

Range bounds are sampled anew by every execution of the exchange (the sampler
is seeded by the RDD id), so the bucketed rows (or values) are written once
(Parquet below the shared ``spark.checkpoint.dir``) and both the per-bucket
summary and the result read that copy; a lost executor re-reads it instead of
re-bucketing.  So ``add_rankings`` runs jobs when it is called.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exact import int_div
from ..session import materialize as write_once


@dataclass(frozen=True)
class RankSpec:
    """One ranking column.

    kind: 'rank' | 'percent_rank' | 'ntile' | 'row_number'
    value: the ORDER BY column (a single column; NULLs tie with each other)
    descending / nulls_first: sort direction; default NULL placement is the
    source engine's (NULL largest: last ascending, first descending)
    tiebreak: extra ORDER BY columns (ascending) that make the order total —
    used by row_number/ntile, never by rank ties
    """
    out: str
    kind: str
    value: str
    descending: bool = False
    nulls_first: bool | None = None
    tiebreak: tuple[str, ...] = ()
    tiles: int = 10

    def value_order(self) -> Column:
        c = F.col(self.value)
        nf = self.descending if self.nulls_first is None else self.nulls_first
        if self.descending:
            return c.desc_nulls_first() if nf else c.desc_nulls_last()
        return c.asc_nulls_first() if nf else c.asc_nulls_last()

    def full_order(self) -> list[Column]:
        return [self.value_order()] + [F.col(t).asc_nulls_last() for t in self.tiebreak]


def _ntile(rn: Column, n: Column, tiles: int) -> Column:
    """NTILE(tiles) of the 1-based row number ``rn`` among ``n`` rows:
    the first ``n mod tiles`` buckets hold one row more."""
    i = rn - 1
    q = int_div(n, F.lit(tiles))
    r = n - q * tiles
    big = r * (q + 1)
    first = int_div(i, q + 1) + 1
    rest = r + int_div(i - big, F.when(q > 0, q)) + 1
    return F.when(i < big, first).otherwise(rest).cast("int")


def _ranks(df: DataFrame, s: RankSpec, key: list[str], buckets: int) -> DataFrame:
    """(key…, ranking column) of one spec."""
    order = s.full_order()
    rest = [F.col(k).asc_nulls_last() for k in key if k not in s.tiebreak]
    parted = (df.select(*dict.fromkeys([*key, s.value, *s.tiebreak]))
              .repartitionByRange(buckets, *order, *rest)
              .withColumn("_b", F.spark_partition_id()))
    w_full = Window.partitionBy("_b").orderBy(*order, *rest)
    w_val = Window.partitionBy("_b").orderBy(s.value_order())
    # Range bounds are sampled per execution (the sampler is seeded by the RDD
    # id), so two plans over the same input can bucket rows differently.  The
    # bucketed, locally ranked rows are therefore written once and both the
    # summary and the rows read that copy.
    local = write_once(parted.withColumn("_rn", F.row_number().over(w_full))
                             .withColumn("_rk", F.rank().over(w_val)), "rank-buckets")

    summ = local.groupBy("_b").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min_by(F.col(s.value), F.col("_rn")).alias("_first"),
        F.max_by(F.col(s.value), F.col("_rn")).alias("_last"),
        F.max_by(F.col("_rk"), F.col("_rn")).alias("_last_rk"),
        # explicit NULL markers: NULL values must tie across buckets too
        F.min_by(F.col(s.value).isNull(), F.col("_rn")).alias("_first_null"),
        F.max_by(F.col(s.value).isNull(), F.col("_rn")).alias("_last_null"),
    )
    by_b = Window.orderBy("_b")
    prev = by_b.rowsBetween(Window.unboundedPreceding, -1)
    same_last = Window.partitionBy("_last", "_last_null").orderBy("_b").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    summ = (summ
            .withColumn("_cnt_last", F.col("_n") - F.col("_last_rk") + 1)
            .withColumn("_cum_last", F.sum("_cnt_last").over(same_last))
            .withColumn("_off", F.coalesce(F.sum("_n").over(prev), F.lit(0)))
            .withColumn("_N", F.sum("_n").over(Window.partitionBy()))
            .withColumn("_prev_last", F.lag("_last").over(by_b))
            .withColumn("_prev_last_null", F.lag("_last_null").over(by_b))
            .withColumn("_prev_cum", F.lag("_cum_last").over(by_b))
            .withColumn("_eq_before", F.when(
                (F.col("_prev_last_null") == F.col("_first_null"))
                & (F.col("_first_null") | (F.col("_prev_last") == F.col("_first"))),
                F.col("_prev_cum")).otherwise(F.lit(0)))
            .select("_b", "_off", "_N", "_first", "_first_null", "_eq_before"))

    j = local.join(summ, "_b")
    is_first = F.when(F.col("_first_null"), F.col(s.value).isNull()).otherwise(
        F.col(s.value).eqNullSafe(F.col("_first")))
    rn = F.col("_off") + F.col("_rn")
    rank = F.col("_off") + F.col("_rk") - F.when(is_first, F.col("_eq_before")).otherwise(0)
    if s.kind == "rank":
        col = rank.cast("long")
    elif s.kind == "percent_rank":
        col = F.when(F.col("_N") > 1, (rank - 1).cast("double") / (F.col("_N") - 1)) \
               .otherwise(F.lit(0.0))
    elif s.kind == "ntile":
        col = _ntile(rn, F.col("_N"), s.tiles)
    elif s.kind == "row_number":
        col = rn.cast("long")
    else:
        raise ValueError(s.kind)
    return j.select(*key, col.alias(s.out))


def _value_ranks(df: DataFrame, value: str, descending: bool, nulls_first: bool | None,
                 buckets: int) -> DataFrame:
    """(value, _before, _total): per distinct value the number of rows ordered
    before it, and of all rows."""
    order = RankSpec("", "rank", value, descending, nulls_first).value_order()
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    parted = counts.repartitionByRange(buckets, order).withColumn("_b", F.spark_partition_id())
    upto = Window.partitionBy("_b").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = write_once(parted.withColumn("_upto", F.sum("_n").over(upto)), "rank-histogram")
    earlier = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = (local.groupBy("_b").agg(F.sum("_n").alias("_in"))
              .withColumn("_off", F.coalesce(F.sum("_in").over(earlier), F.lit(0)))
              .withColumn("_total", F.sum("_in").over(Window.partitionBy())))
    return local.join(totals, "_b").select(
        value, (F.col("_off") + F.col("_upto") - F.col("_n")).alias("_before"), "_total")


def _add_value_ranks(df: DataFrame, specs: list[RankSpec], buckets: int, source: DataFrame) -> DataFrame:
    """``df`` with the RANK / PERCENT_RANK columns of ``specs``, all over one
    value in one direction."""
    s = specs[0]
    ranks = _value_ranks(source, s.value, s.descending, s.nulls_first, buckets)
    out = df.join(ranks.withColumnRenamed(s.value, "_value"), F.col(s.value).eqNullSafe(F.col("_value")))
    for s in specs:
        col = (F.col("_before") + 1).cast("long") if s.kind == "rank" else \
            F.when(F.col("_total") > 1, F.col("_before").cast("double") / (F.col("_total") - 1)).otherwise(F.lit(0.0))
        out = out.withColumn(s.out, col)
    return out.drop("_value", "_before", "_total")


def add_rankings(df: DataFrame, specs: list[RankSpec], key: list[str],
                 buckets: int | None = None) -> DataFrame:
    """Add one column per spec.

    ``key`` names the columns that tell the rows apart (nulls allowed); only
    NTILE and ROW_NUMBER use it: equal values are split over buckets by it and
    the ranks come back by it.  One path for every size; ``buckets`` defaults to
    ``spark.sql.shuffle.partitions``.
    """
    spark = df.sparkSession
    if buckets is None:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    buckets = max(1, buckets)
    columns = df.columns
    out = df = write_once(df, "rank-input")
    by_value: dict[tuple, list[RankSpec]] = {}
    by_row = [s for s in specs if s.kind not in ("rank", "percent_rank")]
    for s in specs:
        if s not in by_row:
            by_value.setdefault((s.value, s.descending, s.nulls_first), []).append(s)
    for same_value in by_value.values():
        out = _add_value_ranks(out, same_value, buckets, df)
    if by_row and not df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").isEmpty():
        raise ValueError(f"rows repeat a key ({', '.join(key)}): they cannot be numbered by it")
    for s in by_row:
        ranks = _ranks(df, s, key, buckets)
        names = [f"_key{i}" for i in range(len(key))]
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(key, names)])
        out = out.join(ranks.toDF(*names, s.out), same, "left").drop(*names)
    return out.select(*columns, *[s.out for s in specs])
