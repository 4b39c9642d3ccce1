"""The integer half-up rounding equals exact decimal rounding (ROUND_HALF_UP
= half away from zero) for random numerators and denominators, including
negatives and sums far beyond the long-safe range of the row-level form."""

import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from arenalytics.functions.exact import round_ratio


def _expected(n, d, scale, num_scale=0):
    if d == 0:
        return None
    q = (Decimal(n) / Decimal(10 ** num_scale)) / Decimal(d)
    return q.quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP)


def test_round_ratio_matches_decimal(spark):
    rnd = random.Random(7)
    rows = []
    for _ in range(3000):
        d = rnd.choice([rnd.randint(1, 9), rnd.randint(1, 10_000), rnd.randint(-50, -1)])
        n = rnd.choice([rnd.randint(-10_000, 10_000), rnd.randint(0, 10**15),
                        d * rnd.randint(-100, 100) + rnd.choice([0, d // 2, (d + 1) // 2])])
        rows.append((n, d))
    rows += [(5, 10), (-5, 10), (15, 10), (1, 8), (3, 8), (0, 7), (7, 0)]
    df = spark.createDataFrame(rows, "n long, d long")
    out = df.select("n", "d",
                    round_ratio("n", "d", 2).alias("r2"),
                    round_ratio("n", "d", 0).alias("r0"),
                    round_ratio("n", "d", 1, num_scale=2).alias("r1s2"),
                    round_ratio("n", "d", 2, wide=False).alias("r2_long")).collect()
    for r in out:
        assert r.r2 == _expected(r.n, r.d, 2), r
        assert r.r0 == _expected(r.n, r.d, 0), r
        assert r.r1s2 == _expected(r.n, r.d, 1, num_scale=2), r
        if abs(r.n) < 10**15:
            assert r.r2_long == _expected(r.n, r.d, 2), r
