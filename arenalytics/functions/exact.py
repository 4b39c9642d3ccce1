"""Exact decimal rounding on Spark columns.

The source models divide arbitrary-precision numbers and round half away from
zero once.  Spark's ``round(avg(decimal))`` rounds twice (the average is cut at
scale s+4 first) and ``avg`` over doubles loses ties, so every rounded ratio is
computed here from integers:

    round(num / den, s) = sign(num) * ((2·|num|·10^s + den) div (2·den)) / 10^s

The row-level forms (staging: ratios of two int columns) run on longs, which
codegen keeps primitive.  The group-level forms (means and rates over sums)
widen the numerator to ``decimal(38,0)`` so sums over billions of rows cannot
overflow; they run once per group, so the slower decimal arithmetic costs
nothing measurable.  The quotient (rounded value × 10^s) always fits a long.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

WIDE = DecimalType(38, 0)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def int_div(a, b) -> Column:
    """Integral division truncating toward zero (SQL ``a div b``); long result."""
    return F.call_function("div", _col(a), _col(b))


def nullif_zero(c) -> Column:
    """``NULLIF(c, 0)``: the divide guard the models use."""
    c = _col(c)
    return F.when(c != 0, c)


def half_up_quotient(num, den, wide: bool = True) -> Column:
    """``num / den`` rounded half away from zero to an integer (long).

    NULL when either side is NULL or ``den`` is 0.  ``wide=False`` computes in
    longs: only for operands known to stay below ~10^17.
    """
    t = WIDE if wide else "long"
    n = _col(num).cast(t)
    d = nullif_zero(_col(den)).cast(t)
    mag = int_div(F.abs(n) * F.lit(2) + F.abs(d), F.abs(d) * F.lit(2))
    return F.when((n < 0) != (d < 0), -mag).otherwise(mag)


def from_unscaled(q, scale: int, precision: int = 20) -> Column:
    """Turn an integer ``q`` (|q| < 10^18) into the decimal ``q / 10^scale``
    exactly."""
    q = _col(q).cast(DecimalType(18, 0))
    if scale:
        q = q * F.lit(Decimal(1).scaleb(-scale))
    return q.cast(DecimalType(precision, scale))


def round_ratio(num, den, scale: int, num_scale: int = 0,
                precision: int = 20, wide: bool = True) -> Column:
    """``ROUND((num / 10^num_scale) / den, scale)`` computed exactly.

    ``num`` is an integer column holding a value scaled by ``10^num_scale``
    (e.g. a sum of ``kda × 100``); ``den`` a non-negative integer column
    (a count).  Result: ``decimal(precision, scale)``.
    """
    shift = scale - num_scale
    t = WIDE if wide else "long"
    n = _col(num).cast(t)
    d = _col(den).cast(t)
    if shift > 0:
        n = n * F.lit(10 ** shift)
    elif shift < 0:
        d = d * F.lit(10 ** (-shift))
    return from_unscaled(half_up_quotient(n, d, wide), scale, precision)


def unscaled(c, scale: int, wide: bool = False) -> Column:
    """A decimal column with ``scale`` digits as its integer ``c × 10^scale``
    (a long unless ``wide``)."""
    c = _col(c)
    if scale:
        c = c * F.lit(10 ** scale)
    return c.cast(WIDE if wide else "long")


def rounded_mean(c, scale: int, in_scale: int = 0, precision: int = 20) -> Column:
    """``ROUND(AVG(c), scale)`` for an int or decimal(·, in_scale) column.

    Aggregate expression: exact sum of the scaled integers over the count of
    non-NULL values; NULL for a group of only NULLs.
    """
    return round_ratio(F.sum(unscaled(c, in_scale)), F.count(_col(c)), scale,
                       num_scale=in_scale, precision=precision)


def rounded_rate(flag, scale: int = 2, precision: int = 20) -> Column:
    """``ROUND(AVG(CASE WHEN flag THEN 1.0 ELSE 0.0 END) * 100, scale)``.

    NULL flags count as 0 in the denominator (they are rows of the group).
    """
    return round_ratio(F.count_if(_col(flag)) * F.lit(100), F.count(F.lit(1)),
                       scale, precision=precision)


def mean_double(c, in_scale: int = 0) -> Column:
    """Unrounded mean of an int / decimal(·, in_scale) column as a double.

    The sum is exact (integers), then one IEEE division — the same double any
    engine gets for the same rational, so equal means tie exactly.
    """
    s = F.sum(unscaled(c, in_scale)).cast("double")
    n = F.count(_col(c)).cast("double")
    if in_scale:
        n = n * F.lit(float(10 ** in_scale))
    return s / n
