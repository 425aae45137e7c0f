"""Column helpers for rounding, guarded division and weighted moments."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..constants import FINITE_LIMIT


def round_half_even_2(c: Column) -> Column:
    """Two decimals, ties to even on the scaled double (0.575 -> 0.57)."""
    return F.rint(c * 100) / 100


def round_fraction(c: Column | str, places: int) -> Column:
    """``round``, which goes through decimals, only for numbers that have a fraction; zero loses its sign as there."""
    x = F.col(c) if isinstance(c, str) else c
    return F.when(x == F.rint(x), F.when(x == 0, F.lit(0.0)).otherwise(x)).otherwise(F.round(x, places))


def ratio(a: Column, b: Column) -> Column:
    """Real division; NULL when the denominator is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def whole_ratio(a: Column, b: Column) -> Column:
    """Division that truncates to a whole number, as integer SQL division does."""
    return ratio(a, b).cast("bigint")


def finite(c: Column) -> Column:
    """NaN to 0 and infinities to the largest accepted magnitude; NULL stays NULL."""
    c = c.cast("double")
    return (F.when(F.isnan(c), F.lit(0.0))
            .when(c == float("inf"), F.lit(FINITE_LIMIT))
            .when(c == float("-inf"), F.lit(-FINITE_LIMIT))
            .otherwise(c))


def weighted_avg(x: Column, w: Column) -> Column:
    """Mean of ``x`` where every row stands for ``w`` equal rows; NULL values carry no weight."""
    return ratio(F.sum(x * w), F.sum(F.when(x.isNotNull(), w)))


def stddev_from_moments(n: Column, total: Column, squares: Column, low: Column, high: Column) -> Column:
    """Sample deviation from count, sum and sum of squares.

    ``low``/``high`` are the extremes: a constant group is exactly 0, whatever the sums rounded to.
    """
    spread = F.greatest(squares - total * total / n, F.lit(0.0))
    return F.when(n > 1, F.when(low == high, F.lit(0.0)).otherwise(F.sqrt(spread / (n - 1))))


def weighted_stddev(x: Column, w: Column) -> Column:
    """Sample deviation of ``x`` where every row stands for ``w`` equal rows."""
    seen = F.when(w > 0, x)
    n = F.sum(F.when(x.isNotNull(), w)).cast("double")
    return stddev_from_moments(n, F.sum(x * w), F.sum(x * x * w), F.min(seen), F.max(seen))
