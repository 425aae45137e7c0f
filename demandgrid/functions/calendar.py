"""Calendar expressions. Two weekday bases live side by side: Sunday=0 in the views, Monday=0 in the features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def dow_sunday0(c: Column) -> Column:
    return F.dayofweek(c) - 1


def is_weekend_day(c: Column) -> Column:
    return F.dayofweek(c).isin(1, 7)


def flag(condition: Column) -> Column:
    """1 when the condition holds, else 0 (also when it is unknown)."""
    return F.when(condition, 1).otherwise(0)


def upper_bands(c: Column, bands: list[tuple], top=None, inclusive: bool = False) -> Column:
    """Label by the first upper bound that holds the value; ``top`` for the rest."""
    def fits(bound):
        return c <= bound if inclusive else c < bound
    first, *rest = bands
    chain = reduce(lambda acc, b: acc.when(fits(b[0]), b[1]), rest, F.when(fits(first[0]), first[1]))
    return chain.otherwise(F.lit(top)) if top is not None else chain
