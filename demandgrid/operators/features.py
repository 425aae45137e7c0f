"""Feature groups. Each takes a DataFrame and returns it with more columns; ``plans.feature_set`` composes them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, WindowSpec, functions as F

from .. import constants as k
from ..functions.calendar import flag, upper_bands
from ..functions.numeric import round_half_even_2
from ..functions.vectors import parse_vector
from ..session import keep
from .series import Rolling, over_series

TAU = 2 * math.pi


# calendar ---------------------------------------------------------------------------------------------------

def calendar(df: DataFrame, time: str = k.TIME) -> DataFrame:
    """Monday is day 0; the hour of a date is 0."""
    t = F.col(time)
    return df.withColumns({"hour": F.hour(t.cast("timestamp")), "day_of_week": F.weekday(t), "day_of_month": F.dayofmonth(t),
                           "month": F.month(t), "quarter": F.quarter(t), "week_of_year": F.weekofyear(t)})


def cyclical(df: DataFrame) -> DataFrame:
    cycles = {"hour": 24, "day_of_week": 7, "month": 12}
    return df.withColumns({f"{c}_{n}": f(F.col(c) * F.lit(TAU) / p)
                           for c, p in cycles.items() for n, f in (("sin", F.sin), ("cos", F.cos))})


def weekpart(df: DataFrame) -> DataFrame:
    d = F.col("day_of_week")
    return df.withColumns({"is_weekend": flag(d >= 5), "is_weekday": flag(d < 5)})


def rush(df: DataFrame) -> DataFrame:
    h = F.col("hour")
    return df.withColumns({"is_morning_rush": flag(h.between(7, 9)), "is_lunch_time": flag(h.between(11, 14)),
                           "is_evening_rush": flag(h.between(17, 20)), "is_late_night": flag((h >= 22) | (h <= 5))})


def day_part(df: DataFrame) -> DataFrame:
    return df.withColumn("day_part", upper_bands(F.col("hour"), k.DAY_PARTS))


def holiday(df: DataFrame, time: str = k.TIME, days: list[str] = k.HOLIDAYS) -> DataFrame:
    return df.withColumn("is_holiday", flag(F.date_format(time, "MM-dd").isin(days)))


def elapsed(df: DataFrame, time: str = k.TIME, start: Column | None = None) -> DataFrame:
    """Whole days and hours since the earliest time in the table, or since ``start`` (such as that of the training set)."""
    first = start if start is not None else df.agg(F.min(time)).scalar()
    seconds = (F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(F.col("_start").cast("timestamp"))) / 1_000_000
    return (df.withColumn("_start", first)
            .withColumns({"days_since_start": F.floor(seconds / 86400), "hours_since_start": seconds / 3600}).drop("_start"))


def fourier_columns(t: Column, periods: list[int] = k.FOURIER_PERIODS, order: int = k.FOURIER_ORDER) -> dict[str, Column]:
    return {f"fourier_{n}_{p}_{j}": f(t * F.lit(TAU * j / p))
            for j in range(1, order + 1) for p in periods for n, f in (("sin", F.sin), ("cos", F.cos))}


def fourier(df: DataFrame, position: str) -> DataFrame:
    """Daily and weekly harmonics of the row position held in ``position``."""
    return df.withColumns(fourier_columns(F.col(position)))


# statistics of stores and products --------------------------------------------------------------------------

def series_profile(df: DataFrame, target: str = k.TARGET, time: str = k.TIME) -> DataFrame:
    """Count, moments and first time per series: one scan with partial aggregation serves the statistics of stores
    and of products, the start of time and the check for long series."""
    y = F.col(target)
    return df.groupBy(*k.SERIES).agg(
        F.count("*").alias("n_rows"), F.count(y).alias("n"), F.avg(y).alias("mean"),
        (F.var_pop(y) * F.count(y)).alias("squares"), F.max(y).alias("top"), F.min(time).alias("first_time"))


def _pooled(profile: DataFrame, key: str, other: str, names: dict[str, str]) -> DataFrame:
    """Statistics of a key from those of its series: squares within the series plus squares between their means."""
    c = F.col
    n, total = F.sum("n"), F.sum(c("n") * c("mean"))
    squares = F.sum("squares") + F.sum(c("n") * c("mean") * c("mean")) - total * total / n
    measures = {
        "avg": round_half_even_2(F.when(n > 0, total / n)),
        "deviation": round_half_even_2(F.when(n > 1, F.sqrt(F.greatest(squares, F.lit(0.0)) / (n - 1)))),
        "max": round_half_even_2(F.max("top")), "count": F.count(other)}
    return (profile.filter(c(key).isNotNull()).groupBy(key)
            .agg(*[measures[m].alias(name) for m, name in names.items()]))


def fit_store_statistics(profile: DataFrame) -> DataFrame:
    return _pooled(profile, "store_id", "product_id", {"avg": "store_avg_sales", "deviation": "store_sales_volatility",
                                                       "max": "store_max_sales", "count": "store_product_count"})


def fit_product_statistics(profile: DataFrame) -> DataFrame:
    return _pooled(profile, "product_id", "store_id", {"avg": "product_avg_sales", "deviation": "product_sales_volatility",
                                                       "count": "product_store_count"})


def fitted(table: DataFrame) -> DataFrame:
    """Compute a fitted table once. Held and counted, its true size is known when a join with it is planned:
    Spark broadcasts it below its threshold and otherwise joins by shuffle, splitting skewed keys."""
    table = keep(table)
    table.count()
    return table


def apply_statistics(df: DataFrame, statistics: DataFrame, key: str) -> DataFrame:
    return df.join(statistics, key, "left")


# lags and rolling windows -----------------------------------------------------------------------------------

def coerced_status(column: str = k.VALUE_VECTOR) -> Column:
    """Plain numeric reading of the status cell: text that is no number, such as a whole vector, counts as 0."""
    return F.coalesce(F.col(column).cast("string").try_cast("double").cast("int"), F.lit(0))


def daily_status(column: str = k.VALUE_VECTOR, stockout_value: int = 1) -> Column:
    """1 if the day's vector marks any hour with ``stockout_value``."""
    return F.coalesce(F.array_contains(parse_vector(column, "int"), stockout_value).cast("int"), F.lit(0))


def lag_columns(spec: WindowSpec, target: str = k.TARGET, status: str = "stock_status",
                periods: list[int] = k.LAG_PERIODS) -> dict[str, Column]:
    lags = {f"{target}_lag_{n}": F.lag(target, n).over(spec) for n in periods}
    short = {f"stockout_lag_{n}": F.lag(F.col(status).cast("double"), n).over(spec)
             for n in periods if n <= k.STOCKOUT_LAG_MAX}
    return {**lags, **short}


def unmet_demand(df: DataFrame, target: str = k.TARGET, status: str = "stock_status", stockout_value: int = 1) -> DataFrame:
    """Out of stock, nothing sold, but something sold the row before."""
    return df.withColumn("unmet_demand", flag((F.col(status) == stockout_value) & (F.col(target) == 0)
                                              & (F.col(f"{target}_lag_1") > 0)))


def rolling_frame(spec: WindowSpec, rows: int, closed: str = "right") -> WindowSpec:
    """The last ``rows`` rows up to the current one; ``closed='left'`` leaves the current one out."""
    return spec.rowsBetween(-(rows - 1), 0) if closed == "right" else spec.rowsBetween(-rows, -1)


def rolling_columns(spec: WindowSpec, target: str = k.TARGET, status: str = "stock_status",
                    windows: list[int] = k.ROLLING_WINDOWS, closed: str = "right",
                    kinds: tuple[str, ...] = ("mean", "std", "max", "median", "stock_ratio")) -> dict[str, Column]:
    """Rolling measures as window columns, for short windows: Spark adds up every frame anew (see ``rolling_measures``)."""
    measures = {"mean": F.avg, "std": F.stddev_samp, "max": F.max, "median": lambda c: F.percentile(c, 0.5)}
    found = {}
    for n in windows:
        frame = rolling_frame(spec, n, closed)
        for kind in (x for x in kinds if x in measures):
            c = measures[kind](F.col(target)).over(frame)
            found[f"{target}_rolling_{kind}_{n}"] = F.coalesce(c, F.lit(0.0)) if kind == "std" else c
    if "stock_ratio" in kinds:
        found[f"stockout_ratio_{k.STOCK_RATIO_WINDOW}h"] = F.avg(status).over(rolling_frame(spec, k.STOCK_RATIO_WINDOW, closed))
    return found


def rolling_measures(target: str = k.TARGET, windows: list[int] = k.ROLLING_WINDOWS, closed: str = "right",
                     kinds: tuple[str, ...] = ("mean", "std", "max", "median")) -> Rolling | None:
    """The same measures for frames that are carried on from row to row."""
    names = {f"{target}_rolling_{kind}_{n}": (kind, n) for n in windows for kind in ("mean", "std", "max", "median") if kind in kinds}
    return Rolling(target, names, closed) if names else None


def lags(df: DataFrame, target: str = k.TARGET, status: str = "stock_status", periods: list[int] = k.LAG_PERIODS,
         **options) -> DataFrame:
    return over_series(df, lambda spec: lag_columns(spec, target, status, periods), max(periods), **options)


def rolling(df: DataFrame, target: str = k.TARGET, status: str = "stock_status", windows: list[int] = k.ROLLING_WINDOWS,
            closed: str = "right", kinds: tuple[str, ...] = ("mean", "std", "max", "median", "stock_ratio"), **options) -> DataFrame:
    ratio = tuple(kind for kind in kinds if kind == "stock_ratio")
    return over_series(df, lambda spec: rolling_columns(spec, target, status, windows, closed, ratio),
                       max([*windows, k.STOCK_RATIO_WINDOW]), rolling=rolling_measures(target, windows, closed, kinds), **options)


# interactions -----------------------------------------------------------------------------------------------

def interactions(df: DataFrame, status: str = "stock_status") -> DataFrame:
    c = F.col
    return df.withColumns({
        "temp_hour_interaction": c("avg_temperature") * c("hour"), "rain_weekend_interaction": c("precpt") * c("is_weekend"),
        "discount_weekend": c("discount") * c("is_weekend"), "discount_evening": c("discount") * c("is_evening_rush"),
        "stock_hour_interaction": c(status) * c("hour")})
