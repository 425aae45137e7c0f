"""Per-series baseline forecasters. A fit is a table with one row per series, a forecast is a join with it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from .. import constants as k
from .series import over_series
from .validate import require_columns

STRATEGIES = ("last", "seasonal", "mean", "drift")


def fit_naive(train: DataFrame, strategy: str = "seasonal", period: int = k.SEASONAL_PERIOD, target: str = k.TARGET,
              time: str = k.TIME) -> DataFrame:
    """Table of ``store_id, product_id, value, trend``.

    Each strategy is an aggregate with partial sums on the map side. The seasonal mean keeps the last ``period``
    rows of a series; Spark cuts each task's rows to that number per series before the shuffle.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown strategy {strategy}, choose one of {STRATEGIES}")
    require_columns(train, [*k.SERIES, time, target])
    rows = train.select(*k.SERIES, F.col(time).alias("_t"), F.col(target).alias("_y")).dropna(subset=k.SERIES)
    y, at = F.col("_y"), F.struct(F.col("_t").isNull(), "_t", "_y")
    if strategy == "seasonal":
        latest = W.partitionBy(*k.SERIES).orderBy(F.col("_t").isNull().desc(), F.desc("_t"), F.desc("_y"))
        rows = rows.withColumn("_back", F.row_number().over(latest)).filter(F.col("_back") <= period)
        value, trend = F.when(F.count(y) == F.count("*"), F.avg(y)), F.lit(0.0)
    elif strategy == "mean":
        value, trend = F.avg(y), F.lit(0.0)
    elif strategy == "last":
        value, trend = F.max_by(y, at), F.lit(0.0)
    else:
        value = F.max_by(y, at)
        trend = F.coalesce(F.try_divide(value - F.min_by(y, at), (F.count("*") - 1).cast("double")), F.lit(0.0))
        trend = F.when(F.count("*") > 1, trend).otherwise(0.0)
    return rows.groupBy(*k.SERIES).agg(value.alias("value"), trend.alias("trend"))


def predict_naive(df: DataFrame, fit: DataFrame, horizon: int = 1, name: str = "prediction") -> DataFrame:
    """Unknown series and missing values give 0, negative forecasts too."""
    return (df.join(fit.withColumnsRenamed({"value": "_value", "trend": "_trend"}), k.SERIES, "left")
            .withColumn(name, F.greatest(F.lit(0.0), F.coalesce(F.col("_value") + F.col("_trend") * horizon, F.lit(0.0))))
            .drop("_value", "_trend"))


def fit_seasonal_naive(train: DataFrame, periods: list[int] = k.SEASONAL_PERIODS, target: str = k.TARGET,
                       time: str = k.TIME, **options) -> DataFrame:
    """Mean per series, period and place within the period; places no row falls on are absent and mean 0."""
    rows = train.select(*k.SERIES, time, target).dropna(subset=k.SERIES)
    placed = over_series(rows, lambda spec: {}, 0, time=time, tie=[*k.SERIES, time, target], position="_place", **options)
    cells = F.array(*[F.struct(F.lit(p).alias("period"), (F.col("_place") % p).cast("int").alias("idx")) for p in periods])
    return (placed.select(*k.SERIES, target, F.inline(cells))
            .groupBy(*k.SERIES, "period", "idx").agg(F.avg(target).alias("value")))


def predict_seasonal_naive(df: DataFrame, fit: DataFrame, period: int = k.SEASONAL_PERIODS[0], time: str = k.TIME,
                           name: str = "prediction") -> DataFrame:
    """Forecast from the first period at the hour of the row's time."""
    cells = fit.filter(F.col("period") == period).select(*k.SERIES, "idx", F.col("value").alias("_value"))
    return (df.withColumn("idx", F.hour(F.col(time).cast("timestamp")) % period).join(cells, [*k.SERIES, "idx"], "left")
            .withColumn(name, F.greatest(F.lit(0.0), F.coalesce("_value", F.lit(0.0)))).drop("idx", "_value"))
