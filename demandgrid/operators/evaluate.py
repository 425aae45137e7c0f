"""Forecast metrics: one pass over actual and predicted values, whole or by group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as k
from .series import over_series


def mae(y: Column, p: Column) -> Column:
    return F.avg(F.abs(y - p))


def rmse(y: Column, p: Column) -> Column:
    return F.sqrt(F.avg((y - p) * (y - p)))


def mape(y: Column, p: Column, epsilon: float = k.EPSILON) -> Column:
    return F.avg(F.abs((y - p) / F.greatest(F.abs(y), F.lit(epsilon)))) * 100


def smape(y: Column, p: Column, epsilon: float = k.EPSILON) -> Column:
    return F.avg(F.abs(y - p) / ((F.abs(y) + F.abs(p)) / 2 + epsilon)) * 100


def bias(y: Column, p: Column) -> Column:
    return F.avg(p - y)


def bias_percentage(y: Column, p: Column, epsilon: float = k.EPSILON) -> Column:
    return F.try_divide(F.avg(p - y), F.avg(y) + epsilon) * 100


METRICS = {"MAE": mae, "RMSE": rmse, "MAPE": mape, "sMAPE": smape, "Bias": bias, "Bias_Percentage": bias_percentage}


def naive_error(train: DataFrame, period: int = 1, target: str = k.TARGET, time: str = k.TIME,
                last_rows: bool = False, **options) -> DataFrame:
    """One row: ``naive_mae``, the in-sample error of repeating the value ``period`` rows earlier in the series,
    and ``mean_y``. ``last_rows=True`` is the literal variant: steps among the last ``period`` rows of the table.
    """
    if last_rows:
        tail = train.orderBy(*[F.desc(c) for c in [*k.SERIES, time]]).limit(period)
        steps = over_series(tail.withColumn("_all", F.lit(1)), lambda w: {"_before": F.lag(target, 1).over(w)}, 1,
                            keys=["_all"], time=time, tie=[*k.SERIES, time], **options)
    else:
        steps = over_series(train, lambda w: {"_before": F.lag(target, period).over(w)}, period, time=time,
                            tie=[*k.SERIES, time, target], **options)
    return steps.agg(F.avg(F.abs(F.col(target) - F.col("_before"))).alias("naive_mae"), F.avg(target).alias("mean_y"))


def with_naive(scores: DataFrame, train: DataFrame, period: int, **options) -> DataFrame:
    """``scores`` with the naive error as a scalar subquery, which runs together with what uses it."""
    return scores.withColumn("_naive", naive_error(train, period, **options).select(F.struct("naive_mae", "mean_y")).scalar())


def scaled_error(y: Column, p: Column) -> Column:
    """MAE over the naive error; a history too short for steps falls back to the training mean as forecast."""
    fallback = F.avg(F.abs(y - F.col("_naive.mean_y").cast("double")))
    return mae(y, p) / (F.coalesce(F.max("_naive.naive_mae"), fallback) + k.EPSILON)


def mase(scores: DataFrame, train: DataFrame, y: str = "y", p: str = "p", period: int = 1, **options) -> DataFrame:
    return with_naive(scores, train, period, **options).agg(scaled_error(F.col(y), F.col(p)).alias("MASE"))


def evaluate(scores: DataFrame, y: str = "y", p: str = "p", train: DataFrame | None = None, period: int = 1,
             by: list[str] | None = None, **options) -> DataFrame:
    """All metrics in one aggregate; MASE only when training rows are given, ``n_observations`` only by group.

    Rows with a NULL group key are left out.
    """
    measures = [f(F.col(y), F.col(p)).alias(n) for n, f in METRICS.items()]
    if train is not None:
        scores = with_naive(scores, train, period, **options)
        measures.append(scaled_error(F.col(y), F.col(p)).alias("MASE"))
    if not by:
        return scores.agg(*measures)
    return scores.dropna(subset=by).groupBy(*by).agg(*measures, F.count("*").alias("n_observations"))
