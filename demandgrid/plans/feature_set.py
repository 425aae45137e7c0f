"""The whole feature set: series windows, statistics, calendar, interactions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from .. import constants as k
from ..config import FeatureSettings
from ..operators import features as f
from ..operators.series import over_series


@dataclass
class FeatureFit:
    """What is learned from the training rows and applied to any rows."""
    store_statistics: DataFrame
    product_statistics: DataFrame
    first_time: object
    lengths: DataFrame


def fit_features(train: DataFrame, settings: FeatureSettings = FeatureSettings()) -> FeatureFit:
    """One scan of the rows; everything else is computed from the table of series."""
    profile = f.fitted(f.series_profile(train, settings.target, settings.time))
    return FeatureFit(f.fitted(f.fit_store_statistics(profile)), f.fitted(f.fit_product_statistics(profile)),
                      profile.agg(F.min("first_time")).first()[0], profile.select(*k.SERIES, "n_rows"))


def temporal(df: DataFrame, settings: FeatureSettings = FeatureSettings(), first_time=None) -> DataFrame:
    df = f.day_part(f.rush(f.weekpart(f.cyclical(f.calendar(df, settings.time)))))
    df = f.holiday(df, settings.time, settings.holidays)
    return f.elapsed(df, settings.time, None if first_time is None else F.lit(first_time))


def engineer(df: DataFrame, fit: FeatureFit | None = None, settings: FeatureSettings = FeatureSettings(),
             status_from: str = "vector", closed: str = "right") -> DataFrame:
    """70 columns more. Without ``fit`` the statistics come from ``df`` itself.

    All lag, rolling and position columns share one exchange and one sort. ``status_from='cell'`` reads the
    status cell as a plain number, which is 0 for a vector text; ``'given'`` takes ``stock_status`` as it is.
    """
    lengths = None if fit else (fit := fit_features(df, settings)).lengths
    status = {"vector": f.daily_status, "cell": f.coerced_status, "given": lambda: F.col("stock_status")}[status_from]()

    def windows(spec):
        return {**f.lag_columns(spec, settings.target, periods=settings.lag_periods),
                **f.rolling_columns(spec, settings.target, closed=closed, kinds=("stock_ratio",))}

    # windows come first: the exchange then carries the given columns only, not those that rows yield by themselves
    reach = max([*settings.lag_periods, *settings.rolling_windows])
    df = over_series(df.withColumn("stock_status", status), windows, reach, time=settings.time, limit=settings.series_rows,
                     block=settings.block_rows, position="_place", lengths=lengths,
                     rolling=f.rolling_measures(settings.target, settings.rolling_windows, closed))
    df = f.apply_statistics(df, fit.store_statistics, "store_id")
    df = f.apply_statistics(df, fit.product_statistics, "product_id")
    df = f.unmet_demand(f.fourier(temporal(df, settings, fit.first_time), "_place"), settings.target)
    return f.interactions(df).drop("_place", "stock_status")
