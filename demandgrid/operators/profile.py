"""Data profile: one aggregate per report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import constants as k
from ..functions.numeric import ratio
from ..functions.vectors import parse_vector
from .quantiles import exact_medians


def shape_span(df: DataFrame, time: str = k.TIME) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"), F.min(time).alias("start_dt"),
                  F.max(time).alias("end_dt"), F.datediff(F.max(time), F.min(time)).alias("duration_days"))


def dimensions(df: DataFrame) -> DataFrame:
    return df.agg(F.countDistinct("store_id").alias("unique_stores"), F.countDistinct("product_id").alias("unique_products"),
                  F.countDistinct("city_id").alias("unique_cities"),
                  F.countDistinct(*k.SERIES).alias("store_product_combinations"))


def target_statistics(df: DataFrame, target: str = k.TARGET, approx: bool = False) -> DataFrame:
    """The median is exact; ``approx`` takes it from the same pass as the rest."""
    y = F.col(target)
    rest = [F.avg(y).alias("mean_sales"), (ratio(F.count_if(y == 0), F.count("*")) * 100).alias("zero_sales_percentage"),
            F.max(y).alias("max_sales")]
    if approx:
        return df.agg(*rest, F.percentile_approx(y, 0.5, 10_000).alias("median_sales"))
    return df.agg(*rest).withColumn("median_sales", F.lit(exact_medians(df, [target])[target]).cast("double"))


def stockout_analysis(df: DataFrame, stockout_value: int = 0) -> DataFrame:
    """Counts on the hourly grain, read from the parsed status vector."""
    v = parse_vector(k.VALUE_VECTOR)
    daily = df.select("store_id", F.size(v).alias("hours"),
                      F.size(F.filter(v, lambda x: x == stockout_value)).alias("out"))
    return (daily.agg(F.sum("hours").alias("total_observations"), F.sum("out").alias("stockout_hours"),
                      F.countDistinct(F.when(F.col("out") > 0, F.col("store_id"))).alias("stores_with_stockouts"))
            .withColumn("stockout_rate_percent", ratio(F.col("stockout_hours"), F.col("total_observations")) * 100))


def missing_values(df: DataFrame) -> DataFrame:
    """NULL count per column, one row each."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_missing"))
                                            for c in df.columns])))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier one in every column. Copies are counted before they are shuffled."""
    return (df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
            .agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows")))
