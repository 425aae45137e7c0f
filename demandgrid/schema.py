"""Schema of the fact table and the NaN rule applied at ingest."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

SALES_SCHEMA = T.StructType([
    T.StructField("city_id", T.LongType()),
    T.StructField("store_id", T.LongType()),
    T.StructField("management_group_id", T.LongType()),
    T.StructField("first_category_id", T.LongType()),
    T.StructField("second_category_id", T.LongType()),
    T.StructField("third_category_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("dt", T.DateType()),
    T.StructField("sale_amount", T.DoubleType()),
    T.StructField("hours_sale", T.StringType()),
    T.StructField("stock_hour6_22_cnt", T.IntegerType()),
    T.StructField("hours_stock_status", T.StringType()),
    T.StructField("discount", T.DoubleType()),
    T.StructField("holiday_flag", T.IntegerType()),
    T.StructField("activity_flag", T.IntegerType()),
    T.StructField("precpt", T.DoubleType()),
    T.StructField("avg_temperature", T.DoubleType()),
    T.StructField("avg_humidity", T.DoubleType()),
    T.StructField("avg_wind_level", T.DoubleType()),
])


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing numbers are NULL from here on: Spark aggregates skip NULL but not NaN."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in floats}) if floats else df


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
