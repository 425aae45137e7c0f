"""Reading, preparing and publishing fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import constants as k
from ..config import DataSettings
from ..functions.vectors import parse_vector
from ..schema import SALES_SCHEMA, nan_to_null
from .sampling import sample_fraction


def read_sales(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType = SALES_SCHEMA) -> DataFrame:
    """Read facts under a declared schema; CSV is never inferred, so the file is scanned once and only when used."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return nan_to_null(reader.format(fmt).load(path))


def parse_time(df: DataFrame, column: str = k.TIME) -> DataFrame:
    """Text times become timestamps; real dates and timestamps stay what they are."""
    if isinstance(df.schema[column].dataType, T.StringType):
        return df.withColumn(column, F.try_to_timestamp(F.col(column)))
    return df


def load_sales(spark: SparkSession, settings: DataSettings, fmt: str = "csv") -> tuple[DataFrame, DataFrame]:
    """Training and evaluation facts, each reduced to the configured share of rows."""
    if not settings.train_path or not settings.eval_path:
        raise ValueError("both a training and an evaluation path are needed")
    keys = [*k.SERIES, settings.time]
    return tuple(
        sample_fraction(parse_time(read_sales(spark, path, fmt), settings.time), settings.fraction, keys, settings.seed)
        for path in (settings.train_path, settings.eval_path))


def load_report(train: DataFrame, evaluation: DataFrame, time: str = k.TIME) -> DataFrame:
    """Row count and period of each set."""
    both = train.select(F.lit("train").alias("split"), time).unionAll(evaluation.select(F.lit("eval").alias("split"), time))
    return both.groupBy("split").agg(F.count("*").alias("n_rows"), F.min(time).alias("first_dt"), F.max(time).alias("last_dt"))


def write_facts(df: DataFrame, path: str) -> None:
    """Store facts with parsed vectors, one folder per month, for repeated use.

    Rebalancing gathers a month into few files but splits a month too large for one task.
    """
    parsed = df.withColumns({
        k.SALE_VECTOR: parse_vector(k.SALE_VECTOR), k.VALUE_VECTOR: parse_vector(k.VALUE_VECTOR, "int"),
        "sales_year": F.year(k.TIME), "sales_month": F.month(k.TIME)})
    (parsed.hint("rebalance", "sales_year", "sales_month")
     .write.mode("overwrite").partitionBy("sales_year", "sales_month").parquet(path))


def publish_views(sales: DataFrame, value_from: str = k.VALUE_VECTOR) -> dict[str, DataFrame]:
    """Register the fact table and the five views under their names for use from SQL."""
    from ..plans import views
    published = {
        "raw_sales_data": sales,
        "hourly_business_summary": views.hourly_summary(sales, value_from),
        "store_performance_dashboard": views.store_dashboard(sales, value_from),
        "category_intelligence": views.category_intelligence(sales, value_from),
        "rhythm_agg": views.rhythm_agg(sales, value_from),
        "business_rhythm_patterns": views.rhythm_patterns(sales, value_from),
    }
    for name, df in published.items():
        df.createOrReplaceTempView(name)
    return published
