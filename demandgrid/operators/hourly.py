"""From daily rows with hour vectors to hourly rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import constants as k
from ..functions.vectors import parse_vector


def unnest_hours(df: DataFrame, vector: str, value: str = "val", ordinal: str = "hour_index") -> DataFrame:
    """One row per vector element with its 1-based place. Rows without a vector vanish."""
    return (df.select("*", F.posexplode(parse_vector(vector)).alias("_place", value))
            .withColumn(ordinal, F.col("_place") + 1).drop("_place"))


def expand_hours(df: DataFrame) -> DataFrame:
    """Explode the sale and the stock vector side by side; the hour is the place in the vectors.

    The place equals the running number within store, product and day as that triple is unique,
    so no window and no shuffle is needed.
    """
    pairs = F.arrays_zip(parse_vector(k.SALE_VECTOR).alias("sale"), parse_vector(k.VALUE_VECTOR, "int").alias("status"))
    rest = [c for c in df.columns if c not in (k.SALE_VECTOR, k.VALUE_VECTOR)]
    return (df.withColumn("_pairs", pairs)
            .select(*rest, F.posexplode_outer("_pairs").alias("_hour", "_pair"))
            .select(*rest, F.col("_pair")[F.lit("sale")].alias("sale_amount_hour"),
                    F.col("_pair")[F.lit("status")].alias("stock_status_hour"),
                    F.coalesce("_hour", F.lit(0)).alias("hour")))


def with_hour_timestamp(hourly: DataFrame, time: str = k.TIME, hour: str = "hour") -> DataFrame:
    """Give hourly rows a real timestamp so that calendar features see the hour."""
    return hourly.withColumn(time, (F.col(time).cast("timestamp") + F.make_dt_interval(hours=F.col(hour))))
