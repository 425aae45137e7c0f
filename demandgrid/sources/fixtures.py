"""Facts derived from the given star-schema tables, so that every query runs on data that grows with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.calendar import flag
from ..schema import SALES_SCHEMA

EVAL_START = "2001-01-01"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_sales(spark: SparkSession, folder: str) -> DataFrame:
    """One row per store, product and day. Dimensions are broadcast only if Spark finds them small enough."""
    lines = table(spark, folder, "lineitem").select(
        "l_partkey", "l_suppkey", F.to_date("l_shipdate").alias("dt"), "l_discount",
        F.when(F.col("l_returnflag") == "R", F.lit(0.0)).otherwise(F.col("l_quantity")).alias("kept"))
    parts = table(spark, folder, "part").select(
        "p_partkey", F.substring_index("p_brand", "#", -1).cast("bigint").alias("product_id"))
    places = (table(spark, folder, "supplier")
              .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
              .select(F.col("s_suppkey").alias("store_id"), F.col("s_nationkey").cast("bigint").alias("city_id"),
                      F.col("n_regionkey").cast("bigint").alias("management_group_id")))
    daily = (lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
             .groupBy(F.col("l_suppkey").alias("store_id"), "product_id", "dt")
             .agg(F.sum("kept").cast("bigint").alias("q"), F.min("l_discount").alias("low"))
             .join(places, "store_id"))

    day = F.datediff("dt", F.lit("1995-01-01"))
    q, store, product, city = F.col("q"), F.col("store_id"), F.col("product_id"), F.col("city_id")
    # the status of hour h is 1 where (phase + h * h) is a multiple of 4, so four vectors cover all rows
    phase = (store * 7 + product * 3 + day) % 4
    patterns = [[int((r + h * h) % 4 == 0) for h in range(24)] for r in range(4)]

    def by_phase(values):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (phase + 1).cast("int"))

    # an hour holds one of two amounts; plain expressions compile, a function over an array does not
    least = F.floor(q / 24)
    low, high = least.cast("string"), (least + 1).cast("string")
    sold = F.concat_ws(" ", *[F.when((F.lit(h) + store) % 24 < q % 24, high).otherwise(low) for h in range(24)])
    return daily.select(
        "city_id", "store_id", "management_group_id",
        (product % 5).alias("first_category_id"), (product % 10).alias("second_category_id"),
        product.alias("third_category_id"), "product_id", "dt",
        q.cast("double").alias("sale_amount"),
        F.concat(F.lit("["), sold, F.lit("]")).alias("hours_sale"),
        by_phase([sum(p[6:23]) for p in patterns]).alias("stock_hour6_22_cnt"),
        by_phase(["[" + " ".join(map(str, p)) + "]" for p in patterns]).alias("hours_stock_status"),
        F.round(1 - 3 * F.col("low"), 2).alias("discount"),
        flag(day % 10 == 0).alias("holiday_flag"),
        flag(q > 0).alias("activity_flag"),
        (F.greatest(F.lit(0), (day * 37 + city) % 10 - 5) / 2).alias("precpt"),
        (day % 36).cast("double").alias("avg_temperature"),
        (40 + day % 50).cast("double").alias("avg_humidity"),
        (day % 7).cast("double").alias("avg_wind_level"),
    ).to(SALES_SCHEMA)


def split_sales(sales: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Training rows before, evaluation rows from the start of 2001."""
    return sales.filter(F.col("dt") < F.lit(EVAL_START).cast("date")), sales.filter(F.col("dt") >= F.lit(EVAL_START).cast("date"))


def hourly_events(spark: SparkSession, folder: str) -> DataFrame:
    """A genuinely sub-daily series: one row per user, event type and hour."""
    kinds = {"click": 1, "error": 2, "purchase": 3, "signup": 4, "view": 5}
    product = F.coalesce(*[F.when(F.col("event_type") == name, F.lit(n)) for name, n in kinds.items()], F.lit(0))
    return (table(spark, folder, "events")
            .groupBy(F.col("user_id").alias("store_id"), product.cast("bigint").alias("product_id"),
                     F.date_trunc("hour", F.col("ts").cast("timestamp")).cast("timestamp_ntz").alias("dt"))
            .agg(F.sum("value").alias("sale_amount"),
                 F.max(flag(F.col("event_type") == "error")).alias("hours_stock_status")))
