"""The view layer over the fact table.

``value_from`` names the vector read as hourly value; the stock-status vector is the established default,
``hours_sale`` the option. Wherever a view does not group by hour it works on the daily rows and lets each
row stand for as many hours as its vector has, which saves the 24-fold explode but gives the same numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as k
from ..functions.calendar import dow_sunday0, flag, is_weekend_day, upper_bands
from ..functions.numeric import ratio, stddev_from_moments, weighted_avg, weighted_stddev
from ..functions.vectors import (count_known, count_zero, parse_vector, positives, vector_length, vector_squares,
                                 vector_sum)
from ..session import keep


def promo_flag(rule: str = "discount>0") -> Column:
    """``discount>0`` is the established rule, although 1 means full price; ``discount<1`` is the corrected one."""
    rules = {"discount>0": F.col("discount") > 0, "discount<1": F.col("discount") < 1}
    return flag(rules[rule])


def daily_flags(sales: DataFrame, value_from: str = k.VALUE_VECTOR, promo_rule: str = "discount>0") -> DataFrame:
    """The daily part of the hourly view, with the vector of its hours as ``_values``."""
    return sales.select(
        "city_id", "store_id", "product_id", "holiday_flag", "precpt", "discount", "dt",
        F.month("dt").alias("month"), dow_sunday0(F.col("dt")).alias("day_of_week"),
        flag(is_weekend_day(F.col("dt"))).alias("is_weekend"), promo_flag(promo_rule).alias("promo_flag"),
        flag(F.col("precpt") > 0).alias("is_rainy"), (F.col("stock_hour6_22_cnt") > 0).alias("_short"), F.col(value_from).alias("_values"))


def by_hour(daily: DataFrame) -> DataFrame:
    """The hourly view from its daily part. What stands beside an explode in one select is evaluated for every hour, so the daily
    columns come first."""
    hourly = daily.select(*[c for c in daily.columns if c != "_values"],
                          F.posexplode(parse_vector("_values")).alias("hour_of_day", "sale_amount_hour"))
    hour = F.col("hour_of_day")
    return hourly.select(
        "city_id", "store_id", "product_id", "holiday_flag", "precpt", "discount", "dt", "month", "day_of_week",
        "is_weekend", upper_bands(hour, k.PART_OF_DAY, inclusive=True).alias("part_of_day"), "promo_flag", "is_rainy",
        flag(F.col("sale_amount_hour") > 0).alias("activity_flag"),
        flag(hour.between(6, 22) & F.col("_short")).alias("stockout_risk_hour"), "sale_amount_hour", "hour_of_day")


def hourly_summary(sales: DataFrame, value_from: str = k.VALUE_VECTOR, promo_rule: str = "discount>0") -> DataFrame:
    """One row per store, product, day and hour with the flags used by the questions."""
    return by_hour(daily_flags(sales, value_from, promo_rule))


def hour_totals(sales: DataFrame, value_from: str = k.VALUE_VECTOR, promo_rule: str = "discount>0",
                hours: tuple[int, int] | None = None) -> DataFrame:
    """The hourly view folded back to one row per daily row, with sums over its hours.

    ``hours`` limits the fold to an inclusive range of hours, cut from the array before anything is counted.
    Questions that do not group by hour read this instead of 24 rows per day. Days without hours stay in with
    ``n_hours`` 0, as a filter on the parsed vector would be pushed below joins and parse every vector twice;
    ``group_hours`` leaves out groups that have no hours.
    """
    vector = parse_vector(value_from)
    if hours is not None:
        vector = F.slice(vector, hours[0] + 1, hours[1] - hours[0] + 1)
    held = sales.withColumns({"_v": vector, "promo_flag": promo_flag(promo_rule)})
    v = F.col("_v")
    return held.withColumns({
        "n_hours": F.coalesce(F.size(v), F.lit(0)).cast("bigint"), "n_known": count_known(v), "n_zero": count_zero(v),
        "n_positive": F.size(positives(v)).cast("bigint"), "units": vector_sum(v),
        "positive_units": vector_sum(positives(v)), "square_units": vector_squares(v),
        "low": F.array_min(v), "high": F.array_max(v),
    }).drop("_v")


def group_hours(df: DataFrame, keys: list, *measures: Column, weight: str = "n_hours") -> DataFrame:
    """Aggregate over hours: a group exists only if some of its days have hours."""
    return (df.groupBy(*keys).agg(F.sum(weight).alias("_hours"), *measures)
            .filter(F.col("_hours") > 0).drop("_hours"))


def distinct_with_hours(column: str, weight: str = "n_hours") -> Column:
    return F.countDistinct(F.when(F.col(weight) > 0, F.col(column)))


def store_dashboard(sales: DataFrame, value_from: str = k.VALUE_VECTOR, promo_rule: str = "discount>0") -> DataFrame:
    """18 measures per store over store, product, day and hour rows.

    Daily amounts count once per hour of the day, as they do in the established columns.
    """
    weight = F.coalesce(vector_length(value_from), F.lit(0)).cast("bigint")
    d = sales.select("store_id", "product_id", "dt", "sale_amount", promo_flag(promo_rule).alias("promo"),
                     F.dayofweek("dt").alias("_dow"), weight.alias("w"))
    s, w = F.col("sale_amount"), F.col("w")
    weekend = F.when(F.col("_dow").isin(1, 7), s).otherwise(0.0)
    weekday = F.when(F.col("_dow").between(2, 6), s).otherwise(0.0)
    sums = group_hours(
        d, ["store_id"],
        distinct_with_hours("product_id", "w").alias("num_products"), distinct_with_hours("dt", "w").alias("num_days_tracked"),
        F.sum(w).alias("observed_hours"), F.sum(s * w).alias("total_units"),
        F.sum(F.when(s > 0, w).otherwise(0)).alias("active_hours"),
        F.sum(F.when(s == 0, w).otherwise(0)).alias("stockout_hours"),
        F.sum(F.when(F.col("promo") == 1, s * w).otherwise(0.0)).alias("promo_units"),
        F.sum(F.when(F.col("promo") == 0, s * w).otherwise(0.0)).alias("non_promo_units"),
        weighted_stddev(s, w).alias("_deviation"), weighted_avg(s, w).alias("_mean"),
        weighted_avg(weekend, w).alias("avg_weekend_units"), weighted_avg(weekday, w).alias("avg_weekday_units"), weight="w")
    c = F.col
    return sums.select(
        "store_id", "num_products", "num_days_tracked", "observed_hours", "total_units",
        ratio(c("total_units"), c("observed_hours")).alias("units_per_hour"), "active_hours",
        ratio(c("total_units"), c("active_hours")).alias("units_per_active_hour"), "stockout_hours",
        (1 - ratio(c("stockout_hours"), c("observed_hours"))).alias("stock_availability_rate"),
        ratio(c("active_hours"), c("observed_hours")).alias("active_hour_ratio"),
        ratio(c("total_units"), c("num_days_tracked")).alias("units_per_day"),
        ratio(c("promo_units"), c("total_units")).alias("promo_share"), "promo_units", "non_promo_units",
        ratio(c("_deviation"), c("_mean")).alias("sales_cv"), "avg_weekend_units", "avg_weekday_units",
        ratio(c("avg_weekend_units"), c("avg_weekday_units")).alias("weekend_weekday_ratio"))


def category_intelligence(sales: DataFrame, value_from: str = k.VALUE_VECTOR, promo_rule: str = "discount>0",
                          by_promo: bool = True) -> DataFrame:
    """19 measures per category and promotion flag; ``by_promo=False`` groups by category alone,
    which is what makes the promotion lift meaningful."""
    h = hour_totals(sales, value_from, promo_rule).withColumn("_dow", F.dayofweek("dt"))
    c = F.col
    s, n = c("sale_amount"), c("n_hours")
    promo, holiday, weekend = c("promo_flag"), c("holiday_flag"), c("_dow").isin(1, 7)

    def hourly_avg(condition):
        return ratio(F.sum(F.when(condition, c("units"))), F.sum(F.when(condition, c("n_known"))))

    def daily_if(condition):
        return F.when(condition, s).otherwise(0.0)

    def hourly_deviation(condition):
        def masked(name):
            return F.when(condition, c(name)).otherwise(0.0)
        rows = F.sum(F.when(condition, c("n_known")).otherwise(n)).cast("double")
        return stddev_from_moments(rows, F.sum(masked("units")), F.sum(masked("square_units")),
                                   F.min(masked("low")), F.max(masked("high")))

    keys = [*k.CATEGORY, "promo_flag"] if by_promo else list(k.CATEGORY)
    sums = group_hours(
        h, keys,
        distinct_with_hours("store_id").alias("num_stores"), distinct_with_hours("product_id").alias("num_products"),
        F.sum(s * n).alias("toal_units"),
        F.sum(F.when(promo == 1, s * n).otherwise(0.0)).alias("promo_units"),
        F.sum(F.when(promo == 0, s * n).otherwise(0.0)).alias("non_promo_units"),
        F.sum(n).alias("observed_hours"), weighted_stddev(s, n).alias("sales_volatility"),
        F.sum("n_zero").alias("stockout_hours"),
        ratio(F.sum("positive_units"), F.sum("n_positive")).alias("_positive_mean"),
        hourly_avg(c("precpt") > 0).alias("avg_units_when_precip_is_more_than_zero"),
        weighted_avg(daily_if(holiday == 1), n).alias("avg_units_on_holidays"),
        weighted_avg(daily_if(holiday == 0), n).alias("avg_units_non_holidays"),
        hourly_avg(weekend).alias("_weekend"), hourly_avg(~weekend).alias("_weekday"),
        hourly_deviation(holiday == 1).alias("_holiday_deviation"),
        hourly_deviation(holiday == 0).alias("_plain_deviation"))
    return sums.select(
        *keys, "num_stores", "num_products", "toal_units", "promo_units", "non_promo_units",
        ratio(c("promo_units"), c("non_promo_units")).alias("promo_lift_index"), "observed_hours",
        ratio(c("toal_units"), c("observed_hours")).alias("avg_units_per_hour"), "sales_volatility", "stockout_hours",
        ratio(c("toal_units"), c("num_stores")).alias("units_per_store"),
        (1 - ratio(c("stockout_hours"), c("observed_hours"))).alias("stock_availability_rate"),
        F.coalesce(c("_positive_mean") * c("stockout_hours"), F.lit(0.0)).alias("lost_units_due_to_stockouts"),
        "avg_units_when_precip_is_more_than_zero", "avg_units_on_holidays", "avg_units_non_holidays",
        ratio(c("avg_units_on_holidays"), c("avg_units_non_holidays")).alias("holiday_lift_index"),
        ratio(c("_weekend"), c("_weekday")).alias("weekend_weekday_ratio"),
        ratio(c("_holiday_deviation"), c("_plain_deviation")).alias("holiday_vs_nonholiday_variability"))


RHYTHM_KEYS = ["hour_of_day", "day_of_week", "is_weekend", "months", "holiday_flag", "promo_flag"]


def rhythm_agg(sales: DataFrame, value_from: str = k.VALUE_VECTOR, promo_rule: str = "discount>0") -> DataFrame:
    """Seven measures per hour, weekday, month, holiday and promotion flag.

    The hourly sums group by calendar slots only, so each task ships a few thousand rows. Counting stores
    inside that aggregate would shuffle 24 rows per day instead; they are counted on the daily grain,
    where a store is active in every hour its longest vector of the slot reaches.
    """
    slots = {"day_of_week": dow_sunday0(F.col("dt")), "is_weekend": flag(is_weekend_day(F.col("dt"))),
             "months": F.month("dt"), "promo_flag": promo_flag(promo_rule)}
    daily_keys = RHYTHM_KEYS[1:]
    daily = sales.select("store_id", "precpt", "holiday_flag", *[e.alias(n) for n, e in slots.items()], value_from)

    value = F.col("v")
    hourly = (daily.select(*daily_keys, "precpt", F.posexplode(parse_vector(value_from)).alias("hour_of_day", "v"))
              .groupBy(*RHYTHM_KEYS)
              .agg(F.sum(value).alias("units"), F.count(value).alias("known"), F.count("*").alias("hours"),
                   F.count_if(value == 0).alias("zero"), F.sum("precpt").alias("rain"), F.count("precpt").alias("rain_n"),
                   F.lit(0).cast("bigint").alias("stores")))
    reach = (daily.select(*daily_keys, "store_id", vector_length(value_from).alias("w"))
             .groupBy(*daily_keys, "store_id").agg(F.max("w").alias("w")).filter(F.col("w") > 0)
             .groupBy(*daily_keys, "w").agg(F.count("store_id").alias("stores")))
    active = (reach.select(*daily_keys, F.explode(F.sequence(F.lit(0), F.col("w") - 1)).alias("hour_of_day"), "stores")
              .select(*RHYTHM_KEYS, F.lit(None).cast("double").alias("units"), F.lit(0).cast("bigint").alias("known"),
                      F.lit(0).cast("bigint").alias("hours"), F.lit(0).cast("bigint").alias("zero"),
                      F.lit(None).cast("double").alias("rain"), F.lit(0).cast("bigint").alias("rain_n"), "stores"))
    c = F.col
    return (hourly.unionByName(active).groupBy(*RHYTHM_KEYS)
            .agg(F.sum("units").alias("total_units"), F.sum("known").alias("_known"), F.sum("hours").alias("_hours"),
                 F.sum("zero").alias("stockout_hours"), F.sum("rain").alias("_rain"), F.sum("rain_n").alias("_rain_n"),
                 F.sum("stores").alias("num_active_stores"))
            .select(*RHYTHM_KEYS, "total_units", ratio(c("total_units"), c("_known")).alias("avg_units_per_hour"),
                    "stockout_hours", (1 - ratio(c("stockout_hours"), c("_hours"))).alias("stock_availability_rate"),
                    "num_active_stores", ratio(c("total_units"), c("num_active_stores")).alias("store_load_index"),
                    ratio(c("_rain"), c("_rain_n")).alias("avg_precip")))


def rhythm_patterns(sales: DataFrame, value_from: str = k.VALUE_VECTOR, promo_rule: str = "discount>0") -> DataFrame:
    """Slots classed against the mean of all slot means, one scalar subquery."""
    slots = keep(rhythm_agg(sales, value_from, promo_rule))
    level, centre = F.col("avg_units_per_hour"), slots.agg(F.avg("avg_units_per_hour")).scalar()
    return (slots.withColumn("_centre", centre)
            .withColumn("performance_class",
                        F.when(level > k.CLASS_HIGH_FACTOR * F.col("_centre"), k.CLASS_HIGH)
                        .when(level < k.CLASS_LOW_FACTOR * F.col("_centre"), k.CLASS_LOW)
                        .otherwise(k.CLASS_MEDIUM))
            .drop("_centre"))
