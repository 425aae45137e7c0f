"""The numbered business questions. Each takes the fact table and returns its answer as a DataFrame.

Ties in a top-k are broken by key so that the answer is always the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import constants as k
from ..functions.calendar import dow_sunday0, flag, upper_bands
from ..functions.numeric import ratio, whole_ratio
from ..operators.hourly import unnest_hours
from ..operators.ranks import dense_rank_desc
from ..session import keep
from .views import category_intelligence, group_hours, hour_totals, hourly_summary, rhythm_patterns, store_dashboard


def _share(a: str, b: str, integer_division: bool = False) -> Column:
    return (whole_ratio if integer_division else ratio)(F.col(a), F.col(b))


def q01(sales: DataFrame, approx: bool = False) -> DataFrame:
    distinct = F.approx_count_distinct if approx else F.countDistinct
    return sales.agg(distinct("store_id").alias("num_stores"), distinct("city_id").alias("num_cities"))


def q02(sales: DataFrame) -> DataFrame:
    return sales.agg(F.max("dt").alias("last_dt"), F.min("dt").alias("first_dt"))


def q03(sales: DataFrame, approx: bool = False) -> DataFrame:
    distinct = F.approx_count_distinct if approx else F.countDistinct
    return sales.agg(distinct("product_id").alias("num_products"), *[distinct(c).alias(f"num_{c}s") for c in k.CATEGORY])


def q04(sales: DataFrame) -> DataFrame:
    return sales.agg(F.sum("sale_amount").alias("total_sales"))


def q05(sales: DataFrame) -> DataFrame:
    return sales.agg(ratio(F.sum("sale_amount"), F.count("*") * 24).alias("avg_sales_per_hour"))


def q06(sales: DataFrame) -> DataFrame:
    """Labels speak of sales, the counts are of stock-out hours."""
    return sales.agg(F.count_if(F.col("stock_hour6_22_cnt") == 0).alias("zero_sales"),
                     F.count_if(F.col("stock_hour6_22_cnt") > 0).alias("non_zero_sales"))


def q07(sales: DataFrame, value_from: str = k.VALUE_VECTOR) -> DataFrame:
    """The hour counts from 1 here."""
    return (unnest_hours(sales.select(value_from), value_from)
            .groupBy(F.col("hour_index").alias("hour_of_day")).agg(F.sum("val").alias("total_sales")).orderBy("hour_of_day"))


def q08(sales: DataFrame) -> DataFrame:
    return sales.groupBy(dow_sunday0(F.col("dt")).alias("weekday")).agg(F.sum("sale_amount").alias("total_sales"))


def q09(sales: DataFrame) -> DataFrame:
    return sales.groupBy("holiday_flag").agg(F.avg("sale_amount").alias("avgsales"))


def q10(sales: DataFrame) -> DataFrame:
    return sales.groupBy(flag(F.col("precpt") > 0).alias("is_rainy")).agg(F.avg("sale_amount").alias("avg_sales"))


def t3a(sales: DataFrame, **options) -> DataFrame:
    """Weekend and promotion hours by city. Both filters act on daily rows, before any vector is read."""
    kept = hour_totals(sales.filter(F.dayofweek("dt").isin(1, 7)), **options).filter(F.col("promo_flag") == 1)
    return group_hours(kept, ["city_id"], F.sum("units").alias("total_units"))


def t3c(sales: DataFrame, availability: float = 0.2, lift: float = 1.2, **options) -> DataFrame:
    """Categories that are seldom in stock and sell more on holidays."""
    return (category_intelligence(sales, **options)
            .filter((F.col("stock_availability_rate") < availability) & (F.col("holiday_lift_index") > lift)).select(*k.CATEGORY))


def t3d(sales: DataFrame, **options) -> DataFrame:
    return (rhythm_patterns(sales, **options).filter(F.col("performance_class") == k.CLASS_HIGH)
            .select("hour_of_day", "day_of_week", "is_weekend", "months", "holiday_flag", "promo_flag", "avg_units_per_hour",
                    "total_units", "num_active_stores", "store_load_index", "performance_class")
            .orderBy(F.desc("avg_units_per_hour"), "months", "day_of_week", "hour_of_day", "holiday_flag", "promo_flag")
            .drop("months"))


def q11(sales: DataFrame, integer_division: bool = False) -> DataFrame:
    return store_dashboard(sales).select(
        _share("stockout_hours", "observed_hours", integer_division).alias("total_hours_experienced_stockouts"))


def q12(sales: DataFrame, **options) -> DataFrame:
    """Both means come from one pass; the second is 0 by its own condition, or NULL without such hours."""
    sums = hour_totals(sales, **options).agg(F.sum("positive_units").alias("units"), F.sum("n_positive").alias("n"),
                                             F.sum("n_zero").alias("zero"))
    rows = F.array(
        F.struct(F.lit(k.LABEL_POSITIVE_HOURS).alias("sales"), ratio(F.col("units"), F.col("n")).alias("average")),
        F.struct(F.lit(k.LABEL_ZERO_HOURS).alias("sales"), F.when(F.col("zero") > 0, F.lit(0.0)).alias("average")))
    return sums.select(F.inline(rows))


def q13(sales: DataFrame, top: int = 10, **options) -> DataFrame:
    """The first rows by rate are taken before they are ranked: a dense rank looks only upwards."""
    rates = (group_hours(hour_totals(sales, **options), [F.col("product_id").alias("product")],
                         ratio(F.sum("n_zero"), F.sum("n_hours")).alias("stockout_rate"))
             .orderBy(F.desc_nulls_first("stockout_rate"), "product").limit(top))
    return rates.selectExpr("*", "dense_rank() over (order by stockout_rate desc nulls first) as rnk")


def q14(sales: DataFrame, **options) -> DataFrame:
    """Zero value and activity exclude each other, so the rate is 0 in every hour."""
    hit = (F.col("sale_amount_hour") == 0) & (F.col("activity_flag") == 1)
    return (hourly_summary(sales, **options).groupBy("hour_of_day")
            .agg(ratio(F.count_if(hit), F.count("*")).alias("stockout_rate_by_hour")))


def q15(sales: DataFrame, top: int = 5) -> DataFrame:
    return (store_dashboard(sales).select("store_id", "stockout_hours", "observed_hours", "stock_availability_rate")
            .orderBy(F.desc("stockout_hours"), "store_id").limit(top))


def q16(sales: DataFrame, top: int = 10) -> DataFrame:
    return (store_dashboard(sales).select("store_id", "total_units")
            .orderBy(F.desc_nulls_first("total_units"), "store_id").limit(top))


def q17(sales: DataFrame, **options) -> DataFrame:
    stores = group_hours(hour_totals(sales, **options), ["city_id", "store_id"], F.sum("units").alias("units"))
    return (stores.groupBy("city_id").agg(F.avg("units").alias("avg_store_units"))
            .orderBy(F.desc_nulls_first("avg_store_units"), "city_id"))


def q18(sales: DataFrame) -> DataFrame:
    return store_dashboard(sales).select("store_id", "total_units",
                                         _share("stockout_hours", "observed_hours").alias("stockout_share"),
                                         "stock_availability_rate")


def _top_categories(sales: DataFrame, columns: list[str], top: int) -> DataFrame:
    return (category_intelligence(sales).orderBy(F.desc_nulls_first("toal_units"), *k.CATEGORY, "promo_flag").limit(top)
            .select(*k.CATEGORY, *columns))


def q19(sales: DataFrame, top: int = 10) -> DataFrame:
    return _top_categories(sales, ["toal_units"], top)


def q20(sales: DataFrame, **options) -> DataFrame:
    means = group_hours(hour_totals(sales, **options), ["product_id"],
                        ratio(F.sum("units"), F.sum("n_known")).alias("sales"))
    return dense_rank_desc(keep(means), "sales")


def q21(sales: DataFrame, **options) -> DataFrame:
    return group_hours(hour_totals(sales, **options), ["promo_flag"],
                       ratio(F.sum("units"), F.sum("n_known")).alias("avg_sales"))


def discount_range(c: Column) -> Column:
    """The established bands: 0.80-0.90 and 0.99-1 fall to the last label, everything up to 0.80 to the third."""
    return (F.when(c == 1, k.BAND_NONE).when((c > 0.90) & (c < 0.99), k.BAND_LOW)
            .when(c <= 0.80, k.BAND_MID).otherwise(k.BAND_HIGH))


def discount_bands(c: Column, edges: tuple[float, float] = (0.90, 0.80)) -> Column:
    """Bands as their labels read: 1 is full price, then down to the two edges, then below."""
    return (F.when(c >= 1, k.BAND_NONE).when(c >= edges[0], k.BAND_LOW).when(c >= edges[1], k.BAND_MID)
            .when(c.isNotNull(), k.BAND_HIGH))


def q22(sales: DataFrame, banding=discount_range, **options) -> DataFrame:
    return group_hours(hour_totals(sales, **options), [banding(F.col("discount")).alias("ranges")],
                       F.sum("units").alias("sums")).select("sums", "ranges")


def q23(sales: DataFrame, top: int = 10) -> DataFrame:
    return _top_categories(sales, ["promo_units", "non_promo_units", "toal_units"], top)


def q24(sales: DataFrame, **options) -> DataFrame:
    """Hours with and without activity come from the same daily sums."""
    c = F.col
    sides = F.array(
        F.struct(F.lit(0).alias("activity_flag"), (c("n_hours") - c("n_positive")).alias("hours"),
                 (c("n_known") - c("n_positive")).alias("known"), (c("units") - c("positive_units")).alias("units")),
        F.struct(F.lit(1).alias("activity_flag"), c("n_positive").alias("hours"), c("n_positive").alias("known"),
                 c("positive_units").alias("units")))
    return (hour_totals(sales, **options).select(F.inline(sides)).filter(c("hours") > 0)
            .groupBy("activity_flag").agg(ratio(F.sum("units"), F.sum("known")).alias("avg_sales")))


def q25(sales: DataFrame, **options) -> DataFrame:
    return q21(sales, **options)


def q26(sales: DataFrame, top: int = 5, integer_division: bool = False, **options) -> DataFrame:
    sums = group_hours(hour_totals(sales, **options), k.SERIES,
                       ratio(F.sum("positive_units"), F.sum("n_positive")).alias("avg_in_stock_sales"),
                       F.sum("n_zero").alias("zero"), F.sum("n_hours").alias("hours"))
    return (sums.select(*k.SERIES, "avg_in_stock_sales", _share("zero", "hours", integer_division).alias("stockout_rate"))
            .orderBy(F.desc_nulls_first("avg_in_stock_sales"), *k.SERIES).limit(top))


def q27(sales: DataFrame, **options) -> DataFrame:
    band = upper_bands(F.col("avg_temperature"), k.TEMPERATURE_BANDS, k.TEMPERATURE_TOP)
    return (group_hours(hour_totals(sales, **options), [band.alias("temperature_range"), *k.CATEGORY],
                        F.sum("units").alias("total")).orderBy("temperature_range", *k.CATEGORY))


def q28(sales: DataFrame, hours: tuple[int, int] = (8, 10), integer_division: bool = False, **options) -> DataFrame:
    sums = group_hours(hour_totals(sales, hours=hours, **options), ["product_id"],
                       F.sum("n_hours").alias("total_hours"), F.sum("n_zero").alias("stockout"))
    return sums.withColumn("stockout_rate", _share("stockout", "total_hours", integer_division))


def q29(sales: DataFrame) -> DataFrame:
    return category_intelligence(sales).select("lost_units_due_to_stockouts")


ALL = {name: f for name, f in list(globals().items())
       if callable(f) and (name in ("t3a", "t3c", "t3d") or (name[0] == "q" and name[1:].isdigit()))}
