import datetime as d

import pytest
from pyspark.sql import functions as F

from demandgrid.operators.ranks import dense_rank_desc
from demandgrid.plans import questions as q, views
from demandgrid.schema import SALES_SCHEMA

SUNDAY, MONDAY = d.date(2001, 1, 7), d.date(2001, 1, 8)
BASE = dict(city_id=1, store_id=1, management_group_id=1, first_category_id=1, second_category_id=1, third_category_id=1,
            product_id=1, dt=MONDAY, sale_amount=1.0, hours_sale="[1 2]", stock_hour6_22_cnt=0, hours_stock_status="[0 1]",
            discount=1.0, holiday_flag=0, activity_flag=1, precpt=0.0, avg_temperature=5.0, avg_humidity=1.0, avg_wind_level=1.0)


def facts(spark, *rows):
    return spark.createDataFrame([{**BASE, **r} for r in rows], SALES_SCHEMA)


def exploded(sales):
    return views.hourly_summary(sales).join(
        sales.select("store_id", "product_id", "dt", "sale_amount", "first_category_id"), ["store_id", "product_id", "dt"])


def test_dashboard_equals_the_exploded_computation(spark):
    """Vectors of different lengths, so that the weight differs by row."""
    sales = facts(spark, dict(sale_amount=3.0, hours_stock_status="[0 1 1]"), dict(dt=SUNDAY, sale_amount=0.5),
                  dict(product_id=2, sale_amount=0.0, hours_stock_status="[0]"), dict(product_id=3, hours_stock_status=None),
                  dict(store_id=2, hours_stock_status=""))
    got = views.store_dashboard(sales).collect()
    assert [r.store_id for r in got] == [1]
    want = exploded(sales).agg(F.count("*").alias("n"), F.sum("sale_amount").alias("s"),
                               (F.stddev("sale_amount") / F.avg("sale_amount")).alias("cv"),
                               F.countDistinct("product_id").alias("p")).first()
    assert (got[0].observed_hours, got[0].total_units, got[0].num_products) == (want.n, want.s, want.p)
    assert got[0].sales_cv == pytest.approx(want.cv, abs=1e-12)


def test_zero_denominators_give_null(spark):
    sales = facts(spark, dict(sale_amount=0.0), dict(sale_amount=0.0, product_id=2))
    row = views.store_dashboard(sales).first()
    assert row.units_per_active_hour is None and row.promo_share is None and row.sales_cv is None
    assert row.weekend_weekday_ratio is None
    intel = views.category_intelligence(facts(spark, dict(hours_stock_status="[0 0]"))).first()
    assert intel.promo_lift_index is None and intel.holiday_vs_nonholiday_variability is None


def test_constant_group_has_deviation_zero(spark):
    sales = facts(spark, *[dict(sale_amount=0.1, dt=MONDAY + d.timedelta(i), hours_stock_status="[0.1 0.1 0.1]") for i in range(7)])
    assert views.category_intelligence(sales).first().sales_volatility == 0.0


def test_missing_amounts(spark):
    sales = facts(spark, dict(sale_amount=None), dict(sale_amount=2.0, product_id=2))
    row = views.store_dashboard(sales).first()
    assert (row.observed_hours, row.total_units, row.active_hours, row.stockout_hours) == (4, 4.0, 2, 0)


@pytest.mark.parametrize("discount,label", [(1.0, "0% (No discount)"), (0.99, "21%+"), (0.95, "1–10%"), (0.91, "1–10%"),
                                            (0.90, "21%+"), (0.85, "21%+"), (0.80, "11–20%"), (0.1, "11–20%"), (None, "21%+")])
def test_discount_range(spark, discount, label):
    df = spark.createDataFrame([(discount,)], "x double")
    assert df.select(q.discount_range(F.col("x"))).first()[0] == label


@pytest.mark.parametrize("discount,label", [(1.0, "0% (No discount)"), (0.99, "1–10%"), (0.90, "1–10%"), (0.85, "11–20%"),
                                            (0.80, "11–20%"), (0.79, "21%+"), (None, None)])
def test_proper_discount_bands(spark, discount, label):
    df = spark.createDataFrame([(discount,)], "x double")
    assert df.select(q.discount_bands(F.col("x"))).first()[0] == label


def test_temperature_edges(spark):
    sales = facts(spark, *[dict(avg_temperature=t, product_id=i, first_category_id=i)
                           for i, t in enumerate([9.9, 10.0, 20.0, 30.0, None])])
    got = {r.first_category_id: r.temperature_range for r in q.q27(sales).collect()}
    assert got == {0: "Cold", 1: "Mild", 2: "Warm", 3: "Hot", 4: "Hot"}


def test_part_of_day_edges(spark):
    vector = "[" + " ".join(["1"] * 24) + "]"
    got = {r.hour_of_day: r.part_of_day for r in views.hourly_summary(facts(spark, dict(hours_stock_status=vector))).collect()}
    assert [got[h] for h in (0, 5, 6, 11, 12, 15, 16, 19, 20, 23)] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]


def test_stockout_risk_needs_the_day_count(spark):
    vector = "[" + " ".join(["1"] * 24) + "]"
    sales = facts(spark, dict(hours_stock_status=vector, stock_hour6_22_cnt=3))
    risk = {r.hour_of_day for r in views.hourly_summary(sales).filter("stockout_risk_hour = 1").collect()}
    assert risk == set(range(6, 23))


def test_rhythm_counts_stores_by_hour_reached(spark):
    sales = facts(spark, dict(hours_stock_status="[1 1 1]"), dict(store_id=2, hours_stock_status="[1]"), dict(store_id=3, hours_stock_status=""))
    got = {r.hour_of_day: (r.num_active_stores, r.total_units) for r in views.rhythm_agg(sales).collect()}
    assert got == {0: (2, 2.0), 1: (1, 1.0), 2: (1, 1.0)}


def test_options(spark):
    sales = facts(spark, dict(discount=0.8), dict(product_id=2))
    assert {r.promo_flag for r in views.hourly_summary(sales).collect()} == {1}
    assert {r.promo_flag for r in views.hourly_summary(sales, promo_rule="discount<1").collect()} == {0, 1}
    assert q.q21(sales, value_from="hours_sale").first().avg_sales == 1.5
    lift = views.category_intelligence(sales, promo_rule="discount<1", by_promo=False).first().promo_lift_index
    assert lift == 1.0
    assert q.q11(sales, integer_division=True).first()[0] == 0


def test_question_12_without_zero_hours(spark):
    got = {r.sales: r.average for r in q.q12(facts(spark, dict(hours_stock_status="[2 4]"))).collect()}
    assert list(got.values()) == [3.0, None]


def test_in_stock_mean_is_null_first(spark):
    sales = facts(spark, dict(hours_stock_status="[0 0]"), dict(product_id=2, hours_stock_status="[0 3]"))
    assert [r.product_id for r in q.q26(sales).collect()] == [1, 2]


def test_band_totals_add_up(sales):
    bands = q.q22(sales).agg(F.sum("sums")).first()[0]
    assert bands == q.q07(sales).agg(F.sum("total_sales")).first()[0]


def test_dense_rank_over_ranges(spark):
    rows = [(i, float(v)) for i, v in enumerate([5, 3, 3, 9, 1, 9, 2, 2, 2, 7])] + [(10, None)]
    df = spark.createDataFrame(rows, "id int, v double")
    want = {r.id: r.rnk for r in df.selectExpr("id", "dense_rank() over (order by v desc nulls first) as rnk").collect()}
    assert {r.id: r.rnk for r in dense_rank_desc(df, "v", buckets=4).collect()} == want


def test_partitioning_does_not_matter(spark, sales):
    one, many = views.store_dashboard(sales.coalesce(1)), views.store_dashboard(sales.repartition(13))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, many.collect()))
