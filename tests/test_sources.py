import datetime as d

import pytest
from pyspark.sql import functions as F

from demandgrid.config import DataSettings
from demandgrid.functions.numeric import finite, ratio, round_half_even_2, whole_ratio
from demandgrid.operators import profile
from demandgrid.plans import views
from demandgrid.sources import sinks
from demandgrid.sources.sampling import sample_fraction, sample_rows
from demandgrid.sources.tables import load_report, load_sales, publish_views, read_sales, write_facts

KEYS = ["store_id", "product_id", "dt"]


def test_csv_pair(spark, sales, tmp_path):
    for name, part in (("train", sales.filter("dt < '2001-01-01'")), ("eval", sales.filter("dt >= '2001-01-01'"))):
        part.write.option("header", True).csv(str(tmp_path / name))
    settings = DataSettings(str(tmp_path / "train"), str(tmp_path / "eval"), fraction=1.0)
    train, test = load_sales(spark, settings)
    assert train.count() + test.count() == sales.count()
    assert sorted(map(tuple, train.unionAll(test).collect())) == sorted(map(tuple, sales.collect()))
    assert {r.split: r.n_rows for r in load_report(train, test).collect()} == {"train": train.count(), "eval": test.count()}
    part = load_sales(spark, DataSettings(str(tmp_path / "train"), str(tmp_path / "eval"), fraction=0.3))[0]
    assert 0.2 < part.count() / train.count() < 0.4
    with pytest.raises(ValueError):
        load_sales(spark, DataSettings())


def test_nan_becomes_null(spark, sales, tmp_path):
    path = str(tmp_path / "p")
    sales.limit(3).withColumn("precpt", F.lit(float("nan"))).write.parquet(path)
    assert read_sales(spark, path).filter("precpt is null").count() == 3


def test_samples_do_not_depend_on_partitions(sales):
    a = sample_fraction(sales, 0.2, KEYS).select(*KEYS).collect()
    b = sample_fraction(sales.repartition(7), 0.2, KEYS).select(*KEYS).collect()
    assert sorted(a) == sorted(b)
    assert sorted(a) != sorted(sample_fraction(sales, 0.2, KEYS, seed=1).select(*KEYS).collect())


@pytest.mark.parametrize("n", [0, 1, 500, 10**6])
def test_row_sample_is_exact_in_small_and_large_buckets(sales, n):
    rows = sales.select(*KEYS)
    a, b = (sorted(sample_rows(rows, n, KEYS, ranked=r).collect()) for r in (100_000, 0))
    assert a == b and len(a) == min(n, rows.count())


def test_views_answer_sql(spark, sales):
    publish_views(sales)
    assert spark.sql("select count(*) from store_performance_dashboard").first()[0] == 10
    assert spark.sql("select count(*) from business_rhythm_patterns where performance_class = 'High Intensity'").first()[0] > 0


def test_stored_facts_hold_parsed_vectors(spark, sales, tmp_path):
    write_facts(sales, str(tmp_path / "f"))
    back = spark.read.parquet(str(tmp_path / "f"))
    assert back.count() == sales.count() and back.filter(F.size("hours_sale") != 24).count() == 0
    plan = back.filter("sales_year = 1997")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sales_year" in plan


def test_segments_as_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, "High Performers")], "store_id long, cluster_name string")
    sinks.write_segments(df, str(tmp_path / "s"))
    assert spark.read.option("header", True).csv(str(tmp_path / "s")).first().cluster_name == "High Performers"


def test_fitted_tables_are_saved(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0)], "store_id long, value double")
    sinks.save_fitted(df, str(tmp_path / "t"))
    assert sinks.load_fitted(spark, str(tmp_path / "t")).collect() == df.collect()
    with pytest.raises(FileNotFoundError):
        sinks.load_fitted(spark, str(tmp_path / "missing"))


def test_profile_counts_copies_and_gaps(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (None, "b"), (None, None)], "x int, y string")
    assert profile.duplicate_rows(df).first()[0] == 2
    assert {r.column_name: r.n_missing for r in profile.missing_values(df).collect()} == {"x": 2, "y": 1}


def test_numbers(spark):
    df = spark.createDataFrame([(0.575, 7.0, 2.0), (0.125, -7.0, 2.0), (1.0, 1.0, 0.0)], "x double, a double, b double")
    rows = df.select(round_half_even_2(F.col("x")).alias("r"), ratio(F.col("a"), F.col("b")).alias("q"),
                     whole_ratio(F.col("a"), F.col("b")).alias("w")).collect()
    assert [tuple(r) for r in rows] == [(0.57, 3.5, 3), (0.12, -3.5, -3), (1.0, None, None)]
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (2.0,)], "x double")
    assert [r[0] for r in odd.select(finite(F.col("x"))).collect()] == [0.0, 1e10, -1e10, 2.0]


def test_scans_read_only_what_they_need(spark):
    """The first question needs two ids, so neither amounts nor vectors are read."""
    from demandgrid.plans.questions import q01
    from demandgrid.sources.fixtures import raw_sales
    # other tables than those the session holds in memory
    plan = q01(raw_sales(spark, "/root/testdata/sf0.01"))._jdf.queryExecution().executedPlan().toString()
    assert "l_quantity" not in plan and "l_returnflag" not in plan


def test_no_python_in_view_plans(spark, sales):
    for view in (views.hourly_summary, views.store_dashboard, views.category_intelligence, views.rhythm_patterns):
        plan = view(sales)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
