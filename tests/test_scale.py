"""Work per row and per task that must not follow the size of the tables."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as driver
from conftest import SMALL
from demandgrid import constants as k
from demandgrid.functions.numeric import round_fraction
from demandgrid.functions.vectors import TOKEN, parse_vector, vector_length
from demandgrid.operators import prep, quantiles, regressors
from demandgrid.plans import registry, views


def test_plans_read_small_partitions_and_leave_the_corpus_settings_alone(spark):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.unset(name)
    given = spark.conf.get(name)
    driver.queries()["view_store_dashboard"](spark, SMALL)
    assert spark.conf.get(name) == "16m" and spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    driver.queries()["op6_secrets"](spark, SMALL)
    assert spark.conf.get(name) == given and spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "65535"


def test_plans_read_small_parts_of_files(spark):
    """The first aggregate of the daily facts holds what a task reads, so tables of any size are read in parts of 16 MB."""
    name = "spark.sql.files.maxPartitionBytes"
    given = spark.conf.get(name)
    try:
        driver.queries()["view_store_dashboard"](spark, SMALL)
        assert spark.conf.get(name) == "16m"
        driver.queries()["op6_secrets"](spark, SMALL)
        assert spark.conf.get(name) == given
        spark.conf.set(name, "1m")
        driver.queries()["view_store_dashboard"](spark, SMALL)
        assert spark.conf.get(name) == "1m"
    finally:
        spark.conf.set(name, given)


def test_hours_carry_daily_columns_made_once(spark, sales):
    plan = views.hourly_summary(sales)._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("Generate")]
    assert "month(" not in above and "dayofweek(" not in above


def test_hourly_query_rounds_days_before_hours(spark):
    plan = registry.view_hourly_summary(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"round\((precpt|discount)", plan[:plan.index("Generate")])


def test_rounding_equals_round(spark):
    values = [0.0, -0.0, 1.0, -7.0, 0.5, 1 / 3, -2.0000005, 123456.7890125, 1e300, 2.0**60, float("inf"), float("-inf"), float("nan"), None]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    for places in (0, 2, 6):
        found = rows.select(F.round("x", places).alias("a"), round_fraction("x", places).alias("b")).collect()
        assert [repr(r.a) for r in found] == [repr(r.b) for r in found]


def test_vectors_equal_the_pattern(spark):
    texts = ["[0 1 0]", "[0, 1]", "[0  1]", "[ 0 1 ]", "[]", "", None, "[1]", "[", "]", "0 1", "[0\n1]", "[0\t1]", "[1 x 2.5]", "[[1 2]]", "[1 2] [3]",
             "[1 2", "[1\x0b2\f3\r4]", "[ ]", "[1 -0.0 1e3 NaN]", "[ä 1]", "[1 2]\n"]
    rows = spark.createDataFrame([(t,) for t in texts], "v string")
    tokens = F.regexp_extract_all("v", F.lit(TOKEN), F.lit(0))
    for r in rows.select("v", tokens.try_cast("array<double>").alias("a"), parse_vector("v").alias("b"),
                         F.regexp_count("v", F.lit(TOKEN)).alias("n"), vector_length("v").alias("m")).collect():
        assert (repr(r.a), r.n) == (repr(r.b), r.m), r.v


def test_hours_sold_are_formatted_as_whole_numbers(spark, sales):
    """Amounts of an hour: the whole part of a 24th, and one more where the remainder reaches."""
    assert "lambda" not in registry.raw_sales(spark, SMALL).select("hours_sale")._jdf.queryExecution().optimizedPlan().toString()
    for r in sales.select("store_id", "sale_amount", "hours_sale").limit(500).collect():
        q = int(r.sale_amount)
        assert r.hours_sale == "[" + " ".join(str(q // 24 + ((h + r.store_id) % 24 < q % 24)) for h in range(24)) + "]"


def test_facts_are_written_once_for_both_runs(spark, monkeypatch):
    calls, write = [], registry.written
    monkeypatch.setattr(registry, "written", lambda df, name: calls.append((name, df.columns)) or write(df, name))
    assert registry.snk_results(spark, SMALL).count() == 2
    assert calls == [("daily", [*registry.KEYS, k.TARGET])]


def test_boosting_passes_over_even_parts(spark):
    rows = spark.range(4000).filter("id >= 1000").coalesce(1).select(F.col("id").cast("double").alias("x"), F.rand(1).alias("label"))
    prepared = prep.prepare(rows, ["x"], "label", regressors.INPUT, None, dealt=True)
    sizes = prepared.rows.rdd.glom().map(len).collect()
    prepared.held.unpersist()
    assert sum(sizes) == 3000 and len(sizes) >= 2 * spark.sparkContext.defaultParallelism and max(sizes) - min(sizes) <= len(sizes)


def test_only_deep_trees_keep_node_ids():
    settings = {"n_estimators": 2, "learning_rate": 0.1, "max_depth": 5}
    assert not regressors.estimator("gradient_boosting", "y", settings).getCacheNodeIds()
    assert regressors.estimator("random_forest", "y", {"n_estimators": 2, "max_depth": 20}).getCacheNodeIds()


def test_spans_of_quantiles_need_no_python(spark):
    rows = spark.createDataFrame([(1.0, 0), (float("nan"), 0), (None, 1), (float("inf"), 1), (-0.0, None), (-7.0, 1)], "x double, g int")
    ranges = [quantiles.Range(0, None), quantiles.Range(0, 1), quantiles.Range(0, 0)]
    assert quantiles._spans(rows, ["x"], ranges, "g", 1e9) == {0: (4, -7.0, 1e9), 1: (2, 0.0, 1.0), 2: (3, -7.0, 1e9)}
    assert quantiles._spans(rows, ["x"], ranges[:1], None, None) == {0: (5, -7.0, quantiles.LARGEST)}
    assert quantiles._spans(rows.filter("x is null"), ["x"], ranges[:1], None, None) == {}


def test_feature_tables_leave_texts_and_unread_rows_behind(spark, monkeypatch, tmp_path):
    """A model that reads the training rows alone makes them alone, without the texts of hours, and with the same values."""
    names, write = [], registry.written
    monkeypatch.setattr(registry, "_FEATURE_TABLES", {})
    monkeypatch.setattr(registry, "_FEATURE_FITS", {})
    monkeypatch.setattr(registry, "written", lambda df, name: names.append(name) or write(df, name))
    found = registry.training_features(spark, SMALL)
    assert names == ["train-features"] and not {k.SALE_VECTOR, k.VALUE_VECTOR} & set(found.columns)
    train, _ = registry.split_sales(registry.raw_sales(spark, SMALL))
    whole = registry.feature_set.engineer(train, registry.feature_set.fit_features(train))
    assert {*whole.columns} - {*found.columns} == {k.SALE_VECTOR, k.VALUE_VECTOR}
    assert found.exceptAll(whole.select(*found.columns)).count() == 0 and found.count() == whole.count()
    registry.feature_tables(spark, SMALL)
    assert names == ["train-features", "eval-features"]
