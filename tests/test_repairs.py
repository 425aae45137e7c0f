"""Cases that earlier versions got wrong: ties, NULL keys, infinities, settings read back, clamps."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from demandgrid import constants as k
from demandgrid.operators import prep, quantiles, regressors, segment, training
from demandgrid.operators.series import global_position, over_series
from demandgrid.plans import registry
from demandgrid.sources import sinks

SCHEMA = "store_id long, product_id long, dt date, y double"


def lagged(df, **options):
    rows = over_series(df, lambda spec: {"lag": F.lag("y").over(spec)}, 1, **options).collect()
    return sorted((str(r["dt"]), r["y"], -1.0 if r["lag"] is None else r["lag"]) for r in rows)


def test_equal_times_give_the_same_lags_on_every_path(spark):
    rows = [(1, 1, dt.date(2000, 1, 1 + i // 2), float(i * 7 % 10)) for i in range(20)]
    df = spark.createDataFrame(rows, SCHEMA)
    plain = lagged(df)
    assert plain == lagged(df, limit=5, block=5) == lagged(df.repartition(7).orderBy(F.desc("y")))


def test_rows_without_a_key_keep_their_place_in_the_table(spark):
    df = spark.createDataFrame([(1, 1, dt.date(2000, 1, 1), 1.0), (None, 1, dt.date(2000, 1, 1), 2.0), (1, None, dt.date(2000, 1, 1), 3.0)], SCHEMA)
    placed = over_series(df, lambda spec: {}, 0, position="_place")
    assert sorted((r["y"], r["n"]) for r in global_position(placed, "n").collect()) == [(1.0, 0), (2.0, None), (3.0, None)]


def test_quantiles_of_infinities_agree(spark):
    df = spark.createDataFrame([(float("inf"),)] * 4 + [(1.0,)], "x double")
    small = quantiles.exact_quantiles(df, ["x"], [0.5])
    assert small == quantiles.exact_quantiles(df, ["x"], [0.5], bins=2) == {"x": [float("inf")]}


def test_too_deep_trees_are_refused():
    with pytest.raises(ValueError, match="30"):
        regressors.estimator("decision_tree", "y", {"max_depth": 50})


def test_more_clusters_than_names(spark):
    df = spark.createDataFrame([(i, i % 6, float(i)) for i in range(12)], "store_id long, health_cluster int, total_units double")
    with pytest.raises(Exception, match="more clusters"):
        segment.cluster_names(df).collect()
    assert segment.cluster_names(df, names=list("abcdef")).filter("cluster_name IS NULL").count() == 0
    with pytest.raises(ValueError):
        segment.segment_stores(df, count=6)


@pytest.mark.parametrize("name", list(k.MODEL_GRIDS))
def test_every_tuned_winner_keeps_its_types(spark, tmp_path, name):
    path = str(tmp_path / "best")
    for i, row in enumerate(training.grid_rows(k.MODEL_GRIDS[name])[::7] + [{"fit_intercept": False, "max_depth": None}]):
        table = spark.createDataFrame([(name, {p: json.dumps(v) for p, v in row.items()}, 1.0, True)],
                                      "model_name string, params map<string,string>, mae double, is_best boolean")
        sinks.save_best_settings(table, f"{path}{i}")
        assert sinks.read_best_settings(spark, f"{path}{i}", name) == row


def test_medians_of_columns_full_of_nan_or_infinities(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(nan, inf, float(i), float(i)) for i in range(7)] + [(float(i), 2.0, float(i), float(i)) for i in range(4)]
    df = spark.createDataFrame(rows, "a double, b double, c double, y double")
    assert prep.fit_medians(df, ["a"]) == {"a": 1.5}
    for scaling in (None, "standard", "robust"):
        model = regressors.fit_model("linear", df, ["a", "b", "c"], "y", scaling=scaling)
        assert model.predict(df).filter("prediction IS NULL OR isnan(prediction)").count() == 0


def test_fitted_models_come_back_whole(spark, tmp_path):
    df = spark.createDataFrame([(float(i), 2.0 * i) for i in range(9)], "x double, y double")
    model = regressors.fit_model("ridge", df, ["x"], "y", {"alpha": 0.5})
    sinks.save_fitted_model(model, str(tmp_path / "m"))
    loaded = sinks.load_fitted_model(str(tmp_path / "m"))
    assert (loaded.name, loaded.features, loaded.settings) == ("ridge", ["x"], {"alpha": 0.5})
    assert loaded.coefficients(spark).collect() == model.coefficients(spark).collect()
    assert loaded.predict(df).collect() == model.predict(df).collect()


def test_seasonal_naive_is_a_model_of_the_factory(spark, sales):
    few = sales.filter("store_id <= 2").select("store_id", "product_id", "dt", "sale_amount")
    train, test = few.filter("dt < '2001-01-01'"), few.filter("dt >= '2001-01-01'")
    runs = training.train_all(train, test, names=["mean", "seasonal_naive"])
    assert sorted(r["model_name"] for r in runs.collect()) == ["mean", "seasonal_naive"]


@pytest.mark.parametrize("query, name", [("ml_forest", "random_forest"), ("ml_gbt", "gradient_boosting"), ("ml_boost_cols", "boost_cols")])
def test_registered_ensembles_have_the_configured_size(spark, monkeypatch, query, name):
    class Fitted(Exception):
        pass

    def fit(model, train, features, **options):
        raise Fitted(model, options["settings"])

    rows = spark.createDataFrame([(1.0, 2.0)], "x double, sale_amount double")
    monkeypatch.setattr(registry, "feature_tables", lambda spark, folder: (rows, rows))
    monkeypatch.setattr(regressors, "fit_model", fit)
    with pytest.raises(Fitted) as told:
        registry.build()[query](spark, "")
    assert told.value.args == (name, k.MODEL_SETTINGS[name])
