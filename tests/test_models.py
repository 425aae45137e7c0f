import datetime as d
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandgrid.operators import evaluate as ev, naive, prep, regressors, segment, training, validate
from demandgrid.sources import sinks

FEATURES = ["x1", "x2", "x3"]


@pytest.fixture(scope="module")
def matrix(spark):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        x = [rng.gauss(2, 3), rng.gauss(0, 1), float(rng.randint(0, 4))]
        rows.append((*x, 4 + 2 * x[0] - 1.5 * x[1] + rng.gauss(0, 0.5), i))
    return spark.createDataFrame(rows, "x1 double, x2 double, x3 double, label double, i int")


def arrays(matrix):
    p = matrix.orderBy("i").toPandas()
    x, y = p[FEATURES].to_numpy(), p["label"].to_numpy()
    return (x - x.mean(0)) / x.std(0), y


def coefficients(model, spark):
    return {r.feature: r.coefficient for r in model.coefficients(spark).collect()}


def fit(name, matrix, **settings):
    return regressors.fit_model(name, matrix, FEATURES, "label", settings)


def test_least_squares(spark, matrix):
    z, y = arrays(matrix)
    want, *_ = np.linalg.lstsq(np.c_[z, np.ones(len(y))], y, rcond=None)
    got = coefficients(fit("linear", matrix), spark)
    assert [got[c] for c in [*FEATURES, "intercept"]] == pytest.approx(want, abs=1e-6)


def test_intercept_setting_is_honoured(spark, matrix):
    assert coefficients(fit("linear", matrix, fit_intercept=False), spark)["intercept"] == 0.0


def test_ridge(spark, matrix):
    z, y = arrays(matrix)
    want = np.linalg.solve(z.T @ z + 10 * np.eye(3), z.T @ (y - y.mean()))
    got = coefficients(fit("ridge", matrix, alpha=10.0), spark)
    assert [got[c] for c in FEATURES] == pytest.approx(want, abs=1e-6)


def descent(z, y, alpha, l1):
    w, n, r = np.zeros(z.shape[1]), len(y), y - y.mean()
    for _ in range(2000):
        for j in range(len(w)):
            rho = z[:, j] @ (r - z @ w + z[:, j] * w[j]) / n
            w[j] = np.sign(rho) * max(abs(rho) - alpha * l1, 0) / (z[:, j] @ z[:, j] / n + alpha * (1 - l1))
    return w


@pytest.mark.parametrize("name,l1", [("lasso", 1.0), ("elasticnet", 0.3)])
def test_l1_models(spark, matrix, name, l1):
    z, y = arrays(matrix)
    got = coefficients(fit(name, matrix, alpha=0.5, **({"l1_ratio": l1} if name == "elasticnet" else {})), spark)
    assert [got[c] for c in FEATURES] == pytest.approx(descent(z, y, 0.5, l1), abs=1e-5)


@pytest.mark.parametrize("name,settings", [("decision_tree", {}), ("random_forest", {"n_estimators": 10, "max_depth": 5}),
                                           ("gradient_boosting", {"n_estimators": 10, "max_depth": 3}),
                                           ("boost_cols", {"n_estimators": 10, "max_depth": 3})])
def test_trees_find_the_signal(spark, matrix, name, settings):
    model = fit(name, matrix, **settings)
    out = model.predict(matrix)
    error, spread = out.agg(F.avg(F.abs(F.col("label") - F.col("prediction"))), F.avg(F.abs(F.col("label") - 7.4))).first()
    assert error < spread / 2 and out.filter("prediction < 0").count() == 0
    assert model.importance(spark).orderBy(F.desc("importance")).first().feature == "x1"
    assert model.r2(matrix, "label") > 0.6


def test_save_and_load(spark, matrix, tmp_path):
    model, path = fit("lasso", matrix, alpha=0.1), str(tmp_path / "m")
    sinks.save_model(model.pipeline, path)
    a = model.predict(matrix).orderBy("i").select("prediction").collect()
    b = sinks.load_model(path).transform(matrix).orderBy("i").select("prediction").collect()
    assert a == b
    with pytest.raises(FileNotFoundError):
        sinks.load_model(str(tmp_path / "none"))
    with pytest.raises(ValueError):
        sinks.save_model(None, path)


def test_missing_and_infinite_inputs(spark, matrix):
    holes = matrix.withColumn("x2", F.when(F.col("i") % 3 > 0, F.col("x2"))).withColumn("empty", F.lit(None).cast("double"))
    model = regressors.fit_model("linear", holes, [*FEATURES, "empty"], "label")
    assert model.features == FEATURES
    odd = spark.createDataFrame([(float("inf"), None, 1.0), (float("nan"), 0.0, None)], "x1 double, x2 double, x3 double")
    assert all(math.isfinite(r.prediction) for r in model.predict(odd.withColumn("empty", F.lit(None).cast("double"))).collect())


@pytest.mark.parametrize("scaling", ["standard", "robust", None])
def test_scalings_predict_the_same(matrix, scaling):
    model = regressors.fit_model("linear", matrix, FEATURES, "label", scaling=scaling)
    assert model.r2(matrix, "label") > 0.98


def test_robust_values(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 100)], "x double")
    fits = prep.fit_columns(df, ["x"], "robust")
    assert (fits["x"].centre, fits["x"].spread) == (3.0, 2.0)


def test_unknown_names():
    with pytest.raises(ValueError):
        regressors.estimator("forest of wonders", "y")
    with pytest.raises(ValueError):
        naive.fit_naive(None, "guess")


# naive forecasts and metrics

def history(spark):
    rows = [(1, 1, d.date(2000, 1, i), float(v)) for i, v in enumerate([2, 4, 9], 1)] + [(2, 1, d.date(2000, 1, 1), -3.0)]
    return spark.createDataFrame(rows, "store_id long, product_id long, dt date, sale_amount double")


@pytest.mark.parametrize("strategy,value", [("last", 9.0), ("mean", 5.0), ("seasonal", 6.5), ("drift", 12.5)])
def test_naive(spark, strategy, value):
    fit = naive.fit_naive(history(spark), strategy, period=2)
    ask = spark.createDataFrame([(1, 1), (2, 1), (7, 7)], "store_id long, product_id long")
    got = {r.store_id: r.prediction for r in naive.predict_naive(ask, fit).collect()}
    assert got == {1: value, 2: 0.0, 7: 0.0}


def test_drift_horizon(spark):
    fit = naive.fit_naive(history(spark), "drift")
    assert naive.predict_naive(history(spark).filter("store_id = 1").limit(1), fit, horizon=2).first().prediction == 16.0


def test_seasonal_rows_are_limited_before_the_shuffle(spark, sales):
    plan = naive.fit_naive(sales, "seasonal")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_seasonal_naive_mean_by_place(spark):
    rows = [(1, 1, d.datetime(2000, 1, 1) + d.timedelta(hours=h), float(h)) for h in range(50)]
    df = spark.createDataFrame(rows, "store_id long, product_id long, dt timestamp, sale_amount double")
    fit = naive.fit_seasonal_naive(df, limit=20, block=7)
    got = {r.dt.hour: r.prediction for r in naive.predict_seasonal_naive(df.limit(24), fit).collect()}
    assert got[0] == (0 + 24 + 48) / 3 and got[5] == (5 + 29) / 2


SCORES = [(0.0, 0.0, "a"), (0.0, 2.0, "a"), (4.0, 3.0, "b"), (5.0, 5.0, None), (2.0, -1.0, "b")]


def test_metrics(spark):
    df = spark.createDataFrame(SCORES, "y double, p double, g string")
    y, p = np.array([s[0] for s in SCORES]), np.array([s[1] for s in SCORES])
    got = ev.evaluate(df).first()
    e = np.abs(y - p)
    want = dict(MAE=e.mean(), RMSE=np.sqrt((e ** 2).mean()), MAPE=(e / np.maximum(np.abs(y), 1e-8)).mean() * 100,
                sMAPE=(e / ((np.abs(y) + np.abs(p)) / 2 + 1e-8)).mean() * 100, Bias=(p - y).mean(),
                Bias_Percentage=(p - y).mean() / (y.mean() + 1e-8) * 100)
    for name, value in want.items():
        assert got[name] == pytest.approx(value, rel=1e-9)
    assert got.MAE <= got.RMSE


def test_group_metrics_weigh_up_to_the_whole(spark):
    df = spark.createDataFrame([s for s in SCORES if s[2]], "y double, p double, g string")
    groups = ev.evaluate(df, by=["g"]).collect()
    whole = ev.evaluate(df).first().MAE
    assert sum(g.MAE * g.n_observations for g in groups) / sum(g.n_observations for g in groups) == pytest.approx(whole)
    assert len(ev.evaluate(spark.createDataFrame(SCORES, "y double, p double, g string"), by=["g"]).collect()) == 2


def test_scaled_error(spark):
    train = history(spark)
    scores = spark.createDataFrame([(1.0, 3.0), (2.0, 2.0)], "y double, p double")
    assert ev.mase(scores, train).first().MASE == pytest.approx(1 / 3.5, rel=1e-6)
    short = train.filter("store_id = 2")
    assert ev.mase(scores, short).first().MASE == pytest.approx(1 / 4.5, rel=1e-6)


# runs and tuning

def test_run_record_and_tuned_settings(spark, sales, tmp_path):
    cols = ["store_id", "product_id", "city_id", "dt", "sale_amount", "discount", "precpt", "avg_temperature", "activity_flag"]
    train, test = sales.filter("dt < '2001-01-01'").select(cols), sales.filter("dt >= '2001-01-01'").select(cols)
    table = training.tune("ridge", train, {"alpha": [0.1, 1e6]}, folds=3)
    best = [r for r in table.collect() if r.is_best]
    assert len(best) == 1 and best[0].params == {"alpha": "0.1"} and table.count() == 2
    store = str(tmp_path / "best")
    assert sinks.read_best_settings(spark, store, "ridge") == {}
    sinks.save_best_settings(table.filter("is_best"), store)
    _, record = training.train_and_evaluate("ridge", train, test, tuned_path=store)
    row = record.first()
    assert row.model_config["alpha"] == "0.1" and row.n_train_samples == train.count()
    assert set(row.eval_metrics) == {"MAE", "RMSE", "MAPE", "sMAPE", "Bias", "Bias_Percentage", "MASE"}
    assert set(row.feature_importance) == {"discount", "precpt", "avg_temperature", "activity_flag"}
    path = str(tmp_path / "runs")
    sinks.append_results(record, path)
    sinks.append_results(training.train_and_evaluate("naive", train, test)[1], path)
    assert sinks.read_results(spark, path).count() == 2


def test_folds_match_a_plain_search(spark, matrix):
    df = matrix.select(F.lit(1).cast("long").alias("store_id"), F.col("i").cast("long").alias("product_id"),
                       F.lit(d.date(2000, 1, 1)).alias("dt"), F.col("label").alias("sale_amount"), *FEATURES)
    got = training.tune("ridge", df, {"alpha": [1.0]}).first().mae
    p = matrix.orderBy("i").toPandas()
    x, y, errors = p[FEATURES].to_numpy(), p["label"].to_numpy(), []
    for f in range(5):
        out = np.zeros(300, bool)
        out[f * 60:(f + 1) * 60] = True
        m, s = x[~out].mean(0), x[~out].std(0)
        z, c = (x[~out] - m) / s, y[~out].mean()
        w = np.linalg.solve(z.T @ z + np.eye(3), z.T @ (y[~out] - c))
        errors.append(np.abs((x[out] - m) / s @ w + c - y[out]).mean())
    assert got == pytest.approx(np.mean(errors), abs=1e-6)


# validation

def test_validation(spark):
    df = spark.createDataFrame([(1.0, None, "a", None), (float("inf"), 2.0, "b", None), (3.0, None, "c", None)],
                               "x double, sale_amount double, s string, n double")
    found = {r.column_name: r.finding for r in validate.input_report(df).collect()}
    assert found == {"x": "infinite values", "sale_amount": "target has missing values", "s": "ok", "n": "mostly missing"}
    assert validate.drop_all_null(df).columns == ["x", "sale_amount", "s"]
    kept, dropped = validate.numeric_only(df)
    assert kept.columns == ["x", "sale_amount", "n"] and dropped == ["s"]
    with pytest.raises(ValueError):
        validate.require_rows(df.limit(0))
    with pytest.raises(ValueError):
        validate.require_columns(df, ["y"])


# segmentation

@pytest.fixture(scope="module")
def blobs(spark):
    rng = random.Random(5)
    rows = [(g * 10 + i, *[10.0 * g * (1 + j % 2) + rng.gauss(0, 0.3) for j in range(5)], 100.0 * (4 - g) + i)
            for g in range(4) for i in range(10)]
    return spark.createDataFrame(rows, "store_id long, f1 double, f2 double, f3 double, f4 double, f5 double, total_units double")


def test_planted_clusters_are_found_and_named(blobs):
    out = segment.segment_stores(blobs).toPandas()
    assert out.groupby(out.store_id // 10).health_cluster.nunique().tolist() == [1] * 4
    names = out.groupby(out.store_id // 10).cluster_name.first().tolist()
    assert names == ["High Performers", "Mid-Tier Performers", "Stable but Low Performers", "Struggling Stores"]
    assert out.health_index.min() == 0 and out.health_index.max() == pytest.approx(100)
    assert (out.health_score <= 0).all()


def test_components_hold_the_variance(blobs):
    scaled = segment.scale_features(blobs)
    reduced, model, needed = segment.reduce_features(scaled)
    z = scaled.drop("store_id").toPandas().to_numpy()
    values = np.sort(np.linalg.eigvalsh(np.cov(z.T)))[::-1]
    shares = values / values.sum()
    assert list(model.explainedVariance) == pytest.approx(shares, abs=1e-9)
    assert needed == int(np.searchsorted(np.cumsum(shares), 0.9)) + 1
    assert len(reduced.first().components) == needed


def test_sweep_prefers_the_planted_count(blobs):
    rows = segment.sweep(segment.reduce_features(segment.scale_features(blobs))[0], 2, 5).collect()
    assert [r.k for r in rows] == [2, 3, 4, 5]
    assert rows[0].inertia > rows[2].inertia
    assert max(rows, key=lambda r: r.silhouette).k in (3, 4)


def test_equal_scores_have_no_index(spark):
    df = spark.createDataFrame([(1, -2.0), (2, -2.0)], "store_id int, health_score double")
    assert {r.health_index for r in segment.health_index(df).collect()} == {None}
