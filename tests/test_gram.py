"""Linear models from sums of products, against plain matrices."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandgrid.operators import gram, regressors, training

COLUMNS = ["a", "b", "c"]


def table(spark, rows=400, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(rows, 3)) * [1, 50, 1e-3] + [1e4, -3, 0]
    y = x @ [0.5, -0.1, 200] + rng.normal(size=rows)
    holes = rng.random((rows, 3)) < [0.0, 0.2, 0.1]
    cells = [[None if h else float(v) for v, h in zip(*row)] for row in zip(x, holes)]
    data = [(*cells[i], float(y[i]), int(i % 4), int(i // 40), 1, f"2020-01-{1 + i % 28:02d}") for i in range(rows)]
    df = spark.createDataFrame(data, "a double, b double, c double, y double, part int, store_id int, product_id int, dt string")
    return df.withColumn("dt", F.to_date("dt")).repartition(5), np.array([[np.nan if v is None else v for v in r] for r in cells]), y


def test_missing_cells_take_any_value_afterwards(spark):
    df, x, y = table(spark)
    sums = gram.gram(df, COLUMNS, "y", {"a": 1e4, "b": 0.0, "c": 0.0}, 7.0)[0]
    fills = np.array([3.0, -5.5, 0.25])
    found, filled = sums.imputed(fills), np.where(np.isnan(x), fills, x)
    assert found.n == len(y) and found.label_mean == pytest.approx(y.mean())
    assert found.mean == pytest.approx(filled.mean(0), rel=1e-9) and found.covariance == pytest.approx(np.cov(filled.T, bias=True), rel=1e-7, abs=1e-12)
    assert found.with_label == pytest.approx(((filled - filled.mean(0)) * (y - y.mean())[:, None]).mean(0), rel=1e-7, abs=1e-10)


def test_parts_add_up_and_come_off_again(spark):
    df, _, _ = table(spark)
    shift = dict.fromkeys(COLUMNS, 0.0)
    parts = gram.gram(df, COLUMNS, "y", shift, group="part")
    whole = gram.gram(df, COLUMNS, "y", shift)[0]
    assert sorted(parts) == [0, 1, 2, 3] and whole.rows == 400
    assert (parts[0] + parts[1] + parts[2] + parts[3]).products == pytest.approx(whole.products, rel=1e-9, abs=1e-6)
    assert (whole - parts[2]).products == pytest.approx((parts[0] + parts[1] + parts[3]).products, rel=1e-6, abs=1e-5)


def test_rows_without_label_and_infinite_cells(spark):
    df = spark.createDataFrame([(1.0, None), (float("inf"), 2.0), (float("nan"), 4.0), (3.0, 6.0)], "a double, y double")
    found = gram.gram(df, ["a"], "y", {"a": 0.0})[0].imputed(np.array([3.0]))
    assert found.n == 3 and found.mean[0] == pytest.approx((1e10 + 6) / 3)
    assert gram.gram(df.filter("y > 100"), ["a"], "y", {"a": 0.0}) == {}


@pytest.mark.parametrize("l1,l2", [(0.05, 0.0), (0.3, 0.0), (0.1, 0.2)])
def test_penalty_meets_its_conditions(l1, l2):
    rng = np.random.default_rng(1)
    z = rng.normal(size=(500, 12))
    z[:, 5], z[:, 8] = z[:, 2], 0.0                     # one input twice, one constant
    z[:, 9] = z[:, 1] + 1e-4 * rng.normal(size=500)      # two that nearly agree
    s, b = z.T @ z / 500, z.T @ (z @ rng.normal(size=12) + rng.normal(size=500)) / 500
    w = gram.penalized(s, b, l1, l2, 5000)
    slope = s @ w - b + l2 * w
    assert np.abs(slope[w != 0] + l1 * np.sign(w[w != 0])).max() < 1e-9 and np.abs(slope[w == 0]).max() <= l1 + 1e-9
    assert w[8] == 0 and ((w[5] == 0) if l2 == 0 else (w[5] == pytest.approx(w[2])))


def test_dependent_inputs_share_the_shortest_solution():
    z = np.random.default_rng(2).normal(size=(100, 4))
    z[:, 3] = z[:, 0] + z[:, 1]
    y = z @ [1.0, 2.0, 3.0, 0.0]
    assert gram.least_squares(z.T @ z / 100, z.T @ y / 100) == pytest.approx(np.linalg.lstsq(z, y, rcond=None)[0], abs=1e-9)


def test_tuning_like_a_loop_over_folds(spark):
    df, _, _ = table(spark)
    found = {(r.model_name, r.params["alpha"] if "alpha" in r.params else None, r.params["fit_intercept"]): (r.mae, r.is_best)
             for r in training.tune_lines({"linear": {"fit_intercept": [True, False]}, "ridge": {"alpha": [1.0, 50.0], "fit_intercept": [True]}}, df.drop("part"), label="y").collect()}
    rows = df.orderBy("store_id", "product_id", "dt").toPandas()
    x, y = rows[COLUMNS].to_numpy(float), rows["y"].to_numpy()
    errors = {key: [] for key in found}
    for part in np.array_split(np.arange(400), 5):
        learn = np.setdiff1d(np.arange(400), part)
        fills = np.nanmedian(x[learn], axis=0)
        filled = np.where(np.isnan(x), fills, x)
        mean, spread = filled[learn].mean(0), filled[learn].std(0)
        z = (filled - mean) / spread
        for key in errors:
            alpha = float(key[1] or 0)
            w = np.linalg.solve(z[learn].T @ z[learn] + alpha * np.eye(3), z[learn].T @ (y[learn] - (y[learn].mean() if key[2] == "true" else 0)))
            errors[key].append(np.abs(y[part] - z[part] @ w - (y[learn].mean() if key[2] == "true" else 0)).mean())
    assert {key: pytest.approx(np.mean(e), rel=1e-6) for key, e in errors.items()} == {key: v[0] for key, v in found.items()}
    assert [key for key, v in found.items() if v[1] and key[0] == "ridge"] == [min((key for key in errors if key[0] == "ridge"), key=lambda key: np.mean(errors[key]))]


def test_rows_without_a_series_are_told(spark):
    df, _, _ = table(spark, 80)
    odd = df.withColumn("store_id", F.when(F.col("part") > 0, F.col("store_id")))
    with pytest.warns(UserWarning, match="20 rows without a series"):
        training.tune("ridge", odd.drop("part"), {"alpha": [1.0]}, folds=3, label="y")


def test_normal_equations_hold_without_a_penalty_only(spark):
    df, _, _ = table(spark)
    for name, settings, gap in (("linear", {}, 0.0), ("lasso", {"alpha": 0.2}, 0.2)):
        found = regressors.fit_model(name, df, COLUMNS, "y", settings).normal_equations(df, "y").collect()
        assert all(abs(abs(r.with_label - r.with_fit) - gap) < 1e-6 for r in found)


def test_rows_without_a_label_are_told(spark):
    df, _, _ = table(spark, 80)
    with pytest.warns(UserWarning, match="20 rows without y"):
        regressors.fit_model("linear", df.withColumn("y", F.when(F.col("part") > 0, F.col("y"))), COLUMNS, "y")
    with pytest.raises(ValueError, match="no row has a y"):
        regressors.fit_model("ridge", df.withColumn("y", F.lit(None).cast("double")), COLUMNS, "y")


def test_sub_forests_make_one_forest(spark):
    df, _, _ = table(spark)
    model = regressors.fit_model("random_forest", df, COLUMNS, "y", {"n_estimators": 11, "max_depth": 4})
    assert sum(model.trees) == model.ensemble_size() == 11 and len(model.trees) > 1
    parts = [m.transform(model.pipeline.stages[1].transform(model.pipeline.stages[0].transform(df))).select("store_id", "dt", "y", m.getPredictionCol()).collect() for m in model.regressors]
    mean = {(r[0], r[1], r[2]): sum(n * p[i][3] for n, p in zip(model.trees, parts)) / 11 for i, r in enumerate(parts[0])}
    assert {(r.store_id, r.dt, r.y): pytest.approx(r.raw_prediction) for r in model.predict(df).collect()} == mean
    assert sum(r.importance for r in model.importance(spark).collect()) == pytest.approx(1)


def test_folds_of_rows_that_lie_in_files_are_neither_shuffled_nor_held(spark, tmp_path):
    """A row is compared with the rows at the cuts; sorting and holding all inputs took several times the disk of the table."""
    df, _, _ = table(spark)
    df.drop("part").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    plan = training.placed_rows(rows, COLUMNS, 5, "y", held=False)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "InMemoryTableScan" not in plan
    grid = {"ridge": {"alpha": [1.0, 50.0], "fit_intercept": [True]}}
    found = [r.mae for r in training.tune_lines(grid, rows, label="y", held=False).collect()]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held
    assert found == pytest.approx([r.mae for r in training.tune_lines(grid, rows, label="y").collect()])


def test_equal_rows_fall_on_both_sides_of_a_cut(spark):
    rows = spark.createDataFrame([(1, 1, 1, 0.0)] * 3 + [(1, 1, 2, 5.0)] * 14 + [(2, 1, 1, 1.0)] * 3 + [(None, 1, 1, 2.0)], "store_id long, product_id long, dt long, y double")
    found = training.with_folds(rows.dropna(), 5).groupBy("store_id", "dt", "fold").count().collect()
    assert sorted(map(tuple, found)) == [(1, 1, 0, 3), (1, 2, 0, 1), (1, 2, 1, 4), (1, 2, 2, 4), (1, 2, 3, 4), (1, 2, 4, 1), (2, 1, 4, 3)]
    assert sorted(r.fold for r in training.with_folds(rows.limit(2), 5).collect()) == [0, 1]


def test_cells_reach_python_as_one_array(spark):
    """Each further column costs a row as much as five cells of an array."""
    df, _, _ = table(spark)
    narrow = gram.labelled(df, COLUMNS, "y", F.col("part"))
    assert narrow.columns == [gram.CELLS, gram.GROUP]
    found = gram.mean_products(df, COLUMNS[:1], [F.lit(1.0), F.col("y")], np.array([2.0]), np.array([4.0]))
    rows = df.toPandas()
    x = (rows[COLUMNS[0]] - 2) / 4
    assert found[0] == pytest.approx([x.mean(), (x * rows["y"]).mean()])
