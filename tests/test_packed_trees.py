"""Trees on packed bins, against plain ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandgrid import constants as k
from demandgrid.operators import packed_trees as pt, regressors
from demandgrid.sources import sinks

INPUTS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.normal(size=3000), rng.integers(0, 3, 3000), rng.exponential(size=3000), np.full(3000, 7.0)])
    y = 1e5 + 3 * (x[:, 0] > 0.3) * x[:, 1] + x[:, 2] + rng.normal(size=3000) * 0.1
    rows = [(*map(float, r), float(v), i) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "a double, b double, c double, d double, y double, i int").repartition(3), x, y


def plain(x, y, bins, depth, least):
    """Forecasts of one tree grown by looking at every split of every node."""
    n, best = len(y), (1e-6, None)
    for f in range(x.shape[1]):
        for at in range(bins[:, f].max()):
            left = bins[:, f] <= at
            a, b = left.sum(), n - left.sum()
            if depth and a >= least and b >= least:
                gain = a * (y[left].mean() - y.mean()) ** 2 + b * (y[~left].mean() - y.mean()) ** 2
                best = max(best, (gain, (f, at)), key=lambda g: g[0])
    if best[1] is None:
        return np.full(n, y.mean())
    left = bins[:, best[1][0]] <= best[1][1]
    out = np.empty(n)
    for side in (left, ~left):
        out[side] = plain(x[side], y[side], bins[side], depth - 1, least)
    return out



def test_cuts():
    assert pt.cuts_of(np.array([3.0, 1.0, 1.0, 2.0])).tolist() == [1.5, 2.5]
    assert pt.cuts_of(np.ones(5)).tolist() == []
    found = pt.cuts_of(np.random.default_rng(0).normal(size=10_000))
    shares = np.diff(np.searchsorted(np.sort(np.random.default_rng(0).normal(size=10_000)), found))
    assert len(found) == 31 and shares.min() > 250 and shares.max() < 400


def test_codes_hold_all_bins():
    x = np.random.default_rng(1).integers(0, [2, 32, 5, 1, 31, 12], (500, 6)).astype(float)
    packing = pt.Packing.of([np.arange(n - 1) + 0.5 for n in (2, 32, 5, 1, 31, 12)])
    codes = packing.packed(x)
    assert packing.groups < 5 and codes.dtype == np.uint16
    for f in packing.inputs:
        assert (packing.bins(f)[codes[packing.group[f]]] == x[:, f]).all()


def test_tree_equals_a_plain_one(spark, table):
    df, x, y = table
    model = pt.fit_trees(df, INPUTS, "y", "p", 4, 20)
    about = model._about()
    bins = np.column_stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(about["cuts"])])
    got = np.array([r.p for r in model.transform(df).orderBy("i").select("p").collect()])
    assert got == pytest.approx(plain(x, y, bins, 4, 20), rel=1e-12)
    shares = model.featureImportances.toArray()
    assert shares.sum() == pytest.approx(1) and shares[3] == 0 and (shares >= 0).all()


def test_boosting_equals_a_plain_loop(spark, table, monkeypatch):
    """Forecasts are handed on from round to round and made anew from all trees now and then."""
    df, x, y = table
    monkeypatch.setattr(pt, "REBUILD", 3)
    monkeypatch.setattr(pt, "BLOCK_ROWS", 500)
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    model = pt.fit_trees(df, INPUTS, "y", "p", 2, 5, rounds=8, rate=0.1)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held
    bins = np.column_stack([np.searchsorted(c, x[:, f]) for f, c in enumerate(model._about()["cuts"])])
    fit = plain(x, y, bins, 2, 5)
    for _ in range(7):
        fit = fit + 0.1 * plain(x, 2 * (y - fit), bins, 2, 5)
    got = np.array([r.p for r in model.transform(df).orderBy("i").select("p").collect()])
    assert got == pytest.approx(fit, rel=1e-12)


def test_many_nodes_are_added_up_in_tasks(spark, table, monkeypatch):
    df, x, y = table
    whole = pt.fit_trees(df, INPUTS, "y", "p", 7, 2)._about()["trees"][0]
    monkeypatch.setattr(pt, "RECORD_SLOTS", 2)
    monkeypatch.setattr(pt, "SLOTS", 5)
    parts = pt.fit_trees(df, INPUTS, "y", "p", 7, 2)._about()["trees"][0]
    assert (whole.feature, whole.bin, whole.levels) == (parts.feature, parts.bin, 7) and whole.value == pytest.approx(parts.value)


def test_rows_are_held_as_codes(spark, table):
    """The vectors of doubles that were held before take 8 bytes an input."""
    df, x, _ = table
    wide = df.select("y", *[(F.col("b") + i).alias(f"x{i}") for i in range(40)])
    packing = pt.Packing.of([np.array([0.5, 1.5]) + i for i in range(40)])
    blocks = pt.blocks_of(wide, [f"x{i}" for i in range(40)], "y", packing)
    size = blocks.map(lambda b: len(b[1])).sum() / len(x)
    blocks.unpersist()
    assert size <= 40 * 8 / 10


def test_shares_of_rows_and_inputs(spark, table):
    df, x, y = table
    model = regressors.fit_model("boost_cols", df, INPUTS, "y", {"n_estimators": 12, "max_depth": 3, "subsample": 0.7, "colsample": 0.5})
    again = regressors.fit_model("boost_cols", df, INPUTS, "y", {"n_estimators": 12, "max_depth": 3, "subsample": 0.7, "colsample": 0.5})
    assert model.ensemble_size() == 12 and model.r2(df, "y") > 0.8
    assert model.predict(df).select("i", "prediction").exceptAll(again.predict(df).select("i", "prediction")).count() == 0


def test_trees_come_back_whole(spark, table, tmp_path):
    df, _, _ = table
    holes = df.withColumn("a", F.when(F.col("i") % 5 > 0, F.col("a")))
    model = regressors.fit_model("gradient_boosting", holes, INPUTS, "y", {"n_estimators": 4, "max_depth": 3})
    sinks.save_fitted_model(model, str(tmp_path / "m"))
    loaded = sinks.load_fitted_model(str(tmp_path / "m"))
    assert loaded.predict(holes).orderBy("i").collect() == model.predict(holes).orderBy("i").collect()
    assert loaded.importance(spark).collect() == model.importance(spark).collect()


def test_constant_inputs_give_the_mean(spark):
    df = spark.createDataFrame([(1.0, float(v)) for v in (1, 2, 6)], "x double, y double")
    assert [r.prediction for r in regressors.fit_model("decision_tree", df, ["x"], "y").predict(df).collect()] == [3.0] * 3
