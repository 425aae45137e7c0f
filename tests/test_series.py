import datetime as d
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from demandgrid.config import FeatureSettings
from demandgrid.operators import features as ft
from demandgrid.operators.quantiles import exact_quantiles, medians_without
from demandgrid.operators.ranks import running_start
from demandgrid.operators.series import global_position, over_series, positions
from demandgrid.operators.training import with_folds
from demandgrid.plans import feature_set
from demandgrid.plans.registry import with_status

SCHEMA = "store_id long, product_id long, dt date, sale_amount double, stock_status int"


def series(spark, lengths, seed=1, gaps=True):
    rng = random.Random(seed)
    rows = []
    for (store, product), n in lengths.items():
        day = d.date(2000, 1, 1)
        for _ in range(n):
            day += d.timedelta(rng.choice([1, 1, 2, 40]) if gaps else 1)
            rows.append((store, product, day, float(rng.randint(0, 9)), rng.randint(0, 1)))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA)


def windows(spec):
    return {**ft.lag_columns(spec), **ft.rolling_columns(spec)}


def rows_of(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(sorted(df.columns)).collect()), key=str)


def test_blocks_give_the_same_as_one_window(spark):
    """One series holds most rows and is cut into many blocks, the others stay whole."""
    df = series(spark, {(1, 1): 400, (1, 2): 30, (2, 1): 1})
    plain = over_series(df, windows, 168, tie=df.columns, position="t")
    cut = over_series(df, windows, 168, tie=df.columns, limit=50, block=10, position="t")
    assert cut.count() == df.count()
    assert rows_of(plain) == rows_of(cut)


def test_blocks_with_equal_times_and_copies(spark):
    base = series(spark, {(1, 1): 60})
    df = base.unionAll(base).unionAll(base.withColumn("sale_amount", F.lit(5.0))).unionAll(base.limit(0))
    day = base.first().dt
    copies = spark.range(300).select(F.lit(1).cast("long"), F.lit(1).cast("long"), F.lit(day), F.lit(2.0), F.lit(1)).toDF(*df.columns)
    df = df.unionAll(copies)
    plain = over_series(df, windows, 168, tie=df.columns, position="t")
    cut = over_series(df, windows, 168, tie=df.columns, limit=50, block=64, position="t")
    assert rows_of(plain) == rows_of(cut)
    assert sorted(r.t for r in cut.collect()) == list(range(df.count()))


def test_copies_are_packed_before_the_shuffle(spark):
    df = spark.range(1000).select(F.lit(1).alias("k"), F.lit(0).cast("long").alias("_at"), F.lit(7).cast("long").alias("_tie"))
    rows = positions(df, ["k"]).collect()
    assert [(r._copies, r._first) for r in rows] == [(1000, 0)]


def test_against_pandas(spark):
    df = series(spark, {(1, 1): 400, (3, 2): 25, (3, 4): 1})
    got = over_series(df, windows, 168, tie=df.columns).toPandas().sort_values(["store_id", "product_id", "dt"]).reset_index(drop=True)
    p = df.toPandas().sort_values(["store_id", "product_id", "dt"]).reset_index(drop=True)
    groups = p.groupby(["store_id", "product_id"])
    for n in (1, 21):
        pd.testing.assert_series_equal(got[f"sale_amount_lag_{n}"], groups.sale_amount.shift(n), check_names=False)
    for n in (6, 24, 168):
        rolled = groups.sale_amount.rolling(n, min_periods=1)
        for kind in ("mean", "std", "max", "median"):
            want = getattr(rolled, kind)().reset_index(level=[0, 1], drop=True)
            want = want.fillna(0) if kind == "std" else want
            pd.testing.assert_series_equal(got[f"sale_amount_rolling_{kind}_{n}"], want, check_names=False, atol=1e-9)


def test_lag_of_lag_and_bounds(spark):
    df = over_series(series(spark, {(1, 1): 50, (1, 2): 9}), windows, 168)
    twice = over_series(df.select("store_id", "product_id", "dt", "sale_amount_lag_2", "sale_amount_lag_3"),
                        lambda w: {"again": F.lag("sale_amount_lag_2", 1).over(w)}, 1)
    assert twice.filter(~F.col("again").eqNullSafe(F.col("sale_amount_lag_3"))).count() == 0
    assert df.filter("sale_amount_rolling_max_6 < sale_amount_rolling_mean_6").count() == 0


def test_window_of_one_is_the_value_and_left_closed_leaves_it_out(spark):
    df = series(spark, {(1, 1): 20})
    one = ft.rolling(df, windows=[1], kinds=("mean",))
    assert one.filter("sale_amount_rolling_mean_1 <> sale_amount").count() == 0
    left = over_series(df, lambda w: {**ft.rolling_columns(w, windows=[1], closed="left", kinds=("mean",)), "l": F.lag("sale_amount").over(w)}, 1)
    assert left.filter("not (sale_amount_rolling_mean_1 <=> l)").count() == 0


def test_rows_without_key_get_null(spark):
    df = spark.createDataFrame([(None, 1, d.date(2000, 1, i), 1.0, 0) for i in (1, 2)] + [(1, 1, d.date(2000, 1, 1), 1.0, 0)], SCHEMA)
    got = over_series(df, windows, 168)
    assert got.count() == 3
    assert got.filter("store_id is null and sale_amount_rolling_std_6 is not null").count() == 0
    assert got.filter("store_id = 1").first().sale_amount_rolling_std_6 == 0.0


def test_one_exchange_serves_all_windows(spark, sales):
    df = over_series(with_status(sales), windows, 168)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(store_id") <= 1 and plan.count("Sort [store_id") == 1
    assert "Python" not in plan


def test_global_position_and_folds(spark):
    df = series(spark, {(5, 1): 7, (2, 9): 4, (2, 3): 1, (9, 9): 12})
    placed = over_series(df, lambda w: {}, 0, position="_place")
    got = global_position(placed, "n").orderBy("store_id", "product_id", "dt").select("n").collect()
    assert [r.n for r in got] == list(range(24))
    folds = with_folds(df, 5).orderBy("store_id", "product_id", "dt").select("fold").collect()
    assert [r.fold for r in folds] == [0] * 5 + [1] * 5 + [2] * 5 + [3] * 5 + [4] * 4


def test_running_start(spark):
    df = spark.createDataFrame([(i * 7 % 101, 1 + i % 3) for i in range(100)], "v long, n long")
    want, total = {}, 0
    for v, n in sorted((r.v, r.n) for r in df.collect()):
        want[v], total = total, total + n
    assert {r.v: r.s for r in running_start(df, "v", "n", "s", buckets=8).collect()} == want


@pytest.mark.parametrize("bins", [1024, 5])
def test_quantiles_exact(spark, bins):
    """Few bins force many rounds; one column is mostly one value, one has few values, one is empty."""
    pdf = pd.DataFrame({"a": [((i * 7919) % 10007) / 7 for i in range(10001)], "b": [0.0] * 7000 + [float(i) for i in range(3001)],
                        "c": [float(i % 3) for i in range(10001)], "e": [None] * 9998 + [4.0, 1.0, 2.5]})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, b double, c double, e double").withColumn("z", F.lit(None).cast("double"))
    shares = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = exact_quantiles(df, ["a", "b", "c", "e", "z"], shares, bins)
    for c in "abce":
        assert got[c] == pytest.approx(pdf[c].quantile(shares).tolist(), abs=1e-9)
    assert got["z"] == [None] * 5


def test_feature_count_and_train_statistics(spark, sales):
    train, test = sales.filter("dt < '2001-01-01'"), sales.filter("dt >= '2001-01-01'")
    fit = feature_set.fit_features(train)
    out = feature_set.engineer(test, fit)
    assert len(out.columns) == len(test.columns) + 70
    assert out.count() == test.count()
    store = train.filter("store_id = 1").agg(F.max("sale_amount")).first()[0]
    assert {r.store_max_sales for r in out.filter("store_id = 1").select("store_max_sales").collect()} == {store}


def test_feature_set_with_blocks(spark, sales):
    plain, cut = feature_set.engineer(sales), feature_set.engineer(sales, settings=FeatureSettings(series_rows=20, block_rows=10))
    assert rows_of(plain) == rows_of(cut)


def test_quantiles_of_wide_and_tiny_ranges(spark):
    rng = random.Random(4)
    pdf = pd.DataFrame({"w": [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300) for _ in range(999)], "t": [5e-324 * rng.randint(0, 9) for _ in range(999)],
                        "o": [1e15 + rng.random() for _ in range(999)], "m": [rng.choice([-1.7e308, 0.0, 1.7e308]) for _ in range(999)]})
    got = exact_quantiles(spark.createDataFrame(pdf), list("wtom"), [0.0, 0.5, 1.0], 16)
    for c in "wtom":
        assert got[c] == sorted(pdf[c])[::499]


def test_medians_of_all_other_groups(spark):
    rng = random.Random(5)
    pdf = pd.DataFrame({"g": [rng.randint(0, 3) for _ in range(500)], "x": [rng.gauss(0, 1) for _ in range(500)], "y": [float(rng.randint(0, 5)) for _ in range(500)]})
    pdf.loc[pdf.g != 2, "y"] = None
    got = medians_without(spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "g int, x double, y double"), ["x", "y"], "g", [0, 1, 2, 3])
    for g in range(4):
        others = pdf[pdf.g != g]
        assert got[g]["x"] == pytest.approx(others.x.median()) and got[g]["y"] == (None if g == 2 else others.y.median())


def brute_rolling(values, rows, kind, late):
    """A loop over slices."""
    out = []
    for i in range(len(values)):
        frame = [v for v in values[max(0, i + 1 - late - rows):i + 1 - late] if v is not None and np.isfinite(v)]
        out.append({"mean": lambda: np.mean(frame), "max": lambda: max(frame), "median": lambda: np.median(frame),
                    "std": lambda: np.std(frame, ddof=1) if len(frame) > 1 else 0.0}[kind]() if frame else (0.0 if kind == "std" else None))
    return out


@pytest.mark.parametrize("closed", ["right", "left"])
@pytest.mark.parametrize("options", [{}, {"limit": 100, "block": 60}])
def test_carried_frames_like_a_loop(spark, closed, options):
    """Long series over several batches, missing and infinite values, amounts of different size."""
    rng, rows = random.Random(8), []
    for store, n in ((1, 900), (2, 3), (3, 250)):
        for i in range(n):
            v = rng.choice([None, float("inf"), float("nan"), 7.0]) if rng.random() < 0.1 else rng.uniform(0, 1) + 1e6 * (i > 500)
            rows.append((store, 1, d.date(2000, 1, 1) + d.timedelta(i), v, 0))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 70)
    try:
        got = ft.rolling(spark.createDataFrame(rows, SCHEMA).repartition(4), windows=[1, 6, 30], closed=closed, **options).toPandas()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for store in (1, 2, 3):
        own, values = got[got.store_id == store].sort_values("dt"), [r[3] for r in rows if r[0] == store]
        for n in (1, 6, 30):
            for kind in ("mean", "std", "max", "median"):
                found = [None if pd.isna(v) else v for v in own[f"sale_amount_rolling_{kind}_{n}"]]
                expected = brute_rolling(values, n, kind, int(closed == "left"))
                assert [v is None for v in found] == [v is None for v in expected]
                assert [v for v in found if v is not None] == pytest.approx([v for v in expected if v is not None], rel=1e-9, abs=1e-6), (store, n, kind)


def test_carried_frames_share_the_exchange_and_sort_of_lags(spark, sales):
    settings = FeatureSettings()
    df = over_series(with_status(sales), lambda w: ft.lag_columns(w), 168, rolling=ft.rolling_measures(windows=settings.rolling_windows))
    df.count()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning(store_id") <= 1 and plan.count("Sort [store_id") == 1
