"""Training runs and tuning."""

from __future__ import annotations

import itertools
import json
import time
import warnings
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import constants as k
from ..config import RunSettings
from ..schema import numeric_columns
from ..session import keep
from ..sources.sinks import read_best_settings, run_record
from . import gram, naive
from .evaluate import evaluate
from .prep import known, prepare
from .quantiles import first_row, medians_without
from .regressors import BOOSTING, INPUT, LINEAR, MODELS, RAW, checkpointed, estimator, fit_model
from .series import parts_at

NAIVE_MODELS = (*naive.STRATEGIES, "seasonal_naive")
PREPARATION = {"scaling_method": "scaling", "use_scaling": "scaled", "handle_missing": "imputing"}


def feature_columns(df: DataFrame, label: str = k.TARGET) -> list[str]:
    """Numeric columns that are neither keys nor the target."""
    return [c for c in numeric_columns(df) if c not in {*k.METADATA_COLUMNS, label}]


def train_and_evaluate(name: str, train: DataFrame, test: DataFrame, settings: RunSettings = RunSettings(),
                       model_settings: dict | None = None, tuned_path: str | None = None, experiment: str | None = None):
    """Fit, predict both sets, score both. Returns the fitted model and the run as a one-row table.

    Settings come from the call, else from a stored tuning winner, else from the configuration. Among them
    ``scaling_method`` (standard or robust), ``use_scaling`` and ``handle_missing`` steer the preparation.
    """
    spark, label = train.sparkSession, settings.data.target
    chosen = {**settings.models.get(name, {})}
    if tuned_path:
        chosen |= read_best_settings(spark, tuned_path, name)
    chosen |= model_settings or {}
    started = time.monotonic()
    if name == "seasonal_naive":
        fit = keep(naive.fit_seasonal_naive(train, target=label, time=settings.data.time))
        features, importance, model = [], None, fit
        scored = [naive.predict_seasonal_naive(d, fit, time=settings.data.time) for d in (train, test)]
    elif name in (*naive.STRATEGIES, "naive"):
        strategy = "seasonal" if name == "naive" else name
        fit = keep(naive.fit_naive(train, strategy, target=label, time=settings.data.time))
        fit.count()
        features, importance, model = [], None, fit
        scored = [naive.predict_naive(d, fit) for d in (train, test)]
    else:
        features = feature_columns(train, label)
        fitting = {v: chosen[p] for p, v in PREPARATION.items() if p in chosen}
        scaling = fitting.get("scaling", "standard") if fitting.get("scaled", True) else None
        model = fit_model(name, train, features, label, {p: v for p, v in chosen.items() if p not in PREPARATION}, scaling,
                          bool(fitting.get("imputing", True)), settings.seed)
        importance = {r.feature: r.importance for r in model.importance(spark).collect()}
        scored = [model.predict(d) for d in (train, test)]
    seconds = time.monotonic() - started
    on_train = evaluate(scored[0], label, "prediction").first().asDict()
    on_test = evaluate(scored[1], label, "prediction", train=train, time=settings.data.time, target=label).first().asDict()
    record = run_record(spark, {
        "experiment": experiment or f"baseline_{name}", "model_name": name, "training_time_seconds": seconds,
        "train_metrics": on_train, "eval_metrics": on_test, "feature_importance": importance, "model_config": chosen,
        "n_features": len(features), "n_train_samples": train.count(), "n_eval_samples": test.count()})
    return model, record


def train_all(train: DataFrame, test: DataFrame, settings: RunSettings = RunSettings(), names: list[str] | None = None,
              tuned_path: str | None = None) -> DataFrame:
    """One run per model, as one table of run records."""
    records = [train_and_evaluate(n, train, test, settings, tuned_path=tuned_path)[1] for n in names or (*NAIVE_MODELS, *MODELS)]
    return reduce(DataFrame.unionByName, records)


def grid_rows(grid: dict[str, list]) -> list[dict]:
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def with_folds(df: DataFrame, folds: int, keys: list[str] = k.SERIES, time_column: str = k.TIME, name: str = "fold") -> DataFrame:
    """Contiguous folds over the order of store, product and time; the first ones take the remainder."""
    size, extra = divmod(df.count(), folds)
    if not size:
        # fewer rows than folds: one row each
        folds = extra
    return parts_at(df, [fold * size + min(fold, extra) for fold in range(1, folds)], name, keys, time_column)


def placed_rows(train: DataFrame, features: list[str], folds: int, label: str, held: bool = True) -> DataFrame:
    """Rows with their fold. Folds are cut in the order of the series, so rows without a series or label cannot take part:
    how many there are is said in a warning. Rows that lie in files need not be ``held`` once more."""
    rows = train.select(*k.SERIES, k.TIME, label, *features)
    usable = rows.dropna(subset=[*k.SERIES, label])
    left_out = rows.count() - usable.count()
    if left_out:
        warnings.warn(f"{left_out} rows without a series or {label} are left out of tuning", stacklevel=3)
    found = with_folds(usable, folds)
    return keep(found) if held else found


def tuned(spark: SparkSession, errors: list[tuple[str, dict, float]]) -> DataFrame:
    """``model_name, params, mae, is_best``: the first of the least errors of every model wins."""
    best: dict[str, int] = {}
    for i, (name, _, error) in enumerate(errors):
        if name not in best or error < errors[best[name]][2]:
            best[name] = i
    return spark.createDataFrame([(name, {p: json.dumps(v) for p, v in row.items()}, error, best[name] == i) for i, (name, row, error) in enumerate(errors)],
                                 "model_name string, params map<string,string>, mae double, is_best boolean")


def tune_lines(grids: dict[str, dict[str, list]], train: DataFrame, folds: int = k.CV_FOLDS, label: str = k.TARGET,
               held: bool = True) -> DataFrame:
    """Mean absolute error of every row of several linear grids over contiguous folds.

    One pass sums products by fold; the training part of a fold is the whole minus the fold. From these matrices every grid
    row of every fold is imputed (with the medians of its training part), scaled and solved, and a second pass adds up the
    errors of all of them. Rows are held between the passes, unless ``held`` says that they lie in files anyway.
    """
    spark, features = train.sparkSession, feature_columns(train, label)
    rows = [(name, row) for name, grid in grids.items() for row in grid_rows(grid)]
    data = placed_rows(train, features, folds, label, held)
    known_cells = first_row(data.select(*[known(c).alias(c) for c in features]), [m for c in features for m in (F.count(c), F.avg(c))])
    counts, means = dict(zip(features, known_cells[::2])), dict(zip(features, known_cells[1::2]))
    used, n = [c for c in features if counts[c]], data.count()
    sums = gram.gram(data, used, label, {c: means[c] for c in used}, group="fold")
    whole = reduce(gram.Gram.__add__, sums.values())
    holes = [c for c in used if counts[c] < n]
    lines, medians = {}, medians_without(data, holes, "fold", sorted(sums), k.FINITE_LIMIT)
    for fold, own in sums.items():
        fills = np.array([m if (m := medians[fold].get(c)) is not None else means[c] for c in used])
        moments = (whole - own).imputed(fills)
        lines[fold] = [gram.solve(name, {**k.MODEL_DEFAULTS[name], "max_iter": 5000, **row}, moments, fills) for name, row in rows]
    errors = gram.absolute_errors(data, used, label, lines, "fold")
    if held:
        data.unpersist()
    return tuned(spark, [(name, row, sum(errors[f][i] for f in errors) / len(errors)) for i, (name, row) in enumerate(rows)])


def tune(name: str, train: DataFrame, grid: dict[str, list] | None = None, folds: int = k.CV_FOLDS, label: str = k.TARGET,
         seed: int = k.SEED, parallelism: int = 4) -> DataFrame:
    """Mean absolute error of every grid row over contiguous folds: ``model_name, params, mae, is_best``.

    Linear models share two passes (see ``tune_lines``). For trees each fold is prepared once, imputation fitted on its
    training part, and held while all grid rows are fitted on it; ``parallelism`` fits run side by side.
    """
    if name in LINEAR:
        return tune_lines({name: grid or k.MODEL_GRIDS[name]}, train, folds, label)
    spark, features = train.sparkSession, feature_columns(train, label)
    rows = grid_rows(grid or k.MODEL_GRIDS[name])
    checkpointed(spark)
    data = placed_rows(train, features, folds, label)
    metric = RegressionEvaluator(labelCol=label, predictionCol=RAW, metricName="mae")
    errors = {i: [] for i in range(len(rows))}
    for fold in range(folds):
        prepared = prepare(data.filter(F.col("fold") != fold), features, label, INPUT, dealt=name in BOOSTING)
        test_part = keep(prepared.apply(data.filter(F.col("fold") == fold)).select(INPUT, label))

        def score(settings):
            model = estimator(name, label, settings, seed).fit(prepared.rows)
            return metric.evaluate(model.transform(test_part))

        with ThreadPool(min(parallelism, len(rows))) as pool:
            for i, error in enumerate(pool.map(score, rows)):
                errors[i].append(error)
        prepared.held.unpersist()
        test_part.unpersist()
    data.unpersist()
    return tuned(spark, [(name, row, sum(errors[i]) / folds) for i, row in enumerate(rows)])
