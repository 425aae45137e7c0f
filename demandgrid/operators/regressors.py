"""Regression models by name, with settings in familiar terms: linear ones from sums of products, trees up to twelve levels on packed
bins, forests and deeper trees from Spark ML."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from .. import constants as k
from ..functions.numeric import ratio
from ..session import keep, shared_folder
from . import gram, packed_trees
from .prep import PREFIX, as_transformer, fit_columns, prepare
from .validate import require_columns, require_rows

LINEAR = ("linear", "ridge", "lasso", "elasticnet")
BOOSTING = ("gradient_boosting", "boost_cols")
TREES = ("decision_tree", "random_forest", *BOOSTING)
MODELS = LINEAR + TREES
RAW, PREDICTION, INPUT = "raw_prediction", "prediction", "model_input"
# the deepest tree Spark grows; "no limit" means this depth
DEEPEST = 30
# up to this depth rows find their node in a tree faster than they keep it from level to level
SHALLOW = 8
# of a forest: memory for the node statistics of one sub-forest in a task, and rows of a partition
FOREST_MB = 256
FOREST_ROWS = 250_000


def depth_of(settings: dict) -> int:
    depth = DEEPEST if settings.get("max_depth") is None else int(settings["max_depth"])
    if depth > DEEPEST:
        raise ValueError(f"max_depth {depth} is beyond the {DEEPEST} levels that Spark's trees can have")
    return depth


def estimator(name: str, label: str, settings: dict | None = None, seed: int = k.SEED) -> Estimator:
    """A tree model of Spark. In deep trees rows remember their node, so that grown trees are not sent to tasks again."""
    if name not in MODELS:
        raise ValueError(f"unknown model {name}, choose one of {MODELS}")
    if name in LINEAR:
        raise ValueError(f"{name} is solved from sums of products, not by an estimator")
    s = {**k.MODEL_DEFAULTS[name], **(settings or {})}
    depth = depth_of(s)
    tree = {"featuresCol": INPUT, "labelCol": label, "predictionCol": RAW, "maxDepth": depth, "minInstancesPerNode": int(s.get("min_leaf", 1)),
            "seed": seed, "maxMemoryInMB": 512, "cacheNodeIds": depth > SHALLOW, "checkpointInterval": 10}
    if name == "decision_tree":
        return DecisionTreeRegressor(**tree)
    if name == "random_forest":
        return RandomForestRegressor(**{**tree, "maxMemoryInMB": FOREST_MB}, numTrees=int(s["n_estimators"]),
                                     featureSubsetStrategy=str(s.get("features", "sqrt")))
    boost = {**tree, "maxIter": int(s["n_estimators"]), "stepSize": float(s["learning_rate"]),
             "subsamplingRate": float(s.get("subsample", 1.0))}
    if name == "boost_cols":
        return GBTRegressor(**boost, featureSubsetStrategy=str(float(s.get("colsample", 1.0))))
    return GBTRegressor(**boost)


def checkpointed(spark: SparkSession) -> None:
    """Trees and node ids cut their lineage in the shared folder."""
    folder = shared_folder(spark)
    if folder and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)


def grow_forest(rows: DataFrame, label: str, settings: dict | None, seed: int, part_trees: int | None = None,
                parallelism: int = 8) -> list[Model]:
    """Sub-forests of ``part_trees`` trees, grown side by side on the same held rows with seeds of their own.

    The statistics of a level are sent once from every partition for each node, which is the cost of deep trees. So the rows lie
    in as few partitions as their number asks for, and the cores are kept busy by the sub-forests.
    """
    trees = int({**k.MODEL_DEFAULTS["random_forest"], **(settings or {})}["n_estimators"])
    size = part_trees or max(1, -(-trees // max(1, parallelism)))
    parts = [min(size, trees - at) for at in range(0, trees, size)]

    def grow(number: int) -> Model:
        return estimator("random_forest", label, {**(settings or {}), "n_estimators": parts[number]}, seed + number).fit(rows)

    with ThreadPool(min(parallelism, len(parts))) as pool:
        return pool.map(grow, range(len(parts)))


@dataclass
class FittedModel:
    """``weights`` and ``intercept`` are those of a linear model over inputs less ``scale[0]``, divided by ``scale[1]``;
    ``trees`` counts the trees of every part of an ensemble."""
    name: str
    features: list[str]
    pipeline: PipelineModel
    settings: dict = field(default_factory=dict)
    weights: list[float] | None = None
    intercept: float = 0.0
    scale: list[list[float]] | None = None
    trees: list[int] | None = None

    @property
    def regressors(self) -> list[Model]:
        return [stage for stage in self.pipeline.stages if hasattr(stage, "featureImportances")]

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds ``prediction``, never below 0, and ``raw_prediction``."""
        require_columns(df, self.features)
        out = self.pipeline.transform(df)
        return out.select(*df.columns, RAW, PREDICTION)

    def r2(self, df: DataFrame, label: str) -> float:
        """Of the predictions before they are cut at 0."""
        return RegressionEvaluator(labelCol=label, predictionCol=RAW, metricName="r2").evaluate(self.predict(df))

    def coefficients(self, spark: SparkSession) -> DataFrame:
        if self.weights is None:
            raise ValueError(f"{self.name} has no coefficients")
        return spark.createDataFrame([*zip(self.features, self.weights), ("intercept", self.intercept)], "feature string, coefficient double")

    def normal_equations(self, df: DataFrame, label: str) -> DataFrame:
        """``feature, with_label, with_fit``: mean products of every scaled input with the label and with the raw forecasts, both
        less the mean of the label. Least squares makes them equal; a penalty on weights keeps them apart by its slope."""
        if self.weights is None:
            raise ValueError(f"{self.name} has no normal equations")
        rows = self.pipeline.transform(df.dropna(subset=[label]))
        mean = rows.agg(F.avg(label)).scalar()
        found = gram.mean_products(rows, [PREFIX + c for c in self.features], [F.col(label) - mean, F.col(RAW) - mean], *map(np.array, self.scale))
        return df.sparkSession.createDataFrame([(c, *sides) for c, sides in zip(self.features, found.tolist())],
                                               "feature string, with_label double, with_fit double")

    def importance(self, spark: SparkSession) -> DataFrame:
        """Tree importance, or the size of the coefficients."""
        if self.weights is not None:
            values = [abs(w) for w in self.weights]
        else:
            parts = [np.asarray(m.featureImportances.toArray()) for m in self.regressors]
            values = np.average(parts, axis=0, weights=self.trees or [1] * len(parts)).tolist()
        return spark.createDataFrame(list(zip(self.features, values)), "feature string, importance double")

    def ensemble_size(self) -> int | None:
        sizes = [m.getNumTrees for m in self.regressors if hasattr(m, "getNumTrees")]
        return sum(sizes) if sizes else None


def floor_at_zero() -> SQLTransformer:
    return SQLTransformer(statement=f"select *, greatest(0D, {RAW}) as {PREDICTION} from __THIS__")


def floating_columns(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}


def fit_line(name: str, rows: DataFrame, features: list[str], label: str, settings: dict | None = None,
             scaling: str | None = "standard", imputing: bool = True) -> FittedModel:
    """A linear model from one pass that sums products; medians, and quartiles for robust scaling, are found before."""
    fits = fit_columns(rows, features, scaling if scaling == "robust" else None, imputing)
    used = list(fits)
    robust = scaling == "robust"
    fills = np.array([f.fill if f.fill is not None else f.centre if robust else 0.0 for f in fits.values()])
    centre, spread = (np.array([getattr(f, part) for f in fits.values()]) for part in ("centre", "spread"))
    sums = gram.gram(rows, used, label, dict(zip(used, fills)))[0]
    line = gram.solve(name, {**k.MODEL_DEFAULTS[name], **(settings or {})}, sums.imputed(fills), fills,
                      *(() if scaling == "standard" else (centre, spread)))
    given = as_transformer(fits, floating_columns(rows))
    at, by = (line.centre, line.spread) if scaling == "standard" else (np.zeros(len(used)), np.ones(len(used)))
    terms = [f"{float(w / s)!r}D * (`{PREFIX}{c}` - {float(m)!r}D)" for c, w, m, s in zip(used, line.weights, at, by) if w]
    summed = SQLTransformer(statement=f"select *, {' + '.join([f'{line.intercept!r}D', *terms])} as {RAW} from __THIS__")
    return FittedModel(name, used, PipelineModel([given, summed, floor_at_zero()]), dict(settings or {}), line.weights.tolist(), line.intercept,
                       [[float(x) for x in at], [float(x) for x in by]])


def fit_packed(name: str, rows: DataFrame, features: list[str], label: str, settings: dict, given: dict, imputing: bool, seed: int) -> FittedModel:
    """A tree or a boosted ensemble on packed bins: the rows are held in a tenth of the space of their vectors."""
    fits = fit_columns(rows, features, None, imputing)
    filled = as_transformer(fits, floating_columns(rows))
    boosted = {"rounds": int(settings["n_estimators"]), "rate": float(settings["learning_rate"]), "share": float(settings.get("subsample", 1.0)),
               "columns": float(settings.get("colsample", 1.0))} if name in BOOSTING else {}
    inputs = [PREFIX + c for c in fits]
    model = packed_trees.fit_trees(filled.transform(rows), inputs, label, RAW, depth_of(settings), int(settings.get("min_leaf", 1)), seed=seed, **boosted)
    return FittedModel(name, list(fits), PipelineModel([filled, model, floor_at_zero()]), given)


def fit_model(name: str, train: DataFrame, features: list[str], label: str = k.TARGET, settings: dict | None = None,
              scaling: str | None = "standard", imputing: bool = True, seed: int = k.SEED) -> FittedModel:
    """Preparation and regression as one saved unit. Trees are not scaled. Rows without a label are left out, with a warning that
    says how many; a table without any is an error. ``validate.input_report`` tells of all columns."""
    if name not in MODELS:
        raise ValueError(f"unknown model {name}, choose one of {MODELS}")
    require_columns(require_rows(train), [label, *features])
    known = train.agg(F.count(label).alias("labels"), F.count("*").alias("n")).first()
    if not known.labels:
        raise ValueError(f"no row has a {label}")
    if known.labels < known.n:
        warnings.warn(f"{known.n - known.labels} rows without {label} are left out of the fit", stacklevel=2)
    rows = train.select(label, *features).dropna(subset=[label])
    if name in LINEAR:
        return fit_line(name, rows, features, label, settings, scaling, imputing)
    s = {**k.MODEL_DEFAULTS[name], **(settings or {})}
    if name != "random_forest" and depth_of(s) <= packed_trees.DEEPEST:
        return fit_packed(name, rows, features, label, s, dict(settings or {}), imputing, seed)
    checkpointed(train.sparkSession)
    prepared = prepare(rows, features, label, INPUT, None, imputing, dealt=name in BOOSTING)
    if name == "random_forest":
        # a forest has many nodes and few rows: see grow_forest
        held = keep(prepared.rows.coalesce(max(1, -(-prepared.rows.count() // FOREST_ROWS))))
        models = grow_forest(held, label, settings, seed)
        held.unpersist()
        trees, total = [m.getNumTrees for m in models], sum(m.getNumTrees for m in models)
        for i, m in enumerate(models):
            m.setPredictionCol(f"{RAW}_{i}")
        mean = " + ".join(f"{n / total!r}D * {RAW}_{i}" for i, n in enumerate(trees))
        grown = [*models, SQLTransformer(statement=f"select *, {mean} as {RAW} from __THIS__")]
    else:
        trees, grown = None, [estimator(name, label, settings, seed).fit(prepared.rows)]
    prepared.held.unpersist()
    return FittedModel(name, prepared.used, PipelineModel([*prepared.stages, *grown, floor_at_zero()]), dict(settings or {}), trees=trees)


def importance_detail(importance: DataFrame, top: int = 10) -> DataFrame:
    """The ``top`` features with their share, and the shares of the first five and ten.

    The table has one row per model input, so ranking it in one place is bounded by the feature count.
    """
    ranked = importance.withColumn("rnk", F.row_number().over(W.orderBy(F.desc("importance"), "feature")))
    sums = ranked.agg(F.sum("importance").alias("_all"), F.sum(F.when(F.col("rnk") <= 5, F.col("importance"))).alias("_five"),
                      F.sum(F.when(F.col("rnk") <= 10, F.col("importance"))).alias("_ten"))
    shares = F.struct(ratio(F.col("_five"), F.col("_all")).alias("five"), ratio(F.col("_ten"), F.col("_all")).alias("ten"))
    return (ranked.withColumn("_s", sums.select(shares).scalar()).filter(F.col("rnk") <= top)
            .select("rnk", "feature", "importance", F.col("_s.five").alias("top_5_share"), F.col("_s.ten").alias("top_10_share")))
