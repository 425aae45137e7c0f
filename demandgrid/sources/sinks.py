"""Run records, fitted models and segment files."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.errors import AnalysisException

from ..operators.regressors import FittedModel

RUN_SCHEMA = T.StructType([
    T.StructField("experiment", T.StringType()),
    T.StructField("model_name", T.StringType()),
    T.StructField("recorded_at", T.TimestampType()),
    T.StructField("training_time_seconds", T.DoubleType()),
    T.StructField("train_metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("eval_metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("feature_importance", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("model_config", T.MapType(T.StringType(), T.StringType())),
    T.StructField("n_features", T.LongType()),
    T.StructField("n_train_samples", T.LongType()),
    T.StructField("n_eval_samples", T.LongType()),
])


def run_record(spark: SparkSession, record: dict) -> DataFrame:
    """One run as a one-row table."""
    row = {**{f.name: None for f in RUN_SCHEMA}, **record}
    row["recorded_at"] = row["recorded_at"] or datetime.now()
    row["model_config"] = {key: str(v) for key, v in (row["model_config"] or {}).items()}
    return spark.createDataFrame([row], RUN_SCHEMA)


def append_results(record: DataFrame, path: str) -> None:
    record.write.mode("append").parquet(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_SCHEMA).parquet(path)


def save_best_settings(best: DataFrame, path: str) -> None:
    """Add the winner of a tuning run; later training runs read the newest one per model."""
    best.withColumn("recorded_at", F.current_timestamp()).write.mode("append").parquet(path)


def read_best_settings(spark: SparkSession, path: str, model: str) -> dict:
    """Stored winner for a model, values with the types they were tuned with; empty if nothing has been tuned yet."""
    try:
        stored = spark.read.parquet(path)
    except AnalysisException:
        return {}
    rows = stored.filter(F.col("model_name") == model).orderBy(F.desc("recorded_at")).limit(1).select("params").collect()
    return {name: json.loads(value) for name, value in rows[0].params.items()} if rows else {}


def save_model(model: PipelineModel | None, path: str) -> None:
    if model is None:
        raise ValueError("cannot save a model that is not fitted")
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    try:
        return PipelineModel.load(path)
    except Exception as error:
        raise FileNotFoundError(f"no saved model at {path}") from error


def save_fitted_model(model: FittedModel | None, path: str) -> None:
    """A fitted model with its name, features and settings; the pipeline lies in a folder below."""
    if model is None:
        raise ValueError("cannot save a model that is not fitted")
    save_model(model.pipeline, f"{path}/pipeline")
    spark = SparkSession.active()
    about = json.dumps({key: value for key, value in vars(model).items() if key != "pipeline"})
    spark.createDataFrame([(about,)], "about string").coalesce(1).write.mode("overwrite").text(f"{path}/about")


def load_fitted_model(path: str) -> FittedModel:
    pipeline = load_model(f"{path}/pipeline")
    return FittedModel(**json.loads(SparkSession.active().read.text(f"{path}/about").first()[0]), pipeline=pipeline)


def save_fitted(fitted: DataFrame, path: str) -> None:
    """A fitted per-series table is saved as data."""
    fitted.write.mode("overwrite").parquet(path)


def load_fitted(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        raise FileNotFoundError(f"no saved model at {path}") from error


def write_segments(df: DataFrame, path: str, fmt: str = "csv") -> None:
    writer = df.write.mode("overwrite")
    (writer.option("header", True).csv(path) if fmt == "csv" else writer.parquet(path))
