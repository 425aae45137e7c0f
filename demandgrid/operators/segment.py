"""Store segmentation over the dashboard: scale, reduce, cluster, score, name."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, PCAModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window as W, functions as F

from .. import constants as k
from ..session import keep
from .prep import ColumnFit, apply_columns, fit_columns


def scale_features(stores: DataFrame, key: str = "store_id") -> DataFrame:
    """All measures but the key as z-scores with the population deviation; a missing measure counts as average."""
    stores, columns = keep(stores), [c for c in stores.columns if c != key]
    fits = fit_columns(stores, columns, "standard", imputing=False)
    known = {c: ColumnFit(f.centre, f.centre, f.spread) for c, f in fits.items()}
    return apply_columns(stores, known)


def reduce_features(scaled: DataFrame, share: float = k.SEGMENT_VARIANCE, key: str = "store_id") -> tuple[DataFrame, PCAModel, int]:
    """Principal components up to ``share`` of the variance, as array ``components``."""
    columns = [c for c in scaled.columns if c != key]
    vectors = VectorAssembler(inputCols=columns, outputCol="_all").transform(scaled)
    model = PCA(k=len(columns), inputCol="_all", outputCol="_pca").fit(vectors)
    total, needed = 0.0, len(columns)
    for i, part in enumerate(model.explainedVariance, 1):
        total += part
        if total >= share - 1e-12:
            needed = i
            break
    reduced = model.transform(vectors).select(key, F.slice(vector_to_array("_pca"), 1, needed).alias("components"))
    return reduced, model, needed


def explained_variance(model: PCAModel, needed: int, df: DataFrame) -> DataFrame:
    parts = [float(x) for x in model.explainedVariance]
    rows = [(i + 1, v, sum(parts[:i + 1]), i < needed) for i, v in enumerate(parts)]
    return df.sparkSession.createDataFrame(rows, "component int, share double, cumulative double, kept boolean")


def with_vector(reduced: DataFrame) -> DataFrame:
    return reduced.withColumn("features", array_to_vector("components"))


def fit_clusters(reduced: DataFrame, count: int = k.SEGMENT_COUNT, seed: int = k.SEED) -> KMeansModel:
    return KMeans(k=count, seed=seed, featuresCol="features", predictionCol="health_cluster").fit(with_vector(reduced))


def sweep(reduced: DataFrame, low: int = k.SEGMENT_SWEEP[0], high: int = k.SEGMENT_SWEEP[1], seed: int = k.SEED) -> DataFrame:
    """Inertia and silhouette per cluster count. The silhouette uses squared distances, the form that needs one pass."""
    data = keep(with_vector(reduced))
    judge = ClusteringEvaluator(predictionCol="health_cluster", featuresCol="features")
    rows = []
    for count in range(low, high + 1):
        model = fit_clusters(data.drop("features"), count, seed)
        rows.append((count, float(model.summary.trainingCost), float(judge.evaluate(model.transform(data)))))
    data.unpersist()
    return reduced.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def assign_clusters(reduced: DataFrame, model: KMeansModel) -> DataFrame:
    return model.transform(with_vector(reduced)).drop("features")


def health_score(df: DataFrame, centres: list[list[float]], vector: str = "components") -> DataFrame:
    """Minus the distance to the nearest centre. Centres are a handful of short arrays, held in the plan as literals."""
    def squared(centre):
        point = F.array(*[F.lit(float(x)) for x in centre])
        return F.aggregate(F.zip_with(vector, point, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    distances = F.array(*[squared(c) for c in centres])
    return df.withColumn("health_score", -F.sqrt(F.array_min(distances)))


def health_index(df: DataFrame) -> DataFrame:
    """The score stretched to 0-100; NULL if all scores are equal."""
    ends = df.agg(F.struct(F.min("health_score").alias("low"), F.max("health_score").alias("high"))).scalar()
    spread = F.col("_ends.high") - F.col("_ends.low")
    return (df.withColumn("_ends", ends)
            .withColumn("health_index", F.try_divide(100 * (F.col("health_score") - F.col("_ends.low")), spread)).drop("_ends"))


def cluster_names(df: DataFrame, cluster: str = "health_cluster", by: str = "total_units",
                  names: list[str] = k.SEGMENT_NAMES) -> DataFrame:
    """Name clusters from weakest to strongest mean ``by``; an error if there are more clusters than names."""
    means = df.groupBy(cluster).agg(F.avg(by).alias("_mean"))
    labels = F.array(*[F.lit(n) for n in names])
    place = F.row_number().over(W.orderBy("_mean", cluster))
    short = F.raise_error(F.lit(f"more clusters than the {len(names)} names")).cast("string")
    named = means.select(cluster, F.when(place > len(names), short).otherwise(F.get(labels, place - 1)).alias("cluster_name"))
    return df.join(named, cluster, "left")


def segment_stores(stores: DataFrame, count: int = k.SEGMENT_COUNT, share: float = k.SEGMENT_VARIANCE,
                   seed: int = k.SEED, names: list[str] = k.SEGMENT_NAMES) -> DataFrame:
    """Dashboard with ``health_cluster, health_score, health_index, cluster_name``."""
    if count > len(names):
        raise ValueError(f"{count} clusters need as many names, {len(names)} were given")
    stores = keep(stores)
    reduced = keep(reduce_features(scale_features(stores), share)[0])
    model = fit_clusters(reduced, count, seed)
    scored = health_score(assign_clusters(reduced, model), [list(map(float, c)) for c in model.clusterCenters()])
    return cluster_names(stores.join(health_index(scored.drop("components")), "store_id"), names=names)
