"""Every operator as a named query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import constants as k
from ..functions.vectors import parse_vector
from ..functions.numeric import finite, round_fraction
from ..operators import evaluate, features as ft, naive, prep, profile, regressors, segment, training, validate
from ..operators.hourly import expand_hours, unnest_hours
from ..operators.series import global_position, over_series
from ..session import keep, shared_path, written
from ..sources import sinks
from ..sources.fixtures import hourly_events, raw_sales, split_sales
from ..sources.sampling import sample_fraction, sample_rows
from ..sources.tables import load_report, publish_views
from . import feature_set, questions, views

Query = Callable[[SparkSession, str], DataFrame]
KEYS = [*k.SERIES, k.TIME]


def rounded(df: DataFrame, *exact: str, places: int = 6) -> DataFrame:
    """Floating results at six places, so that the order of additions does not show."""
    # MAPE divides by 1e-8 where nothing was sold: of its eleven digits before the point the rest is noise
    floats = {f.name: round_fraction(f.name, 0 if f.name == "MAPE" else places) for f in df.schema
              if isinstance(f.dataType, T.DoubleType) and f.name not in exact}
    return df.withColumns(floats) if floats else df


def on_sales(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: rounded(operator(raw_sales(spark, folder)))


def on_split(operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: rounded(operator(*split_sales(raw_sales(spark, folder))))


def on_events(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: rounded(operator(hourly_events(spark, folder)))


def added(df: DataFrame, before: DataFrame) -> DataFrame:
    """Keys and the columns an operator added."""
    return df.select(*KEYS, *[c for c in df.columns if c not in before.columns])


def new_columns(operator: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
    return lambda df: added(operator(df), df)


# sources, vectors, views ------------------------------------------------------------------------------------

def src_views(spark: SparkSession, folder: str) -> DataFrame:
    publish_views(raw_sales(spark, folder))
    return spark.sql("select store_id, sum(sale_amount_hour) as units, sum(stockout_risk_hour) as risk_hours "
                     "from hourly_business_summary group by store_id")


def view_hourly_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Daily columns are rounded before the explode, and the hourly value after it."""
    return rounded(views.by_hour(rounded(views.daily_flags(raw_sales(spark, folder)))), "precpt", "discount")


def vec_zip_explode(sales: DataFrame) -> DataFrame:
    return expand_hours(sales).groupBy(*k.SERIES, "sale_amount_hour", "stock_status_hour").agg(F.count("*").alias("n"))


def vec_hour_index(sales: DataFrame) -> DataFrame:
    return expand_hours(sales).groupBy("product_id", "hour").agg(
        F.count("*").alias("n"), F.min("sale_amount_hour").alias("low"), F.max("sale_amount_hour").alias("high"))


def vec_rename(sales: DataFrame) -> DataFrame:
    return expand_hours(sales).groupBy("store_id", "hour").agg(
        F.sum("sale_amount_hour").alias("sale_amount_hour"), F.sum("stock_status_hour").alias("stock_status_hour"))


# profile and validation -------------------------------------------------------------------------------------

def lag_table(sales: DataFrame, *columns: str) -> DataFrame:
    rows = sales.select(*KEYS, k.TARGET)
    lagged = over_series(rows, lambda w: {f"{k.TARGET}_lag_{n}": F.lag(k.TARGET, n).over(w) for n in k.LAG_PERIODS},
                         max(k.LAG_PERIODS), tie=[*KEYS, k.TARGET])
    return lagged.select(*columns, *[f"{k.TARGET}_lag_{n}" for n in k.LAG_PERIODS])


def with_lags(sales: DataFrame) -> DataFrame:
    """All columns and the lags, which are missing where a series begins."""
    return over_series(sales, lambda w: {f"{k.TARGET}_lag_{n}": F.lag(k.TARGET, n).over(w) for n in k.LAG_PERIODS}, max(k.LAG_PERIODS), tie=[*KEYS, k.TARGET])


def prof_duplicates(sales: DataFrame) -> DataFrame:
    """All columns of a table in which the rows of every seventh store lie twice."""
    return profile.duplicate_rows(sales.unionByName(sales.filter(F.col("store_id") % 7 == 0)))


def val_input(sales: DataFrame) -> DataFrame:
    """All columns and the lags, with an amount per rain that is infinite on dry days."""
    per_rain = F.when(F.col("precpt") == 0, F.lit(float("inf"))).otherwise(F.col(k.TARGET) / F.col("precpt"))
    return validate.input_report(with_lags(sales).withColumn("amount_per_rain", per_rain)).drop("is_target")


def val_drop_all_null(sales: DataFrame) -> DataFrame:
    """No series is 5,000 days long, so that lag is empty and goes."""
    far = over_series(sales.select(*KEYS, k.TARGET), lambda w: {
        "sale_amount_lag_1": F.lag(k.TARGET, 1).over(w), "sale_amount_lag_5000": F.lag(k.TARGET, 5000).over(w)}, 5000)
    return validate.drop_all_null(far.drop(k.TARGET))


# features ---------------------------------------------------------------------------------------------------

def with_status(sales: DataFrame) -> DataFrame:
    return sales.select(*KEYS, k.TARGET, ft.daily_status().alias("stock_status"))


def rolled(*kinds: str) -> Callable[[DataFrame], DataFrame]:
    return new_columns(lambda s: ft.rolling(s, kinds=kinds)) if "stock_ratio" in kinds else \
        (lambda sales: new_columns(lambda s: ft.rolling(s, kinds=kinds))(sales.select(*KEYS, k.TARGET)))


def lagged(prefix: str) -> Callable[[DataFrame], DataFrame]:
    return lambda s: (d := ft.lags(with_status(s))).select(*KEYS, *[c for c in d.columns if c.startswith(prefix)])


def ft_fourier(sales: DataFrame) -> DataFrame:
    placed = over_series(sales.select(*KEYS), lambda w: {}, 0, position="_place")
    return ft.fourier(placed, "_place").drop("_place")


def ft_fourier_global(sales: DataFrame) -> DataFrame:
    placed = over_series(sales.select(*KEYS), lambda w: {}, 0, position="_place")
    return ft.fourier(global_position(placed, "_t"), "_t").drop("_place", "_t")


def ft_stats(fit: Callable[[DataFrame], DataFrame], key: str) -> Callable[[DataFrame], DataFrame]:
    def run(sales: DataFrame) -> DataFrame:
        rows = sales.select(*KEYS, k.TARGET)
        return ft.apply_statistics(rows, ft.fitted(fit(ft.series_profile(rows))), key).drop(k.TARGET)
    return run


def ft_unmet(sales: DataFrame) -> DataFrame:
    return ft.unmet_demand(ft.lags(with_status(sales))).select(*KEYS, "unmet_demand")


def ft_interactions(sales: DataFrame) -> DataFrame:
    d = ft.rush(ft.weekpart(ft.calendar(sales.withColumn("stock_status", ft.daily_status()))))
    return added(ft.interactions(d), d)


# forecasts and metrics --------------------------------------------------------------------------------------

def forecast(strategy: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    return lambda train, test: naive.predict_naive(test.select(*KEYS), naive.fit_naive(train, strategy))


def fc_apply(train: DataFrame, test: DataFrame) -> DataFrame:
    fit = naive.fit_naive(train, "mean")
    known = fit.select(*k.SERIES, F.lit(0).alias("_known"))
    return (naive.predict_naive(test.select(*KEYS), fit).join(known, k.SERIES, "left")
            .withColumn("is_new", F.coalesce("_known", F.lit(1))).drop("_known"))


def fc_seasonal_naive(hourly: DataFrame) -> DataFrame:
    cut = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    fit = naive.fit_seasonal_naive(hourly.filter(F.col("dt") < cut))
    return naive.predict_seasonal_naive(hourly.filter(F.col("dt") >= cut).select(*KEYS), fit)


def scores(train: DataFrame, test: DataFrame) -> DataFrame:
    fit = naive.fit_naive(train, "drift")
    return naive.predict_naive(test.select(*KEYS, "city_id", "holiday_flag", F.col(k.TARGET).alias("y")), fit, name="p")


def metric(name: str) -> Callable[[DataFrame, DataFrame], DataFrame]:
    return lambda train, test: scores(train, test).agg(evaluate.METRICS[name](F.col("y"), F.col("p")).alias(name))


# models -----------------------------------------------------------------------------------------------------

_FEATURE_FITS: dict[tuple[str, str], feature_set.FeatureFit] = {}
_FEATURE_TABLES: dict[tuple[str, str, int], DataFrame] = {}


def features_of(spark: SparkSession, folder: str, part: int) -> DataFrame:
    """Features of the training (0) or evaluation rows (1), written once per session to the shared folder: every model reads
    them several times, and a lost executor must not set off the whole feature plan again. The texts of hours, which no model
    reads, stay behind before the rows are shuffled."""
    slot = (spark.sparkContext.applicationId, folder)
    if (*slot, part) not in _FEATURE_TABLES:
        sides = split_sales(raw_sales(spark, folder))
        if slot not in _FEATURE_FITS:
            _FEATURE_FITS[slot] = feature_set.fit_features(sides[0])
        rows = sides[part].withColumn("stock_status", ft.daily_status()).drop(k.SALE_VECTOR, k.VALUE_VECTOR)
        found = feature_set.engineer(rows, _FEATURE_FITS[slot], status_from="given")
        _FEATURE_TABLES[*slot, part] = written(found, ("train-features", "eval-features")[part])
    return _FEATURE_TABLES[*slot, part]


def training_features(spark: SparkSession, folder: str) -> DataFrame:
    return features_of(spark, folder, 0)


def feature_tables(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return features_of(spark, folder, 0), features_of(spark, folder, 1)


LAG_COLUMNS = [f"{k.TARGET}_lag_{n}" for n in k.LAG_PERIODS]
SCALED = ["avg_temperature", "precpt", "discount", k.TARGET]


def lag_split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return tuple(lag_table(part, *KEYS) for part in split_sales(raw_sales(spark, folder)))


def ml_impute(spark: SparkSession, folder: str) -> DataFrame:
    train, test = lag_split(spark, folder)
    return prep.impute(test, prep.fit_medians(train, LAG_COLUMNS))


def ml_scale(scaling: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        train, test = (d.select(*KEYS, *SCALED) for d in split_sales(raw_sales(spark, folder)))
        return rounded(prep.apply_columns(test, prep.fit_columns(train, SCALED, scaling)))
    return run


def ml_finite(sales: DataFrame) -> DataFrame:
    """Discount over precipitation as plain floating division, which gives infinities on dry days and NaN at 0/0."""
    dry, flat = F.col("precpt") == 0, F.col("sale_amount") == 0
    cell = F.when(dry & flat, float("nan")).when(dry, float("inf")).when(flat, float("-inf")).otherwise(F.col("sale_amount"))
    return sales.select(*KEYS, finite(cell).alias("x"))


def yes(condition: Column, name: str) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int").alias(name)


def predicted(name: str, settings: dict | None = None) -> Query:
    """Forecasts from all features, and what must hold for them: none missing, none negative, and a smaller squared
    error than the mean of the training target has."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        train, test = feature_tables(spark, folder)
        model = regressors.fit_model(name, train, training.feature_columns(train), settings=settings)
        y, p, mean = F.col(k.TARGET), F.col("prediction"), F.lit(train.agg(F.avg(k.TARGET)).first()[0])
        return model.predict(test).agg(
            F.count("*").alias("n_rows"), F.count_if(p.isNull() | F.isnan(p)).alias("n_missing"), F.count_if(p < 0).alias("n_negative"),
            yes(F.avg((y - p) * (y - p)) < F.avg((y - mean) * (y - mean)), "beats_mean"))
    return run


def fitted_line(name: str, spark: SparkSession, folder: str) -> regressors.FittedModel:
    train = training_features(spark, folder)
    return regressors.fit_model(name, train, training.feature_columns(train), settings=k.MODEL_SETTINGS.get(name))


def ml_linear(spark: SparkSession, folder: str) -> DataFrame:
    """The normal equations of least squares over all inputs: products with the label equal those with the fitted values."""
    model = fitted_line("linear", spark, folder)
    return rounded(model.normal_equations(training_features(spark, folder), k.TARGET), places=5)


def line_weights(name: str) -> Query:
    """Coefficients of all scaled inputs."""
    return lambda spark, folder: rounded(fitted_line(name, spark, folder).coefficients(spark), places=5)


def line_forecasts(name: str) -> Query:
    """Forecasts of all evaluation rows from all inputs."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        found = fitted_line(name, spark, folder).predict(feature_tables(spark, folder)[1])
        return rounded(found.select(*KEYS, "prediction"), places=5)
    return run


def ml_linear_full(spark: SparkSession, folder: str) -> DataFrame:
    """Mean forecast by store: single ones hang on inputs that nearly depend on each other, beyond the digits of any solver."""
    found = fitted_line("linear", spark, folder).predict(feature_tables(spark, folder)[1])
    return rounded(found.groupBy("store_id").agg(F.count("*").alias("n_rows"), F.avg("prediction").alias("mean_forecast")), places=3)


def single(spark: SparkSession, folder: str) -> tuple[regressors.FittedModel, DataFrame]:
    """One unscaled input, so that SQL knows the least-squares answer."""
    train, _ = split_sales(raw_sales(spark, folder))
    rows = train.select(k.TARGET, "discount")
    return regressors.fit_model("linear", rows, ["discount"], scaling=None), rows


def ml_coefficients(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(single(spark, folder)[0].coefficients(spark))


def ml_r2(spark: SparkSession, folder: str) -> DataFrame:
    model, rows = single(spark, folder)
    return rows.agg(F.count("*").alias("n_samples")).withColumn("train_r2", F.round(F.lit(model.r2(rows, k.TARGET)), 6))


def ml_predict(spark: SparkSession, folder: str) -> DataFrame:
    model, _ = single(spark, folder)
    test = split_sales(raw_sales(spark, folder))[1]
    return rounded(model.predict(test.select(*KEYS, "discount")).select(*KEYS, "prediction"))


def ml_importance(spark: SparkSession, folder: str) -> DataFrame:
    train = training_features(spark, folder)
    found = regressors.fit_model("decision_tree", train, training.feature_columns(train)).importance(spark)
    return rounded(found.agg(F.sum("importance").alias("total"), F.count_if(F.col("importance") < 0).alias("n_negative"),
                             yes(F.count("*") == len(training.feature_columns(train)), "one_per_feature")))


def ml_importance_detail(sales: DataFrame) -> DataFrame:
    table = sales.groupBy(F.concat(F.lit("product_"), F.col("product_id").cast("string")).alias("feature")).agg(
        F.sum(k.TARGET).alias("importance"))
    return regressors.importance_detail(table)


def metric_columns(record: DataFrame, *names: str) -> list[Column]:
    return [F.col(side)[n].alias(f"{side[:-8]}_{n}") for side in ("train_metrics", "eval_metrics") for n in names]


def ml_train_eval(spark: SparkSession, folder: str) -> DataFrame:
    """A training run of the lasso with its metrics on both sets and its importances."""
    record = training.train_and_evaluate("lasso", *feature_tables(spark, folder))[1]
    found = record.select("experiment", "model_name", "n_train_samples", "n_eval_samples", "n_features",
                          *metric_columns(record, "MAE", "RMSE", "Bias"), F.col("eval_metrics")["MASE"].alias("eval_MASE"),
                          F.aggregate(F.map_values("feature_importance"), F.lit(0.0), lambda s, x: s + x).alias("importance_total"))
    return rounded(found, places=4)


def ml_grid(spark: SparkSession, folder: str) -> DataFrame:
    """All rows of the linear grids over five folds."""
    found = training.tune_lines({name: k.MODEL_GRIDS[name] for name in ("linear", "ridge", "lasso")}, training_features(spark, folder), held=False)
    return rounded(found.select("model_name", F.col("params")["alpha"].cast("double").alias("alpha"),
                                F.col("params")["fit_intercept"].cast("boolean").alias("fit_intercept"), "mae", "is_best"), "alpha", places=4)


def snk_results(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs appended to one results table and read back, with the metrics on both sets."""
    path = shared_path(spark, "results")
    # the naive models read keys and target alone, but a dozen times
    train, test = split_sales(written(raw_sales(spark, folder).select(*KEYS, k.TARGET), "daily"))
    for name in ("mean", "naive"):
        _, record = training.train_and_evaluate(name, train, test)
        sinks.append_results(record, path)
    stored = sinks.read_results(spark, path)
    return rounded(stored.select("experiment", "model_name", "n_features", "n_train_samples", "n_eval_samples",
                                 *metric_columns(stored, "MAE", "RMSE", "sMAPE", "Bias"), F.col("eval_metrics")["MASE"].alias("eval_MASE")))


def snk_model(spark: SparkSession, folder: str) -> DataFrame:
    """Forecasts of a model that was saved and loaded, with its name and features."""
    model, _ = single(spark, folder)
    path = shared_path(spark, "model")
    sinks.save_fitted_model(model, path)
    loaded = sinks.load_fitted_model(path)
    if (loaded.name, loaded.features) != (model.name, model.features):
        raise ValueError("the loaded model has another name or other features")
    test = split_sales(raw_sales(spark, folder))[1].select(*KEYS, "discount")
    return rounded(loaded.predict(test).select(*KEYS, "prediction"))


# segmentation -----------------------------------------------------------------------------------------------

def reduced_stores(spark: SparkSession, folder: str) -> DataFrame:
    return keep(segment.reduce_features(segment.scale_features(views.store_dashboard(raw_sales(spark, folder))))[0])


def seg_pca(spark: SparkSession, folder: str) -> DataFrame:
    scaled = keep(segment.scale_features(views.store_dashboard(raw_sales(spark, folder))))
    _, model, needed = segment.reduce_features(scaled)
    found = segment.explained_variance(model, needed, scaled)
    return rounded(found.agg(F.count("*").alias("n_components"), F.sum("share").alias("total"),
                             yes(F.min(F.when(F.col("kept"), F.col("component"))) == 1, "first_is_kept"),
                             yes(F.max(F.when(~F.col("kept"), F.col("cumulative"))).isNull() | (F.min(F.when(F.col("component") == needed, F.col("cumulative"))) >= k.SEGMENT_VARIANCE - 1e-9), "share_is_reached")))


def seg_pca_all(spark: SparkSession, folder: str) -> DataFrame:
    """Shares of variance of the components of all measures."""
    scaled = keep(segment.scale_features(views.store_dashboard(raw_sales(spark, folder))))
    _, model, needed = segment.reduce_features(scaled)
    return rounded(segment.explained_variance(model, needed, scaled))


def seg_pca_two(sales: DataFrame) -> DataFrame:
    """Over two scaled measures the shares of variance follow from their correlation."""
    scaled = keep(segment.scale_features(views.store_dashboard(sales).select("store_id", "total_units", "sales_cv")))
    _, model, needed = segment.reduce_features(scaled)
    return segment.explained_variance(model, needed, scaled).select("component", "share", "cumulative")


def seg_kmeans(spark: SparkSession, folder: str) -> DataFrame:
    """Stores and clusters, and whether each store lies in the cluster of its nearest centre."""
    reduced = reduced_stores(spark, folder)
    model = segment.fit_clusters(reduced)
    centres = [list(map(float, c)) for c in model.clusterCenters()]
    distance = [F.aggregate(F.zip_with("components", F.array(*map(F.lit, c)), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x) for c in centres]
    own = F.element_at(F.array(*distance), F.col("health_cluster") + 1)
    return segment.assign_clusters(reduced, model).agg(
        F.count("*").alias("n_stores"), F.count_distinct("health_cluster").alias("n_clusters"),
        F.count_if(own > F.array_min(F.array(*distance)) + 1e-9).alias("n_misplaced"))


def seg_sweep(spark: SparkSession, folder: str) -> DataFrame:
    found = segment.sweep(reduced_stores(spark, folder))
    return found.select("k", yes(F.col("inertia") >= 0, "has_inertia"), yes(F.col("silhouette").between(-1, 1), "has_silhouette"))


def scored_stores(sales: DataFrame) -> DataFrame:
    """Scores over all scaled measures, against centres that SQL can name too: the means of every fourth store."""
    scaled = keep(segment.scale_features(views.store_dashboard(sales)))
    measures = [c for c in scaled.columns if c != "store_id"]
    centres = scaled.groupBy((F.col("store_id") % 4).alias("g")).agg(F.array(*[F.avg(c) for c in measures]).alias("centre"))
    points = [r.centre for r in centres.orderBy("g").collect()]
    return segment.health_score(scaled.select("store_id", F.array(*measures).alias("components")), points)


def seg_names(sales: DataFrame) -> DataFrame:
    stores = views.store_dashboard(sales).select("store_id", "total_units", (F.col("store_id") % 4).alias("health_cluster"))
    return segment.cluster_names(stores)


def snk_segments(spark: SparkSession, folder: str) -> DataFrame:
    """The segmented stores as CSV and back."""
    path = shared_path(spark, "segments")
    stores = segment.segment_stores(views.store_dashboard(raw_sales(spark, folder)))
    sinks.write_segments(stores, path)
    back = spark.read.option("header", True).schema(stores.schema).csv(path)
    return rounded(back.select("store_id", "total_units", yes(F.col("health_cluster").between(0, k.SEGMENT_COUNT - 1), "has_cluster"),
                               yes(F.col("cluster_name").isin(*k.SEGMENT_NAMES), "has_name"), yes(F.col("health_index").between(0, 100), "has_index")))


def build() -> dict[str, Query]:
    found: dict[str, Query] = {
        "src_load": on_split(load_report),
        "src_sample_frac": on_sales(lambda s: sample_fraction(s.select(*KEYS, k.TARGET), 0.1, KEYS)),
        "src_sample_n": on_sales(lambda s: sample_rows(s.select(*KEYS, k.TARGET), 20_000, KEYS)),
        "src_views": src_views,
        "vec_parse": on_sales(lambda s: s.select(*KEYS, parse_vector(k.SALE_VECTOR).alias("sale_values"),
                                                 parse_vector(k.VALUE_VECTOR, "int").alias("status_values"))),
        "vec_unnest_ord": on_sales(lambda s: unnest_hours(s.select("store_id", k.VALUE_VECTOR), k.VALUE_VECTOR)
                                   .groupBy("store_id", "hour_index").agg(F.sum("val").alias("total"), F.count("*").alias("n"))),
        "vec_zip_explode": on_sales(vec_zip_explode),
        "vec_hour_index": on_sales(vec_hour_index),
        "vec_rename": on_sales(vec_rename),
        "view_hourly_summary": view_hourly_summary,
        "view_store_dashboard": on_sales(views.store_dashboard),
        "view_category_intel": on_sales(views.category_intelligence),
        "view_rhythm_agg": on_sales(views.rhythm_agg),
        "view_rhythm_patterns": on_sales(views.rhythm_patterns),
    }
    found |= {name: on_sales(question) for name, question in questions.ALL.items()}
    found |= {
        "t3c_wide": on_sales(lambda s: questions.t3c(s, availability=0.9, lift=0.11)),
        "q26_sales": on_sales(lambda s: questions.q26(s, value_from="hours_sale")),
        "prof_shape_span": on_sales(profile.shape_span),
        "prof_dimensions": on_sales(profile.dimensions),
        "prof_target": on_sales(profile.target_statistics),
        "prof_stockout": on_sales(profile.stockout_analysis),
        "prof_missing": on_sales(lambda s: profile.missing_values(with_lags(s))),
        "prof_duplicates": on_sales(prof_duplicates),
        "val_input": on_sales(val_input),
        "val_drop_all_null": on_sales(val_drop_all_null),
        "val_numeric_only": on_sales(lambda s: validate.numeric_only(s, [k.TIME])[0]),
        "ft_calendar": on_events(lambda e: ft.calendar(e.select(*KEYS))),
        "ft_cyclical": on_events(lambda e: (d := ft.cyclical(ft.calendar(e.select(*KEYS)))).select(
            *KEYS, *[c for c in d.columns if c.endswith(("_sin", "_cos"))])),
        "ft_weekpart": on_events(lambda e: ft.weekpart(ft.calendar(e)).select(*KEYS, "is_weekend", "is_weekday")),
        "ft_rush": on_events(lambda e: (d := ft.calendar(e.select(*KEYS))) and added(ft.rush(d), d)),
        "ft_day_part": on_events(lambda e: ft.day_part(ft.calendar(e)).select(*KEYS, "day_part")),
        "ft_holiday": on_sales(lambda s: ft.holiday(s.select(*KEYS))),
        "ft_elapsed": on_events(lambda e: ft.elapsed(e.select(*KEYS))),
        "ft_fourier": on_sales(ft_fourier),
        "ft_fourier_global": on_sales(ft_fourier_global),
        "ft_store_stats": on_sales(ft_stats(ft.fit_store_statistics, "store_id")),
        "ft_product_stats": on_sales(ft_stats(ft.fit_product_statistics, "product_id")),
        "ft_stock_coerce": on_sales(lambda s: s.select(*KEYS, ft.coerced_status().alias("coerced"),
                                                       ft.daily_status().alias("stock_status"))),
        "ft_lag": on_sales(lambda s: lag_table(s, *KEYS)),
        "ft_stockout_lag": on_sales(lagged("stockout_lag_")),
        "ft_unmet_demand": on_sales(ft_unmet),
        "ft_roll_mean": on_sales(rolled("mean")),
        "ft_roll_std": on_sales(rolled("std")),
        "ft_roll_max": on_sales(rolled("max")),
        "ft_roll_median": on_sales(rolled("median")),
        "ft_stock_ratio": on_sales(lambda s: rolled("stock_ratio")(with_status(s))),
        "ft_interactions": on_sales(ft_interactions),
        "ft_all": on_sales(feature_set.engineer),
        "fc_last": on_split(forecast("last")),
        "fc_seasonal_mean": on_split(forecast("seasonal")),
        "fc_mean": on_split(forecast("mean")),
        "fc_drift": on_split(forecast("drift")),
        "fc_apply": on_split(fc_apply),
        "fc_seasonal_naive": on_events(fc_seasonal_naive),
        "ev_mae": on_split(metric("MAE")),
        "ev_rmse": on_split(metric("RMSE")),
        "ev_mape": on_split(metric("MAPE")),
        "ev_smape": on_split(metric("sMAPE")),
        "ev_bias": on_split(metric("Bias")),
        "ev_bias_pct": on_split(metric("Bias_Percentage")),
        "ev_mase": on_split(lambda train, test: evaluate.mase(scores(train, test), train)),
        "ev_all": on_split(lambda train, test: evaluate.evaluate(scores(train, test), train=train)),
        "ev_by_group": on_split(lambda train, test: evaluate.evaluate(scores(train, test), train=train,
                                                                      by=["city_id", "holiday_flag"])),
    }
    found |= {
        "ml_impute": ml_impute,
        "ml_scale_standard": ml_scale("standard"),
        "ml_scale_robust": ml_scale("robust"),
        "ml_finite": on_sales(ml_finite),
        "ml_linear": ml_linear,
        "ml_linear_full": ml_linear_full,
        **{f"ml_{name}": line_weights(name) for name in ("ridge", "lasso", "elasticnet")},
        **{f"ml_{name}_full": line_forecasts(name) for name in ("ridge", "lasso", "elasticnet")},
        **{f"ml_{short}": predicted(name, k.MODEL_SETTINGS.get(name)) for short, name in
           (("tree", "decision_tree"), ("forest", "random_forest"), ("gbt", "gradient_boosting"), ("boost_cols", "boost_cols"))},
        "ml_predict": ml_predict,
        "ml_r2": ml_r2,
        "ml_coefficients": ml_coefficients,
        "ml_importance": ml_importance,
        "ml_importance_detail": on_sales(ml_importance_detail),
        "ml_train_eval": ml_train_eval,
        "ml_grid": ml_grid,
        "seg_scale": on_sales(lambda s: segment.scale_features(views.store_dashboard(s))),
        "seg_pca": seg_pca_all,
        "seg_pca_two": on_sales(seg_pca_two),
        "seg_pca_full": seg_pca,
        "seg_sweep": seg_sweep,
        "seg_kmeans": seg_kmeans,
        "seg_health": on_sales(lambda s: scored_stores(s).select("store_id", "health_score")),
        "seg_index": on_sales(lambda s: segment.health_index(scored_stores(s)).select("store_id", "health_index")),
        "seg_names": on_sales(seg_names),
        "snk_results": snk_results,
        "snk_model": snk_model,
        "snk_segments": snk_segments,
    }
    return found
