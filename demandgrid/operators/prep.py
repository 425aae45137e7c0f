"""Preparation of model inputs: exact median imputation, scaling, finite values.

Fitted values are a few numbers per column. The fitted step is an ``SQLTransformer``, so it runs as plain column
expressions, saves with the model and needs no Python at prediction time.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.feature import ElementwiseProduct, SQLTransformer, StandardScaler, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..constants import FINITE_LIMIT
from ..functions.numeric import finite
from ..session import keep
from .quantiles import exact_medians, exact_quantiles, first_row

PREFIX = "x_"
# of rows dealt evenly
PARTS_PER_CORE = 2


@dataclass(frozen=True)
class ColumnFit:
    """``(value - centre) / spread`` after missing values became ``fill``."""
    fill: float | None
    centre: float = 0.0
    spread: float = 1.0


def known(c: str) -> Column:
    """Value for statistics: NaN is missing, infinities are the largest accepted magnitude."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), finite(x))


def fit_medians(train: DataFrame, columns: list[str], approx: bool = False) -> dict[str, float | None]:
    if approx:
        return train.agg(*[F.percentile_approx(known(c), 0.5, 10_000).alias(c) for c in columns]).first().asDict()
    return exact_medians(train, columns, FINITE_LIMIT)


def impute(df: DataFrame, medians: dict[str, float | None]) -> DataFrame:
    return df.withColumns({c: F.coalesce(known(c), F.lit(m)) for c, m in medians.items() if m is not None})


def fit_columns(train: DataFrame, columns: list[str], scaling: str | None = "standard", imputing: bool = True,
                approx: bool = False) -> dict[str, ColumnFit]:
    """Columns without any value have no median and are left out. Scaling is fitted on the imputed values."""
    if scaling not in (None, "standard", "robust"):
        raise ValueError(f"unknown scaling {scaling}")
    fills = fit_medians(train, columns, approx) if imputing else {c: None for c in columns}
    used = [c for c in columns if not imputing or fills[c] is not None]
    filled = impute(train.select(*used), fills) if imputing else train.select(*[known(c).alias(c) for c in used])
    if scaling == "standard":
        means = first_row(filled, [F.avg(c) for c in used])
        spreads = first_row(filled, [F.stddev_pop(c) for c in used])
        return {c: ColumnFit(fills[c], means[i] or 0.0, spreads[i] or 1.0) for i, c in enumerate(used)}
    if scaling == "robust":
        q = exact_quantiles(filled, used, [0.25, 0.5, 0.75])
        return {c: ColumnFit(fills[c], q[c][1], (q[c][2] - q[c][0]) or 1.0) for c in used}
    return {c: ColumnFit(fills[c]) for c in used}


def apply_columns(df: DataFrame, fits: dict[str, ColumnFit], prefix: str = "") -> DataFrame:
    def scaled(c: str, f: ColumnFit) -> Column:
        x = F.col(c).cast("double")
        x = x if f.fill is None else F.when(~F.isnan(x), x)
        return finite(((x if f.fill is None else F.coalesce(x, F.lit(f.fill))) - f.centre) / f.spread)
    return df.withColumns({prefix + c: scaled(c, f) for c, f in fits.items()})


def as_transformer(fits: dict[str, ColumnFit], floating: set[str]) -> SQLTransformer:
    """Impute, scale, then missing to 0 and infinite to the largest magnitude, as one statement.

    ``x + x * 0`` is x for numbers and NaN for infinities, which spares a comparison per value; only ``floating``
    columns can hold either.
    """
    def text(c: str, f: ColumnFit) -> str:
        x, missing = f"cast(`{c}` as double)", "0D" if f.fill is None else f"{f.fill!r}D"
        if (f.centre, f.spread) != (0.0, 1.0):
            known = x if f.fill is None else f"coalesce(nanvl({x}, {missing}), {missing})"
            x, missing = f"(({known} - {f.centre!r}D) / {f.spread!r}D)", "0D"
        if c in floating:
            x = f"nanvl(nanvl({x} + {x} * 0D, signum({x}) * {FINITE_LIMIT!r}D), {missing})"
        return f"coalesce({x}, {missing}) as `{PREFIX}{c}`"
    return SQLTransformer(statement=f"select *, {', '.join(text(c, f) for c, f in fits.items())} from __THIS__")


def evenly(rows: DataFrame) -> DataFrame:
    """Rows dealt into parts of one size, some for each core: a pass waits for its largest part, and files make uneven ones."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores * max(PARTS_PER_CORE, -(-rows.rdd.getNumPartitions() // cores)))


@dataclass
class Prepared:
    """Fitted stages from columns to the model input, and the training rows that went through them."""
    stages: list
    used: list[str]
    rows: DataFrame
    held: DataFrame

    def apply(self, df: DataFrame) -> DataFrame:
        for stage in self.stages:
            df = stage.transform(df)
        return df


def prepare(train: DataFrame, columns: list[str], label: str, output: str, scaling: str | None = "standard",
            imputing: bool = True, approx: bool = False, dealt: bool = False) -> Prepared:
    """Fit imputation and scaling and hold the assembled training rows, which every iteration of a fit reads.

    Standard scaling runs on the assembled vectors, where mean and deviation come from one pass over held data.
    Spark's scaler divides by the sample deviation; the last stage turns that into the population deviation.
    ``dealt`` rows are held in even parts, which pays where a fit passes over them a thousand times.
    """
    fits = fit_columns(train, columns, scaling if scaling == "robust" else None, imputing, approx)
    used, joined = list(fits), output if scaling != "standard" else output + "_raw"
    floating = {f.name for f in train.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    stages = [as_transformer(fits, floating), VectorAssembler(inputCols=[PREFIX + c for c in used], outputCol=joined)]
    rows = train
    for stage in stages:
        rows = stage.transform(rows)
    rows = rows.select(label, joined)
    rows = held = keep(evenly(rows) if dealt else rows)
    if scaling == "standard":
        n = rows.count()
        scaler = StandardScaler(inputCol=joined, outputCol=output + "_z", withMean=True, withStd=True).fit(rows)
        factor = Vectors.dense([math.sqrt(n / (n - 1)) if n > 1 else 1.0] * len(used))
        stages += [scaler, ElementwiseProduct(scalingVec=factor, inputCol=output + "_z", outputCol=output)]
        for stage in stages[2:]:
            rows = stage.transform(rows)
        rows = rows.select(label, output)
    return Prepared(stages, used, rows, held)
