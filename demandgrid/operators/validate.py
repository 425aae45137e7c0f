"""Input checks before a fit."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from .. import constants as k
from ..functions.numeric import ratio
from ..schema import numeric_columns


def input_report(df: DataFrame, target: str | None = k.TARGET) -> DataFrame:
    """One row per column: missing count and share, infinite count, and what the check says about it."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}

    def infinite(c):
        return F.count_if(F.abs(F.col(c)) == float("inf")) if c in floats else F.lit(0).cast("bigint")

    sums = df.agg(F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(f"m_{c}") for c in df.columns],
                  *[infinite(c).alias(f"i_{c}") for c in df.columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(c == target).alias("is_target"),
                              F.col(f"m_{c}").alias("n_missing"), F.col(f"i_{c}").alias("n_infinite")) for c in df.columns])
    share = ratio(F.col("n_missing"), F.col("_rows"))
    return (sums.select("_rows", F.inline(rows))
            .select("column_name", F.col("_rows").alias("n_rows"), "n_missing", share.alias("missing_share"), "n_infinite",
                    F.when(F.col("_rows") == 0, "empty").when(F.col("n_infinite") > 0, "infinite values")
                    .when(F.col("is_target") & (F.col("n_missing") > 0), "target has missing values")
                    .when(share > k.MISSING_SHARE_WARNING, "mostly missing").otherwise("ok").alias("finding")))


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("the input has no rows")
    return df


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    lacking = [c for c in columns if c not in df.columns]
    if lacking:
        raise ValueError(f"columns needed but not present: {lacking}")
    return df


def drop_all_null(df: DataFrame) -> DataFrame:
    """Without the columns that hold no value at all."""
    known = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first().asDict()
    return df.drop(*[c for c, n in known.items() if n == 0])


def numeric_only(df: DataFrame, keys: list[str] = ()) -> tuple[DataFrame, list[str]]:
    """The numeric columns (and ``keys``) and the names of those left out."""
    kept = [c for c in df.columns if c in keys or c in set(numeric_columns(df))]
    return df.select(*kept), [c for c in df.columns if c not in kept]
