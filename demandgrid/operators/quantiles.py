"""Exact quantiles of many columns at any row count, by distributed selection.

A pass counts the values of every column in ``bins`` of its range, each bin with its least and largest value. Running counts
tell the bin of each wanted rank, and the next pass looks into that bin alone, until its least and largest value agree. Tasks
count whole Arrow batches with numpy and hold counts of bins, never distinct values; Spark adds the counts up, and what comes to
the driver is at most ``bins`` rows for each column and rank. Columns that spread over many magnitudes start with bins of their
logarithm. All columns share every pass.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

# functions that run in Python workers travel with their code, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS = 1024
# one aggregate with more outputs than this falls out of code generation
FIELDS_PER_JOB = 80
# infinities are the largest numbers
LARGEST = 1.7976931348623157e308
# ranges wider than this are cut by logarithm first
WIDE = 1e6


def chunks(items: list, size: int) -> list[list]:
    return [items[i:i + size] for i in range(0, len(items), size)]


def first_row(df: DataFrame, measures: list[Column]) -> list:
    """Values of many aggregates, computed a codegen-sized group at a time."""
    return [v for group in chunks(measures, FIELDS_PER_JOB) for v in df.agg(*group).first()]


@dataclass
class Range:
    """Values of one column, of all rows but those of a group, between two that occur, and how many lie below."""
    column: int
    without: int | None
    low: float = -LARGEST
    high: float = LARGEST
    before: int = 0
    ranks: tuple[int, ...] = ()
    logarithmic: bool = False

    def places(self, v: np.ndarray, bins: int) -> np.ndarray:
        """The bin of every value: one of its own for each end, and ``bins`` between them."""
        def scaled(x):
            # grows with x and stays finite
            return np.sign(x) * np.log1p(np.abs(x)) if self.logarithmic else x * 0.5
        low, high = scaled(np.float64(self.low)), scaled(np.float64(self.high))
        share = (scaled(v) - low) / (high - low) if high > low else np.full(len(v), 0.5)
        between = 1 + np.minimum(np.floor(share * bins), bins - 1).astype(np.int64)
        return np.where(v == self.low, 0, np.where(v == self.high, bins + 1, between))


def _spans(df: DataFrame, columns: list[str], ranges: list[Range], group: str | None, limit: float | None) -> dict[int, tuple[int, float, float]]:
    """Count, least and largest of all values of each range that has any: plain aggregates, as no bins are needed yet."""
    def value(r: Range) -> Column:
        x = F.col(columns[r.column]).cast("double")
        if limit is None:
            # a NaN that is there is the largest of all, as a sort has it
            x = F.when(x.isNotNull(), F.when(F.isnan(x), LARGEST).otherwise(F.greatest(F.least(x, F.lit(LARGEST)), F.lit(-LARGEST))))
        else:
            x = F.when(~F.isnan(x), F.when(F.abs(x) == math.inf, F.signum(x) * limit).otherwise(x))
        return x if r.without is None else F.when(~F.col(group).cast("long").eqNullSafe(F.lit(r.without)), x)

    found = first_row(df, [m(value(r)) for r in ranges for m in (F.count, F.min, F.max)])
    return {i: tuple(found[3 * i:3 * i + 3]) for i in range(len(ranges)) if found[3 * i]}


def _counted(df: DataFrame, columns: list[str], ranges: list[Range], bins: int, group: str | None,
             limit: float | None) -> dict[int, list[tuple[int, int, float, float]]]:
    """For each range its bins in order: place, count, least and largest value."""
    read = sorted({r.column for r in ranges})

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = bins + 2
        counts, least, most = np.zeros((len(ranges), size), np.int64), np.full((len(ranges), size), np.inf), np.full((len(ranges), size), -np.inf)
        for batch in batches:
            flat = batch.column("cells").flatten()
            cells = np.ascontiguousarray(flat.to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(read)).T)
            valid = flat.is_valid().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(read)) if limit is None else None
            groups = batch.column("g").to_numpy(zero_copy_only=False) if group else None
            values: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            for i, r in enumerate(ranges):
                if r.column not in values:
                    v = cells[read.index(r.column)]
                    if limit is None:
                        # a NaN that is there is the largest of all, as a sort has it
                        values[r.column] = np.clip(np.where(np.isnan(v), np.inf, v), -LARGEST, LARGEST), valid[:, read.index(r.column)]
                    else:
                        values[r.column] = np.where(np.isinf(v), np.sign(v) * limit, v), ~np.isnan(v)
                v, there = values[r.column]
                own = there & (v >= r.low) & (v <= r.high)
                if r.without is not None:
                    own = own & (groups != r.without)
                v = v[own]
                place = r.places(v, bins)
                counts[i] += np.bincount(place, minlength=size)
                np.minimum.at(least[i], place, v)
                np.maximum.at(most[i], place, v)
        i, place = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(place, pa.int32()), pa.array(counts[i, place]), pa.array(least[i, place]),
                                          pa.array(most[i, place])], names=["i", "place", "n", "least", "most"])

    # one array reaches Python in a third of the time that as many columns take
    cells = df.select(F.array(*[F.col(columns[n]).cast("double") for n in read]).alias("cells"), *([F.col(group).cast("long").alias("g")] if group else []))
    found: dict[int, list] = {}
    counted = cells.mapInArrow(summed, "i int, place int, n long, least double, most double")
    for r in counted.groupBy("i", "place").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most")).collect():
        found.setdefault(r.i, []).append((r.place, r.n, r.least, r.most))
    return {i: sorted(b) for i, b in found.items()}


def selected(df: DataFrame, columns: list[str], shares: list[float], bins: int = BINS, group: str | None = None,
             without: list[int | None] = (None,), limit: float | None = None) -> dict[tuple[int, int | None], list[float]]:
    """Quantiles with linear interpolation of every column that has values, for each group that is left out. With ``limit`` NaN
    is missing and infinities are that large; else NaN and infinity are the largest numbers."""
    whole = [Range(c, g) for g in without for c in range(len(columns))]
    wanted: dict[tuple[int, int | None], list[float]] = {}
    open_ranges, values = [], {}
    for i, (n, low, high) in _spans(df, columns, whole, group, limit).items():
        r = whole[i]
        wanted[r.column, r.without] = [p * (n - 1) for p in shares]
        ranks = sorted({f(p) for p in wanted[r.column, r.without] for f in (math.floor, math.ceil)})
        open_ranges.append(Range(r.column, r.without, low, high, 0, tuple(ranks), high - low > WIDE))
    while True:
        for r in open_ranges:
            if r.low == r.high:
                values.update(((r.column, r.without, rank), r.low) for rank in r.ranks)
        open_ranges = [r for r in open_ranges if r.low < r.high]
        if not open_ranges:
            break
        narrower = []
        for i, counted in _counted(df, columns, open_ranges, bins, group, limit).items():
            r, before = open_ranges[i], open_ranges[i].before
            for _, n, least, most in counted:
                if inside := tuple(rank for rank in r.ranks if before <= rank < before + n):
                    narrower.append(Range(r.column, r.without, least, most, before, inside))
                before += n
        open_ranges = narrower

    def at(key: tuple[int, int | None], place: float) -> float:
        low, high = (values[*key, f(place)] for f in (math.floor, math.ceil))
        found = low if low == high else low + (high - low) * (place - math.floor(place))
        return math.copysign(math.inf, found) if abs(found) == LARGEST else found

    return {key: [at(key, p) for p in places] for key, places in wanted.items()}


def exact_quantiles(df: DataFrame, columns: list[str], shares: list[float], bins: int = BINS,
                    limit: float | None = None) -> dict[str, list[float | None]]:
    """Quantiles with linear interpolation, NULL skipped; None for a column without values. See ``selected`` for ``limit``."""
    if not columns:
        return {}
    found = selected(df, columns, shares, bins, limit=limit)
    return {c: found.get((i, None), [None] * len(shares)) for i, c in enumerate(columns)}


def exact_medians(df: DataFrame, columns: list[str], limit: float | None = None) -> dict[str, float | None]:
    return {c: v[0] for c, v in exact_quantiles(df, columns, [0.5], limit=limit).items()}


def medians_without(df: DataFrame, columns: list[str], group: str, groups: list[int], limit: float | None = None) -> dict[int, dict[str, float | None]]:
    """For each group (a whole number) the medians of the rows of all others, all in the same passes."""
    found = selected(df, columns, [0.5], group=group, without=groups, limit=limit) if columns else {}
    return {g: {c: found.get((i, g), [None])[0] for i, c in enumerate(columns)} for g in groups}
