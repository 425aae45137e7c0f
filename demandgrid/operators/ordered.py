"""Rolling measures whose cost per row does not follow the window.

Spark evaluates a sliding frame anew for every row. Here rows of a partition, sorted by series and time, go by in Arrow batches.
A series is cut into blocks as long as the window, so every frame is the end of one block and the beginning of the next: sums,
squares and maxima run from both ends of each block and are put together for a frame. Nothing is taken off again, so large
amounts that have left a frame leave no rounding behind. For the median an ordered frame is kept from row to row, with one value
entering and one leaving. A batch hands on the last rows of its unfinished series, at most one window.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pandas.api.indexers import BaseIndexer
from pyspark import cloudpickle
from pyspark.sql import DataFrame, types as T

# functions that run in Python workers travel with their code, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KINDS = ("mean", "std", "max", "median")


class Bounds(BaseIndexer):
    """The frame of every row, from given first and last places."""

    def get_window_bounds(self, num_values=0, min_periods=None, center=None, closed=None, step=None):
        return self.starts, self.ends


def series_starts(batch: pa.RecordBatch, groups: list[str], last: tuple | None) -> tuple[np.ndarray, tuple]:
    """Which rows begin a series, and the series of the last row."""
    begins = np.zeros(batch.num_rows, bool)
    for g in groups:
        codes = batch.column(g).dictionary_encode(null_encoding="encode").indices.to_numpy()
        begins[1:] |= codes[1:] != codes[:-1]
    ends = [tuple(batch.column(g)[i].as_py() for g in groups) for i in (0, batch.num_rows - 1)]
    begins[0] = ends[0] != last
    return begins, ends[1]


def from_both_ends(values: np.ndarray, first: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: int, kinds: set[str]) -> dict[str, np.ndarray]:
    """Mean, deviation and maximum of the frames from ``starts`` up to before ``ends``, of at most ``rows`` values of a series that
    begins at ``first``; NaN for frames without values."""
    place = np.arange(len(values))
    offset = place - first
    # one line for each block of a series
    line = np.cumsum((offset % rows == 0)) - 1
    grid = np.full((line[-1] + 1, rows), np.nan)
    grid[line, offset % rows] = values
    last = np.maximum(ends - 1, first)
    single = offset[starts] // rows == offset[last] // rows
    empty = ends <= starts
    ahead, back = (line[last], offset[last] % rows), (line[starts], rows - 1 - offset[starts] % rows)

    def scanned(of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Running count, mean, squares around it and maximum along every line."""
        known = ~np.isnan(of)
        centre = np.take_along_axis(of, known.argmax(1)[:, None], 1)
        less = np.where(known, of - np.where(np.isnan(centre), 0.0, centre), 0.0)
        n, total = known.cumsum(1), less.cumsum(1)
        mean = total / np.maximum(n, 1)
        squares = np.maximum((less * less).cumsum(1) - total * mean, 0.0) if "std" in kinds else total
        return n, mean + np.where(np.isnan(centre), 0.0, centre), squares, np.maximum.accumulate(np.where(known, of, -np.inf), 1)

    n1, mean1, squares1, most1 = (x[ahead] for x in scanned(grid))
    n2, mean2, squares2, most2 = (x[back] for x in scanned(grid[:, ::-1]))
    n1, n2 = np.where(empty, 0, n1), np.where(empty | single, 0, n2)
    n = n1 + n2
    share = n2 / np.maximum(n, 1)
    made = {"mean": np.where(n > 0, mean1 * (1 - share) + mean2 * share, np.nan)}
    made["max"] = np.where(n > 0, np.maximum(np.where(n1 > 0, most1, -np.inf), np.where(n2 > 0, most2, -np.inf)), np.nan)
    if "std" in kinds:
        apart = squares1 * (n1 > 0) + squares2 * (n2 > 0) + (mean1 - mean2) ** 2 * n1 * share
        made["std"] = np.where(n > 1, np.sqrt(apart / np.maximum(n - 1, 1)), np.nan)
    return made


def rolling_frames(frame: DataFrame, groups: list[str], order: list[str], value: str, names: dict[str, tuple[str, int]],
                   closed: str = "right") -> DataFrame:
    """``frame``, partitioned by ``groups``, with columns ``names``: the kind and the rows of each.

    The last rows up to the current one, or with ``closed='left'`` up to the one before. NULL, NaN and infinite values count as
    missing; a frame without values gives NULL, for a deviation also one with a single value.
    """
    if unknown := {kind for kind, _ in names.values()} - set(KINDS):
        raise ValueError(f"unknown measures {sorted(unknown)}")
    reach = max((rows for _, rows in names.values()), default=0)
    late = int(closed == "left")

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried, last = np.zeros(0), None
        for batch in batches:
            if not batch.num_rows:
                continue
            begins, last = series_starts(batch, groups, last)
            if begins[0]:
                carried = np.zeros(0)
            values = np.concatenate([carried, batch.column(value).to_numpy(zero_copy_only=False).astype(float)])
            values[~np.isfinite(values)] = np.nan
            place, before = np.arange(len(values)), len(carried)
            first = np.maximum.accumulate(np.where(np.concatenate([np.zeros(before, bool), begins]), place, 0))
            made = {}
            for rows in {rows for _, rows in names.values()}:
                ends = np.maximum(place + 1 - late, first)
                starts, kinds = np.maximum(first, ends - rows), {kind for kind, size in names.values() if size == rows}
                found = from_both_ends(values, first, np.minimum(starts, place), ends, rows, kinds) if kinds - {"median"} else {}
                if "median" in kinds:
                    found["median"] = pd.Series(values).rolling(Bounds(starts=starts, ends=ends), min_periods=1).median().to_numpy()
                for name, (kind, size) in names.items():
                    if size == rows:
                        made[name] = pa.array(found[kind][before:], pa.float64(), from_pandas=True)
            own = values[first[-1]:]
            carried = own[max(0, len(own) - reach - late):]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(made[n] for n in names)], names=[*batch.schema.names, *names])

    schema = T.StructType([*frame.schema.fields, *(T.StructField(n, T.DoubleType()) for n in names)])
    # one exchange and sort serve the windows before it and this
    return frame.sortWithinPartitions(*groups, *order).mapInArrow(added, schema)
