"""Linear models from one additive matrix of sums of products.

One pass over the rows sums the products of all inputs, the label and 1, per task with numpy and then per cell of the matrix
by Spark. The sums of parts of the table add up and can be taken off again, so the training part of every fold is the whole
minus the fold. Scaling, imputation and each penalty work on the matrix alone, whose size follows the number of inputs.

Cells are stored around a fixed shift (the medians), which keeps the sums accurate. Where the values to impute are not
settled yet, missing cells count as the shift, and sums with their indicators allow any other value afterwards.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from ..constants import FINITE_LIMIT

# functions that run in Python workers travel with their code, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# eigenvalues of the scaled matrix below this share of the largest stand for inputs that depend on others
DEPENDENT = 1e-15
# correlation from which on two inputs say the same
SAME = 1 - 1e-9
# spread below this share of the mean is rounding
CONSTANT = 1e-13
GROUP, CELLS = "_group", "_cells"


def cells_of(columns: list[str]) -> Column:
    """The numbers of a row as one array, which reaches Python in a third of the time that as many columns take."""
    return F.array(*[F.col(c).cast("double") for c in columns]).cast("array<double>").alias(CELLS)


def matrix_of(batch: pa.RecordBatch, width: int, limit: float = FINITE_LIMIT) -> np.ndarray:
    """The cells of all rows as one matrix: NaN where a cell is missing, infinities at the largest accepted magnitude."""
    found = np.array(batch.column(CELLS).flatten().to_numpy(zero_copy_only=False), float).reshape(batch.num_rows, width)
    return np.clip(found, -limit, limit, where=np.isinf(found), out=found)


def labelled(rows: DataFrame, columns: list[str], label: str, group: Column) -> DataFrame:
    """Cells, the label as the last of them, and the group of the rows that have both."""
    given = rows.select(cells_of([*columns, label]), F.col(label).cast("double").alias("_label"), group.cast("int").alias(GROUP))
    return given.dropna(subset=["_label", GROUP]).select(CELLS, GROUP)


@dataclass
class Gram:
    """Sums of products of ``[inputs - shift, indicators of missing inputs, label - label_shift, 1]``."""
    columns: list[str]
    shift: np.ndarray
    label_shift: float
    products: np.ndarray

    def __add__(self, other: Gram) -> Gram:
        return Gram(self.columns, self.shift, self.label_shift, self.products + other.products)

    def __sub__(self, other: Gram) -> Gram:
        return Gram(self.columns, self.shift, self.label_shift, self.products - other.products)

    @property
    def rows(self) -> int:
        return int(round(self.products[-1, -1]))

    def imputed(self, fills: np.ndarray) -> Moments:
        """Means and covariances after missing cells became ``fills``."""
        d = len(self.columns)
        change = np.zeros((d + 2, 2 * d + 2))
        change[np.arange(d), np.arange(d)] = 1.0
        change[np.arange(d), d + np.arange(d)] = fills - self.shift
        change[d, 2 * d] = change[d + 1, 2 * d + 1] = 1.0
        sums = change @ self.products @ change.T
        n = sums[-1, -1]
        mean = sums[-1, :-1] / n if n else np.zeros(d + 1)
        spread = sums[:-1, :-1] / n - np.outer(mean, mean) if n else np.zeros((d + 1, d + 1))
        return Moments(n, mean[:d] + self.shift, mean[d] + self.label_shift, spread[:d, :d], spread[:d, d], spread[d, d])


@dataclass
class Moments:
    n: float
    mean: np.ndarray
    label_mean: float
    covariance: np.ndarray
    with_label: np.ndarray
    label_variance: float

    def deviations(self) -> np.ndarray:
        """Population deviation of every input; 1 for a constant one."""
        variance = self.covariance.diagonal()
        constant = variance <= CONSTANT * CONSTANT + CONSTANT * self.mean**2
        return np.where(constant, 1.0, np.sqrt(np.maximum(variance, 0.0)))


def gram(rows: DataFrame, columns: list[str], label: str, shift: dict[str, float], label_shift: float = 0.0,
         group: str | None = None) -> dict[int, Gram]:
    """Sums of products of all rows, by ``group`` if it is given (a small whole number), else as group 0.

    Rows without a label are left out.
    """
    d, at = len(columns), np.array([shift[c] for c in columns])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            given = matrix_of(batch, d + 1)
            x, y = given[:, :d] - at, given[:, d] - label_shift
            groups = batch.column(GROUP).to_numpy(zero_copy_only=False)
            missing = np.isnan(x)
            x[missing] = 0.0
            for g in np.unique(groups):
                own = groups == g
                odd = np.flatnonzero(missing[own].any(0))
                z = np.column_stack([x[own], missing[own][:, odd], y[own], np.ones(own.sum())])
                place = np.concatenate([np.arange(d), d + odd, [2 * d, 2 * d + 1]]).astype(int)
                total = sums.setdefault(int(g), np.zeros((2 * d + 2, 2 * d + 2)))
                total[np.ix_(place, place)] += z.T @ z
        for g, total in sums.items():
            i, j = np.nonzero(np.triu(total))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), g), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                              pa.array(total[i, j])], names=["g", "i", "j", "v"])

    narrow = labelled(rows, columns, label, F.col(group) if group else F.lit(0))
    # at most (2 * inputs + 2)^2 / 2 cells a group
    cells = narrow.mapInArrow(summed, "g int, i int, j int, v double").groupBy("g", "i", "j").agg(F.sum("v").alias("v")).toArrow()
    g, i, j, v = (cells[c].to_numpy() for c in ("g", "i", "j", "v"))
    found = {}
    for one in np.unique(g):
        own, total = g == one, np.zeros((2 * d + 2, 2 * d + 2))
        total[i[own], j[own]] = v[own]
        found[int(one)] = Gram(list(columns), at, label_shift, np.triu(total) + np.triu(total, 1).T)
    return found


def mean_products(rows: DataFrame, columns: list[str], sides: list[Column], centre: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Means of the products of every input, less ``centre`` and divided by ``spread``, with every side, in one pass."""
    d, m = len(columns), len(sides)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((d, m)), 0
        for batch in batches:
            given = np.array(batch.column(CELLS).flatten().to_numpy(zero_copy_only=False), float).reshape(batch.num_rows, d + m)
            total += ((given[:, :d] - centre) / spread).T @ given[:, d:]
            n += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d * m + 1), pa.int32()), pa.array(np.append(total.ravel(), n))], names=["i", "v"])

    cells = rows.select(F.array(*[F.col(c).cast("double") for c in columns], *[x.cast("double") for x in sides]).alias(CELLS))
    sums = {r.i: r.v for r in cells.mapInArrow(summed, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()}
    return np.array([sums[i] for i in range(d * m)]).reshape(d, m) / sums[d * m]


@dataclass
class Line:
    """``intercept + sum of weights * (input - centre) / spread`` with missing inputs at ``fills``."""
    weights: np.ndarray
    intercept: float
    fills: np.ndarray
    centre: np.ndarray
    spread: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.intercept + (np.where(np.isnan(x), self.fills, x) - self.centre) / self.spread @ self.weights


def least_squares(s: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The shortest of all least-squares solutions."""
    values, vectors = np.linalg.eigh(s)
    usable = values > DEPENDENT * max(values.max(initial=0.0), 0.0) * len(s)
    return vectors[:, usable] @ ((vectors[:, usable].T @ b) / values[usable])


def penalized(s: np.ndarray, b: np.ndarray, l1: float, l2: float, rounds: int, accuracy: float = 1e-11) -> np.ndarray:
    """Minimum of ``w'sw / 2 - b'w + l1 * |w| + l2 * w'w / 2``: coordinate descent, and as soon as the inputs in use and
    their signs are right, the equations of these inputs alone, which give the exact answer.

    Without ``l2`` inputs that say the same could share their weight in any way: the first one carries it.
    """
    w, gradient, scale = np.zeros(len(b)), -b.copy(), max(np.abs(b).max(initial=0.0), 1e-300)
    size = np.sqrt(np.maximum(s.diagonal(), 0.0))
    same = np.abs(np.tril(s, -1)) > SAME * np.outer(size, size)
    active = np.flatnonzero((size > 0) & ~(same.any(1) & (l2 == 0)))

    def settled(w: np.ndarray) -> bool:
        g = s @ w - b + l2 * w
        used = w != 0
        return bool((np.abs(g[used] + l1 * np.sign(w[used])) <= accuracy * scale).all()
                    and (np.abs(g[~used]) <= l1 + 1e-9 * scale).all())

    for number in range(max(1, rounds)):
        moved = 0.0
        for j in active:
            pull = s[j, j] * w[j] - gradient[j]
            new = np.sign(pull) * max(abs(pull) - l1, 0.0) / (s[j, j] + l2)
            if new != w[j]:
                gradient += s[:, j] * (new - w[j])
                moved = max(moved, abs(new - w[j]))
                w[j] = new
        if number % 10 == 9 or moved <= accuracy:
            w = within_signs(s, b, l1, l2, w)
            gradient = s @ w - b
            if moved <= accuracy or settled(w):
                break
    return w


def within_signs(s: np.ndarray, b: np.ndarray, l1: float, l2: float, w: np.ndarray) -> np.ndarray:
    """The best weights of the inputs in use with the signs they have; one that would change its sign on the way leaves."""
    w = w.copy()
    while len(used := np.flatnonzero(w)):
        goal = least_squares(s[np.ix_(used, used)] + l2 * np.eye(len(used)), b[used] - l1 * np.sign(w[used]))
        turned = np.sign(goal) != np.sign(w[used])
        if not turned.any():
            w[used] = goal
            break
        share = np.where(turned, w[used] / np.where(turned, w[used] - goal, 1.0), np.inf)
        w[used] += share.min() * (goal - w[used])
        w[used[share == share.min()]] = 0.0
    return w


def solve(name: str, settings: dict, moments: Moments, fills: np.ndarray, centre: np.ndarray | None = None,
          spread: np.ndarray | None = None) -> Line:
    """Weights of scaled inputs; without ``centre`` and ``spread`` they are scaled to mean 0 and deviation 1."""
    centre = moments.mean if centre is None else centre
    spread = moments.deviations() if spread is None else spread
    mean = (moments.mean - centre) / spread
    s, b = moments.covariance / np.outer(spread, spread), moments.with_label / spread
    cut = settings.get("fit_intercept", True)
    if not cut:
        s, b = s + np.outer(mean, mean), b + mean * moments.label_mean
    rounds = int(settings.get("max_iter", 1000))
    if name == "linear":
        w = least_squares(s, b)
    elif name == "ridge":
        alpha = float(settings["alpha"])
        w = least_squares(s + alpha / moments.n * np.eye(len(b)), b) if moments.n else np.zeros(len(b))
    else:
        mix = 1.0 if name == "lasso" else float(settings["l1_ratio"])
        alpha = float(settings["alpha"])
        w = penalized(s, b, alpha * mix, alpha * (1 - mix), rounds)
    return Line(w, float(moments.label_mean - w @ mean) if cut else 0.0, fills, centre, spread)


def absolute_errors(rows: DataFrame, columns: list[str], label: str, lines: dict[int, list[Line]], group: str) -> dict[int, list[float]]:
    """Mean absolute error of every line of a group over the rows of that group, in one pass."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            given, groups = matrix_of(batch, len(columns) + 1), batch.column(GROUP).to_numpy(zero_copy_only=False)
            x, y = given[:, :-1], given[:, -1]
            for g in np.unique(groups):
                own = groups == g
                found = [np.abs(y[own] - line.predict(x[own])).sum() for line in lines[int(g)]]
                sums[int(g)] = sums.get(int(g), 0.0) + np.array([*found, own.sum()], float)
        for g, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(total), g), pa.int32()), pa.array(np.arange(len(total)), pa.int32()),
                                              pa.array(total)], names=["g", "i", "v"])

    narrow = labelled(rows, columns, label, F.col(group))
    found: dict[int, dict[int, float]] = {}
    for r in narrow.mapInArrow(summed, "g int, i int, v double").groupBy("g", "i").agg(F.sum("v").alias("v")).collect():
        found.setdefault(r.g, {})[r.i] = r.v
    return {g: [v[i] / v[len(lines[g])] for i in range(len(lines[g]))] for g, v in found.items()}
