"""Regression trees and boosting on packed bins.

Every input is cut into at most 32 bins, as Spark's trees do it. The bins of a few inputs make one code of two bytes, so a row takes
about a tenth of its vector of doubles, and one count of codes serves several inputs. Rows are held as blocks of codes, dealt evenly.
A level of a tree is one pass: tasks route their rows through the tree so far and add up counts and sums of the label by node and
code, from which the bins of every input follow. Of two siblings the smaller one is counted, the other one is what remains of their
parent. Boosting hands the held blocks on from round to round with the forecasts so far; every ``REBUILD`` rounds they are made from
the first blocks and all trees, so that lost blocks never set off a longer past. Blocks are an RDD, as the plans of tables that are
made from one another hundreds of times take longer than the passes.

As in Spark's trees, cuts come from ``SAMPLE`` rows, the first tree of boosting counts in full and all later ones, fitted to twice the
residuals, by the learning rate.
"""

from __future__ import annotations

import json
import math
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext, cloudpickle, keyword_only
from pyspark.ml import Transformer
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

# functions that run in Python workers travel with their code, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS, SAMPLE = 32, 10_000
# values of a code, rows of a block
CODES, BLOCK_ROWS = 1024, 32_768
# levels that a tree may have here: a table of codes for every inner node goes to every task
DEEPEST = 12
# nodes of one pass, and nodes of one record that a task returns
SLOTS, RECORD_SLOTS = 512, 16
REBUILD = 25
PARTS_PER_CORE = 1
# a split must gain more than this share of what rounding may
ROUNDING = 1e-12
# number of a block, codes by group, labels, forecasts so far
Block = tuple[int, bytes, bytes, bytes]


def cuts_of(values: np.ndarray, most: int = BINS - 1) -> np.ndarray:
    """Midpoints between all values that occur, or as many of them as there may be, at about equal shares of the rows."""
    found, n = np.unique(values, return_counts=True)
    between = found[:-1] + (found[1:] - found[:-1]) / 2
    if len(between) <= most:
        return between
    below, step = n.cumsum(), len(values) / (most + 1)
    chosen, goal = [], step
    for i in range(len(between)):
        if abs(below[i] - goal) < abs(below[i + 1] - goal):
            chosen.append(between[i])
            goal += step
    return np.array(chosen[:most])


@dataclass
class Packing:
    """Where each input lies in the codes. An input with a single bin is in none: nothing can be split by it."""
    cuts: list[np.ndarray]
    size: np.ndarray
    group: np.ndarray
    stride: np.ndarray
    # codes of each group
    codes: list[int]

    @classmethod
    def of(cls, cuts: list[np.ndarray]) -> Packing:
        size = np.array([len(c) + 1 for c in cuts], int)
        group, stride, filled = np.full(len(cuts), -1), np.ones(len(cuts), int), []
        for f in np.argsort(-size, kind="stable"):
            if size[f] > 1:
                g = next((i for i, n in enumerate(filled) if n * size[f] <= CODES), len(filled))
                filled += [1] * (g == len(filled))
                group[f], stride[f] = g, filled[g]
                filled[g] *= int(size[f])
        return cls(cuts, size, group, stride, filled)

    @property
    def groups(self) -> int:
        return len(self.codes)

    @property
    def inputs(self) -> np.ndarray:
        return np.flatnonzero(self.group >= 0)

    @property
    def offset(self) -> np.ndarray:
        """First cell of every input in a table of all bins."""
        used = np.where(self.group >= 0, self.size, 0)
        return used.cumsum() - used

    @property
    def cells(self) -> int:
        return int(self.size[self.group >= 0].sum())

    def packed(self, x: np.ndarray) -> np.ndarray:
        found = np.zeros((self.groups, len(x)), np.uint16)
        for f in self.inputs:
            found[self.group[f]] += (np.searchsorted(self.cuts[f], x[:, f]) * self.stride[f]).astype(np.uint16)
        return found

    def bins(self, f: int) -> np.ndarray:
        """The bin of an input for every code of its group."""
        return np.arange(CODES) // self.stride[f] % self.size[f]


@dataclass
class Tree:
    """Nodes by number, the root first. ``feature`` is -1 in a leaf; rows up to ``bin`` go to ``left``."""
    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    levels: int = 0

    def split(self, node: int, feature: int, at: int, gain: float, values: tuple[float, float]) -> tuple[int, int]:
        children = len(self.feature), len(self.feature) + 1
        self.feature[node], self.bin[node], self.gain[node] = feature, at, gain
        self.left[node], self.right[node] = children
        for child, value in zip(children, values):
            for part, v in ((self.feature, -1), (self.bin, 0), (self.left, child), (self.right, child), (self.value, value), (self.gain, 0.0)):
                part.append(v)
        return children


class Router:
    """Finds the nodes of rows by tables from codes to sides."""

    def __init__(self, tree: Tree, packing: Packing):
        feature = np.array(tree.feature)
        inner = np.flatnonzero(feature >= 0)
        self.levels, self.row = tree.levels if len(inner) else 0, np.zeros(len(feature), np.intp)
        self.row[inner] = np.arange(len(inner))
        self.right = np.array([packing.bins(feature[i]) > tree.bin[i] for i in inner]).reshape(-1)
        self.group = np.where(feature >= 0, packing.group[feature], 0).astype(np.intp)
        # a leaf leads to itself on both sides
        self.child = np.column_stack([tree.left, tree.right]).astype(np.intp).reshape(-1)
        self.value = np.array(tree.value)

    def nodes(self, codes: np.ndarray) -> np.ndarray:
        n = codes.shape[1]
        node, flat, place = np.zeros(n, np.intp), codes.reshape(-1), np.arange(n)
        for level in range(self.levels):
            if level == 0:
                side = self.right[:CODES][codes[self.group[0]]]
                node = self.child[side.astype(np.intp)]
            else:
                side = self.right[self.row[node] * CODES + flat[self.group[node] * n + place]]
                node = self.child[node * 2 + side]
        return node


def unpacked(records: Iterator[Block], groups: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    for number, codes, y, fit in records:
        yield number, np.frombuffer(codes, np.uint16).reshape(groups, -1), np.frombuffer(y), np.frombuffer(fit)


def blocks_of(rows: DataFrame, inputs: list[str], label: str, packing: Packing) -> RDD[Block]:
    """Held blocks of codes and labels in even parts, without forecasts (0)."""
    d = len(inputs)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, labels, number = [], [], TaskContext.get().partitionId() << 32

        def block():
            parts = np.ascontiguousarray(np.concatenate(codes, 1)).tobytes(), np.concatenate(labels).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *(pa.array([x], pa.binary()) for x in parts)], names=["block", "codes", "y"])
        for batch in batches:
            x = batch.column("cells").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, d + 1)
            codes.append(packing.packed(x[:, :d]))
            labels.append(x[:, d].copy())
            if sum(map(len, labels)) >= BLOCK_ROWS:
                yield block()
                codes, labels, number = [], [], number + 1
        if labels:
            yield block()

    cells = rows.select(F.array(*[F.col(c).cast("double") for c in [*inputs, label]]).alias("cells"))
    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = cores * max(PARTS_PER_CORE, -(-rows.rdd.getNumPartitions() // (8 * cores)))
    dealt = cells.mapInArrow(packed, "block long, codes binary, y binary").repartition(parts)
    held = dealt.rdd.map(lambda r: (r.block, bytes(r.codes), bytes(r.y), bytes(len(r.y)))).persist(StorageLevel.MEMORY_AND_DISK)
    held.count()
    return held


def after(blocks: RDD[Block], packing: Packing, trees: list[Tree], rates: list[float]) -> RDD[Block]:
    """Held blocks with the forecasts of more trees."""
    def added(records: Iterator[Block]) -> Iterator[Block]:
        routers = [Router(tree, packing) for tree in trees]
        for number, codes, y, fit in records:
            cells, found = np.frombuffer(codes, np.uint16).reshape(packing.groups, -1), np.frombuffer(fit).copy()
            for router, rate in zip(routers, rates):
                found += rate * router.value[router.nodes(cells)]
            yield number, codes, y, found.tobytes()
    return blocks.mapPartitions(added).persist(StorageLevel.MEMORY_AND_DISK)


def counted(blocks: RDD[Block], packing: Packing, tree: Tree, nodes: list[int], goal: Callable[[np.ndarray, np.ndarray], np.ndarray],
            share: float, seed: tuple[int, ...]) -> np.ndarray:
    """Rows and sums of ``goal`` by node, input and bin, of all rows or of a ``share`` of them."""
    of, record = len(nodes), RECORD_SLOTS

    def summed(records: Iterator[Block]) -> Iterator[tuple[int, np.ndarray]]:
        found = np.zeros((of, packing.cells, 2))
        router, offset = Router(tree, packing), packing.offset
        slots = np.full(len(tree.feature), -1, np.intp)
        slots[nodes] = np.arange(of)
        inside = [np.flatnonzero(packing.group == g) for g in range(packing.groups)]
        for number, codes, y, fit in unpacked(records, packing.groups):
            slot, wanted = slots[router.nodes(codes)], goal(y, fit)
            use = slot >= 0
            if share < 1:
                use &= np.random.default_rng([*seed, number]).random(len(y)) < share
            if not use.all():
                place = np.flatnonzero(use)
                slot, wanted, codes = slot[place], wanted[place], codes.take(place, 1)
            slot = slot * CODES
            for g, inputs in enumerate(inside):
                key = slot + codes[g]
                for part, table in enumerate((np.bincount(key, minlength=of * CODES), np.bincount(key, wanted, of * CODES))):
                    table = table.reshape(of, CODES)[:, :packing.codes[g]]
                    for f in inputs:
                        found[:, offset[f]:offset[f] + packing.size[f], part] += table.reshape(of, -1, packing.size[f], packing.stride[f]).sum((1, 3))
        for first in range(0, of, record):
            yield first, found[first:first + record]

    parts = blocks.mapPartitions(summed)
    if of > record:
        # tables of many nodes are added up in tasks, those of a few by the driver
        parts = parts.reduceByKey(np.add, -(-of // record))
    found = np.zeros((of, packing.cells, 2))
    for first, own in parts.collect():
        found[first:first + len(own)] += own
    return found


def best_splits(tables: np.ndarray, packing: Packing, least: int, allowed: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """For every node the input and bin of its best split with the gain (rows times the fall of the variance; 0 if none), and
    rows and sum of the left side. ``allowed`` names the inputs that each node may use."""
    m, offset = len(tables), packing.offset
    gain, feature, at, left = np.zeros(m), np.full(m, -1), np.zeros(m, int), np.zeros((m, 2))
    f0 = packing.inputs[0]
    n, total = tables[:, offset[f0]:offset[f0] + packing.size[f0]].sum(1).T
    whole = total * total / np.maximum(n, 1)
    for f in packing.inputs:
        run = tables[:, offset[f]:offset[f] + packing.size[f]].cumsum(1)[:, :-1]
        a, s = run[:, :, 0], run[:, :, 1]
        b, r = n[:, None] - a, total[:, None] - s
        parts = s * s / np.maximum(a, 1) + r * r / np.maximum(b, 1)
        usable = (a >= least) & (b >= least)
        rise = np.where(usable if allowed is None else usable & allowed[:, [f]], parts - whole[:, None], -np.inf)
        i = rise.argmax(1)
        spot = np.arange(m), i
        better = (rise[spot] > gain) & (rise[spot] > ROUNDING * parts[spot])
        gain, feature, at = np.where(better, rise[spot], gain), np.where(better, f, feature), np.where(better, i, at)
        left = np.where(better[:, None], run[spot], left)
    return gain, feature, at, left


def grow(blocks: RDD[Block], packing: Packing, depth: int, least: int, goal: Callable[[np.ndarray, np.ndarray], np.ndarray], share: float = 1.0,
         columns: float = 1.0, seed: tuple[int, ...] = (0,)) -> Tree:
    """One tree, level by level. With ``columns`` below 1 every node looks at that share of the inputs, drawn anew."""
    tree, random, width = Tree(), np.random.default_rng(seed), len(packing.size)
    if not packing.groups:
        return tree

    def drawn(nodes: int) -> np.ndarray | None:
        if columns >= 1:
            return None
        return random.random((nodes, width)).argsort(1).argsort(1) < max(1, math.ceil(columns * width))

    def tables_of(nodes: list[int]) -> np.ndarray:
        return np.concatenate([counted(blocks, packing, tree, nodes[i:i + SLOTS], goal, share, seed) for i in range(0, len(nodes), SLOTS)])

    open_nodes, tables = [0], tables_of([0])
    f0 = packing.inputs[0]
    own = slice(packing.offset[f0], packing.offset[f0] + packing.size[f0])
    n, total = tables[0, own].sum(0)
    tree.value[0] = float(total / n) if n else 0.0
    while open_nodes and depth > 0:
        gain, feature, at, left = best_splits(tables, packing, least, drawn(len(open_nodes)))
        whole = tables[:, own].sum(1)
        pairs = []
        for i in np.flatnonzero(feature >= 0):
            right = whole[i] - left[i]
            children = tree.split(open_nodes[i], int(feature[i]), int(at[i]), float(gain[i]), (float(left[i, 1] / left[i, 0]), float(right[1] / right[0])))
            few = int(left[i, 0] > right[0])
            if max(left[i, 0], right[0]) >= 2 * least:
                pairs.append((i, children[few], children[1 - few], min(left[i, 0], right[0]) >= 2 * least))
        if (feature >= 0).any():
            tree.levels += 1
        if not pairs or tree.levels >= depth:
            break
        small = tables_of([p[1] for p in pairs])
        large = tables[[p[0] for p in pairs]] - small
        both = [j for j, p in enumerate(pairs) if p[3]]
        open_nodes, tables = [p[2] for p in pairs] + [pairs[j][1] for j in both], np.concatenate([large, small[both]])
    return tree


class PackedTrees(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``outputCol``: a base value and the sum of trees by their rates."""
    inputCols = Param(Params._dummy(), "inputCols", "columns of the inputs", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "column of the forecast", TypeConverters.toString)
    ensemble = Param(Params._dummy(), "ensemble", "cuts, trees, rates and base as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None, ensemble=None):
        super().__init__()
        self._set(**{p: v for p, v in self._input_kwargs.items() if v is not None})

    @classmethod
    def of(cls, inputs: list[str], output: str, cuts: list[np.ndarray], trees: list[Tree], rates: list[float], base: float) -> PackedTrees:
        about = {"cuts": [c.tolist() for c in cuts], "trees": [vars(t) for t in trees], "rates": rates, "base": base}
        return cls(inputCols=inputs, outputCol=output, ensemble=json.dumps(about))

    def _about(self) -> dict:
        about = json.loads(self.getOrDefault(self.ensemble))
        return about | {"cuts": [np.array(c) for c in about["cuts"]], "trees": [Tree(**t) for t in about["trees"]]}

    @property
    def featureImportances(self) -> DenseVector:
        """Gains of all splits by input, as shares."""
        found = np.zeros(len(self.getOrDefault(self.inputCols)))
        for tree in self._about()["trees"]:
            for feature, gain in zip(tree.feature, tree.gain):
                if feature >= 0:
                    found[feature] += gain
        return Vectors.dense(found / found.sum() if found.sum() else found)

    @property
    def getNumTrees(self) -> int:
        if (trees := len(self._about()["trees"])) < 2:
            raise AttributeError("a single tree is no ensemble")
        return trees

    def _transform(self, dataset: DataFrame) -> DataFrame:
        about, inputs = self._about(), self.getOrDefault(self.inputCols)
        packing, width = Packing.of(about["cuts"]), len(inputs)
        trees, rates, base = about["trees"], about["rates"], about["base"]

        @F.arrow_udf("double")
        def forecast(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            routers = [Router(tree, packing) for tree in trees]
            for cells in batches:
                codes = packing.packed(cells.flatten().to_numpy(zero_copy_only=False).reshape(len(cells), width))
                fit = np.full(len(cells), base)
                for router, rate in zip(routers, rates):
                    fit += rate * router.value[router.nodes(codes)]
                yield pa.array(fit)
        return dataset.withColumn(self.getOrDefault(self.outputCol), forecast(F.array(*[F.col(c) for c in inputs])))


def fit_trees(rows: DataFrame, inputs: list[str], label: str, output: str, depth: int, least: int, rounds: int = 1, rate: float = 1.0,
              share: float = 1.0, columns: float = 1.0, seed: int = 0) -> PackedTrees:
    """One tree, or with more ``rounds`` a boosted ensemble, from columns without missing or infinite values."""
    n, base = rows.agg(F.count(F.lit(1)), F.avg(label)).first()
    part = rows.sample(min(1.0, SAMPLE / n), seed) if n > SAMPLE else rows
    cells = np.array([r[0] for r in part.select(F.array(*[F.col(c).cast("double") for c in inputs])).collect()]).reshape(-1, len(inputs))
    cuts = [cuts_of(column) for column in cells.T]
    packing, trees, rates = Packing.of(cuts), [], []
    first = blocks = blocks_of(rows, inputs, label, packing)
    for number in range(rounds):
        if number:
            again = number % REBUILD == 0
            blocks, old = after(first if again else blocks, packing, trees if again else trees[-1:], rates if again else rates[-1:]), blocks
        goal = (lambda y, fit: 2 * (y - base - fit)) if number else (lambda y, fit: y - base)
        trees.append(grow(blocks, packing, depth, least, goal, share, columns, (seed, number)))
        rates.append(rate if number else 1.0)
        if number and old is not first:
            old.unpersist()
    blocks.unpersist()
    first.unpersist()
    return PackedTrees.of(inputs, output, cuts, trees, rates, base)
