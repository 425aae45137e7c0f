"""Exact top-k by inner product: a pivot-distance index.

Space. Components become the integers ``floor(256 * x)``. With one more component ``sqrt(M^2 - |v|^2)`` (M the largest norm;
0 for queries) the squared distance of query and vector is ``|q|^2 + M^2 - 2 q.v``, so the largest inner products are the
nearest vectors and the triangle inequality bounds them.

Index. ``PIVOTS`` pivots are fitted on at most ``SAMPLE`` vectors (documented bound; it only decides how well bounds prune).
Every vector is keyed by its nearest pivot and its distance from it. The keys are range-partitioned into shards and cut into
annuli: blocks of at most ``BLOCK`` vectors of one pivot with ascending distances, written as a table. Each query starts
with the k-th best score of the annulus it lies in itself.

Search. Queries, packed in the order of the index, go to those shards that hold an annulus within their reach, by a join on
the pivot. There a pack expands the annuli from the nearest to the farthest and leaves out all whose triangle-inequality
bound falls short of the k-th score so far. Shards hand on k rows a query, which a ranking by query merges.

Exactness. Scores are integers, in float32 or float64 where the squared norms prove the sums exact, else in Python integers,
held within 64 bits at the end. Bounds carry a slack of a billionth of the squared norms. Components beyond 2^62 count as
2^62.

Defined results: vectors that are NULL or hold a NULL or non-finite component, and rows without ``vec_id``, take no part; a
shorter vector counts as filled up with zeros; equal scores go by smaller ``vec_id``; repeated rows are candidates and
queries of their own (a query leaves out its own row only); other columns are not read; without candidates there are no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from demandgrid.llm.common import held, table

NEIGHBOURS = 5
QUERY_STEP = 50
PIVOTS = 32
SAMPLE = 4096
ROUNDS = 6
BLOCK = 512
#: Vectors of a shard, at most about, and at least if the table is small.
SHARD_ROWS = 1 << 18
LEAST_SHARD_ROWS = 1 << 12
#: Queries of a pack, and packs that one task takes together.
PACK = 2048
PACKS = 128
LARGEST = 1 << 62
SLACK = 1e-9
NONE = -(1 << 63) + 1       # less than any score, and its negative is a number of 64 bits
BLOCKS = ("shard long, base long, pivot int, near double, far double, n int, ids binary, vectors binary, "
          "queries binary, floors binary")


def whole(embedding: Column) -> Column:
    """The integer components of a vector."""
    return F.transform(embedding, lambda x: F.floor(F.greatest(F.least(x.cast("double") * 256, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))))


def usable(rows: DataFrame) -> DataFrame:
    """vec_id and the integer vector v of the rows that take part."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    taken = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.coalesce(F.forall("embedding", finite), F.lit(False))
    return rows.filter(taken).select(F.col("vec_id").cast("long").alias("vec_id"), whole(F.col("embedding")).alias("v"))


class Space:
    """How vectors are stored and compared, from their largest size, squared norm and component."""

    def __init__(self, width: int, norm2: float, component: int):
        self.width, self.norm2 = width, norm2
        self.stored = np.dtype(np.int16 if component < 1 << 15 else np.int64)
        # every partial sum of an inner product is at most |q| |v|; both types hold integers to these bounds
        self.exact = np.dtype(np.float32 if norm2 < 1 << 24 else np.float64 if norm2 < 1 << 53 else object)

    def matrix(self, rows: list | pa.Array) -> np.ndarray:
        if isinstance(rows, pa.Array):
            rows = rows.to_pylist()
        out = np.zeros((len(rows), self.width), np.int64)
        for i, row in enumerate(rows):
            out[i, :len(row)] = row
        return out

    def lifted(self, v: np.ndarray) -> np.ndarray:
        """Candidates in the space of distances."""
        v = v.astype(float)
        return np.column_stack([v, np.sqrt(np.maximum(0.0, self.norm2 - (v * v).sum(1)))])

    def products(self, queries: np.ndarray, block: np.ndarray) -> np.ndarray:
        """Inner products as 64-bit integers."""
        found = queries.astype(self.exact) @ block.astype(self.exact).T
        if self.exact == object:
            found = np.array([[max(NONE + 1, min(-NONE, int(x))) for x in row] for row in found], np.int64).reshape(len(queries), len(block))
        return found.astype(np.int64)


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    squares = (points * points).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * points @ pivots.T
    return np.sqrt(np.maximum(squares, 0.0))


def fit_pivots(sample: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Centres of a few rounds of nearest-centre averaging, started from points that are far apart."""
    sample = np.unique(sample, axis=0)
    chosen = [0]
    nearest = distances(sample, sample[:1])[:, 0]
    while len(chosen) < min(pivots, len(sample)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, distances(sample, sample[chosen[-1:]])[:, 0])
    centres = sample[chosen]
    for _ in range(ROUNDS):
        mine = distances(sample, centres).argmin(1)
        centres = np.array([sample[mine == i].mean(0) if (mine == i).any() else c for i, c in enumerate(centres)])
    return centres


def best_rows(rows: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best entries of every row, best first."""
    order = np.lexsort((ids, -scores, rows))
    sorted_rows = rows[order]
    return order[np.arange(len(order)) - np.searchsorted(sorted_rows, sorted_rows) < k]


class Found:
    """The k best entries of each query of a pack so far."""

    def __init__(self, floors: np.ndarray, k: int):
        self.k = k
        self.scores = np.full((len(floors), k), NONE, np.int64)
        self.ids = np.full((len(floors), k), LARGEST, np.int64)
        self.least = floors.copy()          # a candidate below has no chance

    def offer(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Scores of some queries with the candidates ``ids``."""
        kth, last = self.scores[queries, -1][:, None], self.ids[queries, -1][:, None]
        better = (scores >= self.least[queries][:, None]) & ((scores > kth) | (scores == kth) & (ids[None, :] < last)) & (scores > NONE)
        row, column = np.nonzero(better)
        if not len(row):
            return
        hit = np.unique(row)
        rows = np.concatenate([row, np.repeat(hit, self.k)])
        values = np.concatenate([scores[row, column], self.scores[queries[hit]].ravel()])
        names = np.concatenate([ids[column], self.ids[queries[hit]].ravel()])
        best = best_rows(rows, values, names, self.k)
        self.scores[queries[hit]] = values[best].reshape(-1, self.k)
        self.ids[queries[hit]] = names[best].reshape(-1, self.k)
        self.least[queries[hit]] = np.maximum(self.least[queries[hit]], self.scores[queries[hit], -1])


def build_index(rows: DataFrame, k: int, step: int, pivots: int = PIVOTS) -> tuple[DataFrame, Space, np.ndarray] | None:
    """The written annuli, the space and the pivots; None without any vector."""
    vectors = usable(rows)
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    sizes = vectors.select(F.size("v").alias("w"), square.alias("q"), F.array_max(F.transform("v", F.abs)).alias("c")).agg(
        F.count("*"), F.max("w"), F.max("q"), F.max("c")).first()
    if not sizes[0]:
        return None
    space = Space(sizes[1], sizes[2], sizes[3] or 0)
    sample = vectors.orderBy(F.xxhash64("v"), "vec_id").limit(SAMPLE).select("v").collect()
    centres = fit_pivots(space.lifted(space.matrix([r["v"] for r in sample])), pivots)
    parallel = 2 * rows.sparkSession.sparkContext.defaultParallelism
    shards = max(-(-sizes[0] // SHARD_ROWS), min(parallel, -(-sizes[0] // LEAST_SHARD_ROWS)))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                v = space.matrix(batch["v"])
                far = distances(space.lifted(v), centres)
                nearest = far.argmin(1)
                data = v.astype(space.stored)
                yield pa.RecordBatch.from_arrays(
                    [batch["vec_id"], pa.array(nearest, pa.int32()), pa.array(far[np.arange(len(v)), nearest]),
                     pa.array([row.tobytes() for row in data], pa.binary())], names=["vec_id", "pivot", "distance", "data"])

    def annulus(shard: int, base: int, rows: list[tuple]) -> tuple:
        ids, vectors = np.array([r[0] for r in rows], np.int64), np.frombuffer(b"".join(r[3] for r in rows), space.stored).reshape(len(rows), space.width)
        asks = np.flatnonzero(ids % step == 0)
        own = space.products(vectors[asks], vectors)
        own[np.arange(len(asks)), asks] = NONE
        floors = np.sort(own, axis=1)[:, -k] if len(rows) > k else np.full(len(asks), NONE, np.int64)
        return (shard, base, rows[0][1], rows[0][2], rows[-1][2], len(rows), ids.tobytes(), vectors.tobytes(),
                asks.astype(np.int32).tobytes(), floors.astype(np.int64).tobytes())

    def annuli(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, base, rows = TaskContext.get().partitionId(), 0, []
        names, types = [x.split()[0] for x in BLOCKS.split(", ")], [pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.int32(), *[pa.binary()] * 4]
        for batch in batches:
            made = []
            for row in zip(*(batch[n].to_pylist() for n in ("vec_id", "pivot", "distance", "data"))):
                if rows and (len(rows) == BLOCK or row[1] != rows[0][1]):
                    made.append(annulus(shard, base, rows))
                    base, rows = base + len(rows), []
                rows.append(row)
            if made:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), types)], names=names)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(annulus(shard, base, rows), types)], names=names)

    keys = vectors.mapInArrow(keyed, "vec_id long, pivot int, distance double, data binary")
    order = ("pivot", "distance", "vec_id", "data")
    index = keys.repartitionByRange(shards, *order).sortWithinPartitions(*order).mapInArrow(annuli, BLOCKS)
    return held(index, "annuli"), space, centres


def query_packs(index: DataFrame, space: Space, centres: np.ndarray) -> DataFrame:
    """The queries in packs, and for every pivot the distances within which their k best can lie."""

    def packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made, waiting = TaskContext.get().partitionId() << 32, 0, []

        def pack() -> pa.RecordBatch:
            rows, ids, floors, vectors = (np.concatenate(x) for x in zip(*waiting))
            from_pivots, reach = query_reach(space, centres, vectors, floors)
            near, far = np.maximum(0.0, (from_pivots - reach[:, None]).min(0)), (from_pivots + reach[:, None]).max(0)
            return pa.RecordBatch.from_arrays(
                [pa.array([first + made]), *(pa.array([x.tobytes()], pa.binary()) for x in (rows, ids, floors, vectors)),
                 pa.array([[{"pivot": i, "near": a, "far": b} for i, (a, b) in enumerate(zip(near.tolist(), far.tolist()))]],
                          pa.list_(pa.struct([("pivot", pa.int32()), ("near", pa.float64()), ("far", pa.float64())])))],
                names=["pack", "rows", "ids", "floors", "vectors", "reach"])

        for batch in batches:
            for r in batch.to_pylist():
                asks = np.frombuffer(r["queries"], np.int32)
                if len(asks):
                    waiting.append(((r["shard"] << 40) + r["base"] + asks.astype(np.int64), np.frombuffer(r["ids"], np.int64)[asks],
                                    np.frombuffer(r["floors"], np.int64), np.frombuffer(r["vectors"], space.stored).reshape(r["n"], space.width)[asks]))
                if sum(len(w[0]) for w in waiting) >= PACK:
                    yield pack()
                    made, waiting = made + 1, []
        if waiting:
            yield pack()

    schema = "pack long, rows binary, ids binary, floors binary, vectors binary, reach array<struct<pivot:int,near:double,far:double>>"
    return held(index.select("shard", "base", "n", "ids", "vectors", "queries", "floors").mapInArrow(packs, schema), "query-packs")


def query_reach(space: Space, centres: np.ndarray, vectors: np.ndarray, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances of queries from the pivots, and the distance that the k-th best cannot exceed."""
    points = np.column_stack([vectors.astype(float), np.zeros(len(vectors))])
    squares = (points * points).sum(1)
    reach2 = (squares + space.norm2) * (1 + SLACK) + 1 - 2.0 * floors
    # the least score of 64 bits stands for all below, too
    reach = np.where(floors > NONE + 1, np.sqrt(np.maximum(reach2, 0.0)) * (1 + SLACK), np.inf)
    return distances(points, centres), reach


def search(rows: DataFrame, k: int = NEIGHBOURS, step: int = QUERY_STEP, pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of every row whose vec_id is divisible by ``step``."""
    built = build_index(rows, k, step, pivots)
    if built is None:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    index, space, centres = built
    packs = query_packs(index, space, centres)
    extent = index.groupBy("shard", "pivot").agg(F.min("near").alias("low"), F.max("far").alias("high"))
    reach = packs.select("pack", F.explode("reach").alias("r")).select("pack", "r.*")
    # rows per task are counted in packs, so that packs that go to one shard together have a bounded size
    met = (reach.join(extent, "pivot").filter((F.col("high") >= F.col("near")) & (F.col("low") <= F.col("far")))
           .select("pack", "shard").distinct())
    tiles = held(met.withColumn("part", F.pmod(F.xxhash64("pack"), F.lit(max(1, -(-packs.count() // PACKS))))), "tiles")
    blocks = index.select("shard", "base", "pivot", "near", "far", "n", "ids", "vectors").join(tiles.select("shard", "part").distinct(), "shard")
    asked = packs.drop("reach").join(tiles.select("pack", F.col("shard").alias("to_shard"), F.col("part").alias("to_part")), "pack")

    def expanded(key: tuple, annuli: pa.Table, asks: pa.Table) -> pa.Table:
        shard = key[0].as_py()
        annuli = annuli.sort_by([("base", "ascending")])
        near, far, pivot, base = (annuli[c].to_numpy() for c in ("near", "far", "pivot", "base"))
        size = annuli["n"].to_numpy()
        ids = [np.frombuffer(x.as_py(), np.int64) for x in annuli["ids"]]
        blocks = [np.frombuffer(x.as_py(), space.stored).reshape(n, space.width) for x, n in zip(annuli["vectors"], size)]
        out: list[list[np.ndarray]] = [[], [], [], []]
        for ask in asks.to_pylist():
            names, floors, rows = (np.frombuffer(ask[c], np.int64) for c in ("ids", "floors", "rows"))
            queries = np.frombuffer(ask["vectors"], space.stored).reshape(len(names), space.width)
            found = Found(floors, k)
            from_pivots, _ = query_reach(space, centres, queries, floors)
            gap = np.maximum(0.0, np.maximum(from_pivots[:, pivot] - far[None, :], near[None, :] - from_pivots[:, pivot]))
            squares = (queries.astype(float) ** 2).sum(1) + space.norm2
            # the largest score that the triangle inequality leaves to an annulus
            bound = np.maximum((squares * (1 + SLACK))[:, None] / 2 + 1 - gap * gap * (1 - SLACK) / 2, float(NONE + 1))
            mine = np.where(rows >> 40 == shard, rows & ((1 << 40) - 1), -1)
            for j in np.argsort(gap.mean(0), kind="stable"):
                open_ = np.flatnonzero(bound[:, j] >= found.least)
                if len(open_):
                    scores = space.products(queries[open_], blocks[j])
                    own = np.flatnonzero((mine[open_] >= base[j]) & (mine[open_] < base[j] + size[j]))
                    scores[own, mine[open_[own]] - base[j]] = NONE
                    found.offer(open_, scores, ids[j])
            row, column = np.nonzero(found.scores > NONE)
            for column_out, values in zip(out, (rows[row], names[row], found.ids[row, column], found.scores[row, column])):
                column_out.append(values)
        return pa.table([pa.array(np.concatenate([np.zeros(0, np.int64), *x])) for x in out], names=["row", "query_id", "vec_id", "score"])

    heaps = blocks.groupBy("shard", "part").cogroup(asked.groupBy("to_shard", "to_part")).applyInArrow(
        expanded, "row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return (heaps.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"))


OP13_SQL = f"""
WITH taken AS (
    SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
    SELECT q.rid, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM taken q JOIN taken c ON q.rid <> c.rid WHERE q.vec_id % {QUERY_STEP} = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS rank FROM scores)
WHERE rank <= {NEIGHBOURS}
"""
