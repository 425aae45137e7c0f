import math

import numpy as np
from demandgrid.llm import vectors_topk as x

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute_force(rows, k=5, step=50):
    taken = [(i, [math.floor(256 * c) for c in v]) for i, v in rows
             if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for at, (i, q) in enumerate(taken):
        if i % step == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for n, (j, v) in enumerate(taken) if n != at)
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores[:k], 1)]
    return sorted(out)


def rows_of(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(tuple(r) for r in df.collect())


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], schema).repartition(3)


def clustered(count, width, seed=1, norm=True):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, width))
    v = centres[rng.integers(0, 8, count)] + 0.2 * rng.normal(size=(count, width))
    return (v / np.linalg.norm(v, axis=1)[:, None] if norm else v * rng.uniform(0.1, 3, (count, 1))).tolist()


def test_like_brute_force(spark, monkeypatch):
    monkeypatch.setattr(x, "BLOCK", 32)
    monkeypatch.setattr(x, "LEAST_SHARD_ROWS", 300)
    monkeypatch.setattr(x, "PACK", 16)
    monkeypatch.setattr(x, "PACKS", 2)
    for norm in (True, False):
        rows = list(enumerate(clustered(1500, 12, norm=norm)))
        assert rows_of(x.search(frame(spark, rows), step=10)) == brute_force(rows, step=10)


def test_a_vector_that_a_third_of_all_rows_hold(spark):
    rows = [(i, [0.5, -0.25, 0.125] if i % 3 else [math.sin(i), math.cos(i), 0.1]) for i in range(900)]
    assert rows_of(x.search(frame(spark, rows), step=25)) == brute_force(rows, step=25)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.1, 0.2]), (50, [0.1, 0.2]), (50, [-0.3, 0.9]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 0.0]), (None, [1.0, 1.0]),
            (5, [0.4]), (-50, [0.0, 0.0, 0.7]), (7, []), (100, [-0.0, -1.0])]
    assert rows_of(x.search(frame(spark, rows))) == brute_force(rows)
    assert rows_of(x.search(frame(spark, []))) == []
    assert rows_of(x.search(frame(spark, [(0, [1.0])]))) == []
    assert rows_of(x.search(frame(spark, [(i, []) for i in range(3)]), step=2)) == brute_force([(i, []) for i in range(3)], step=2)


def test_large_components_stay_exact(spark):
    for size in (1e5, 1e6):
        rows = [(i, [size * math.sin(i * j + 1) for j in range(1, 5)]) for i in range(120)]
        assert rows_of(x.search(frame(spark, rows), step=10)) == brute_force(rows, step=10)
    huge = rows_of(x.search(frame(spark, [(0, [1e300, 0.0]), (1, [1e300, 1.0]), (2, [-1e300, 1.0])])))
    assert huge == [(0, 1, 1, (1 << 63) - 1), (0, 2, 2, -(1 << 63) + 2)]


def test_most_annuli_are_left_out():
    rng = np.random.default_rng(5)
    v = np.floor(256 * np.array(clustered(4000, 8))).astype(np.int64)
    space = x.Space(8, float((v * v).sum(1).max()), 256)
    centres = x.fit_pivots(space.lifted(v[:1000]))
    q = v[rng.integers(0, 4000, 50)]
    kth = np.sort(q @ v.T, axis=1)[:, -6]
    from_pivots, reach = x.query_reach(space, centres, q, kth)
    far = x.distances(space.lifted(v), centres)
    gap = np.abs(from_pivots[:, far.argmin(1)] - far.min(1)[None, :])
    met = gap <= reach[:, None]
    assert met[(q @ v.T) >= kth[:, None]].all() and met.mean() < 0.5


def test_query_like_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()]
    assert rows_of(x.op13_topk(spark, folder)) == brute_force(rows)
