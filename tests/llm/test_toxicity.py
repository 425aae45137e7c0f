import gc
import math
import random
import re
import tracemalloc
import zlib

import numpy as np
from corpus_cases import no_documents, odd_documents, with_clashes
from demandgrid.llm import toxicity as t
from pyspark.sql import functions as F

LABELS = "doc_id long, quality int, toxic int"


def corpus(spark, size=600):
    random.seed(7)
    rows, labels = [], []
    for i in range(size):
        words = [random.choice("north south east west river lake stone grass cloud light".split()) + random.choice(["", "s", "ed"]) for _ in range(60)]
        toxic = int(i % 5 == 0)
        if toxic:
            for _ in range(3):
                words[random.randrange(60)] = random.choice(["vilemouth", "foulwort", "grimslur"]) + random.choice(["", "s", "ing", "ers"])
        rows.append((i, " ".join(words), "en", "a", 0))
        labels.append((i, 1, toxic))
    return spark.createDataFrame(rows, odd_documents(spark).schema), spark.createDataFrame(labels, LABELS)


def test_nearest_is_exact():
    rng = np.random.default_rng(8)
    vectors = [t.unit({int(k): int(rng.integers(1, 4)) for k in rng.choice(40, rng.integers(1, 8), replace=False)}, rng.uniform(1, 5, 40)) for _ in range(700)]
    index = t.BlockMaxIndex.build(vectors, 40)
    for q in vectors[:60]:
        scores = np.array([sum(q.get(k, 0) * w for k, w in v.items()) for v in vectors])
        ids, values = index.nearest(q, 10)
        kth = np.sort(scores)[-10]
        assert set(ids) == set(np.flatnonzero((scores >= kth - 1e-9) & (scores > 0))) and np.allclose(np.sort(values)[-10:], np.sort(scores)[-10:])


def test_held_out_documents_are_told_apart(spark):
    docs, labels = corpus(spark)
    scored = (t.score(docs, t.fit(docs, labels)).join(labels, "doc_id").filter(t.held_out(F.col("doc_id")))
              .select("toxic", "predicted", "score", "evidence").collect())
    assert len(scored) > 100 and np.mean([r["toxic"] == r["predicted"] for r in scored]) > 0.98
    assert all(r["evidence"] for r in scored if r["predicted"])


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = corpus(spark, 200)
    turned = labels.withColumn("toxic", F.when(t.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ([(r["doc_id"], r["score"]) for r in t.score(docs, t.fit(docs, x)).orderBy("doc_id").collect()] for x in (labels, turned))
    assert a == b


def test_odd_rows(spark):
    docs, labels = corpus(spark)
    model = t.fit(docs, labels.unionByName(spark.createDataFrame([(None, 1, 1), (1, 1, None), (2, None, 0), (2, None, 0)], LABELS)))
    rows = t.score(odd_documents(spark), model).collect()
    assert len(rows) == odd_documents(spark).count() and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if not (r["text"] or "").strip()}) == 1
    nothing = t.fit(no_documents(spark), labels)
    assert {(r["score"], r["predicted"]) for r in t.score(odd_documents(spark), nothing).collect()} == {(0.5, 0)}
    assert t.score(no_documents(spark), model).count() == 0


def test_stage_keeps_columns(spark, tmp_path):
    docs, labels = corpus(spark, 300)
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    kept = t.stage(spark, with_clashes(docs), str(tmp_path))
    assert kept.columns == with_clashes(docs).columns
    left = {r["doc_id"] for r in kept.collect()}
    assert len({i for i in range(300) if i % 5} - left) <= 2 and len({i for i in range(0, 300, 5)} & left) <= 4


def test_an_insult_of_two_examples_is_a_neighbour(spark):
    # seen in two toxic and no clean examples, too few for any test of significance
    docs, labels = corpus(spark, 400)
    toxic = [i for i in range(0, 400, 5) if zlib.crc32(str(i).encode()) % 3 != 1][:2]
    marked = docs.withColumn("text", F.when(F.col("doc_id").isin(toxic), F.regexp_replace("text", r"\b(vilemouth|foulwort|grimslur)\w*", "zzyxvox")).otherwise(F.col("text")))
    query = spark.createDataFrame([(9000, "north stone zzyxvox zzyxvox lake", "en", "a", 0)], docs.schema)
    found = t.score(query, t.fit(marked, labels)).first()
    assert {int(x.split(":")[0]) for x in found["evidence"].split(",")[:2]} == set(toxic)


def plain_terms(text):
    counts = {}
    for word in re.findall(r"\w+", (text or "").lower()):
        for form in (f"={word}", *(f"{word[:n]}*" for n in (4, 5) if len(word) >= n)):
            counts[form] = counts.get(form, 0) + 1
    return counts | {f"{form}>{least}": 1 for form, n in counts.items() for least in (2, 4) if n >= least}


def likelihood_weight(a, b, positives, negatives):
    cells = ((a, a + b, positives), (b, a + b, negatives), (positives - a, positives + negatives - a - b, positives),
             (negatives - b, positives + negatives - a - b, negatives))
    ratio = max(0.0, 2 * sum(n * math.log(n * (positives + negatives) / (row * column)) for n, row, column in cells if n))
    return 0.01 + 0.99 * ratio / (ratio + 24)


def brute_scores(docs, labels):
    """The whole query with dictionaries and loops over all pairs."""
    texts = {i: plain_terms(t) for i, t in docs}
    examples = {i: y for i, y in labels.items() if zlib.crc32(str(i).encode()) % 3 != 1}
    positives = sum(examples.values())
    vocabulary = {term for i in examples for term in texts[i]}
    weight = {}
    for term in vocabulary:
        a, b = (sum(term in texts[i] for i, y in examples.items() if y == label) for label in (1, 0))
        seen = sum(term in own for own in texts.values())
        weight[term] = likelihood_weight(a, b, positives, len(examples) - positives) * (1 + math.log((1 + len(docs)) / (1 + seen)))

    def vector(i):
        raw = {t: (1 + math.log(n)) * weight[t] for t, n in texts[i].items() if t in weight}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        return {t: v / norm for t, v in raw.items()}

    vectors = {i: vector(i) for i in texts}

    def share(i, k, others):
        near = sorted(((sum(v * vectors[j].get(t, 0.0) for t, v in vectors[i].items()), j) for j in others), reverse=True)
        near = [(c, j) for c, j in near if c > 0 and c >= near[min(k, len(near)) - 1][0] - 1e-9]
        votes = [(1 / (1.02 - min(c, 1.0)), examples[j]) for c, j in near]
        return sum(w * y for w, y in votes) / sum(w for w, _ in votes)

    def steps(pairs):
        """The non-decreasing fit by its closed form: the largest of the least means around a place."""
        pairs = sorted(pairs, key=lambda p: p[0])
        y = [p[1] for p in pairs]
        fitted = [max(min(sum(y[j:m + 1]) / (m + 1 - j) for m in range(n, len(y))) for j in range(n + 1)) for n in range(len(y))]
        groups = {}
        for (x, label), value in zip(pairs, fitted):
            groups.setdefault(round(value, 12), []).append((x, label))
        return [(sum(x for x, _ in g) / len(g), (sum(l for _, l in g) + 0.5) / (len(g) + 1)) for _, g in sorted(groups.items())]

    best = None
    for k in t.NEIGHBOURS:
        left_out = [(share(i, k, [j for j in examples if j != i]), y) for i, y in examples.items()]
        xs, ys = zip(*steps(left_out))
        error = np.mean([(np.interp(s, xs, ys) - y) ** 2 for s, y in left_out])
        if best is None or error < best[0]:
            best = error, k, xs, ys
    _, k, xs, ys = best
    shares = {i: share(i, k, list(examples)) for i in texts}
    return {i: min(1.0, max(0.0, 0.98 * float(np.interp(s, xs, ys)) + 0.02 * s)) for i, s in shares.items()}


def test_whole_query_like_brute_force(spark, tmp_path):
    docs, labels = corpus(spark, 130)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    expected = brute_scores([(r["doc_id"], r["text"]) for r in docs.collect()], {r["doc_id"]: r["toxic"] for r in labels.collect()})
    found = {r["doc_id"]: (r["score"], r["predicted"]) for r in t.op9_toxicity(spark, str(tmp_path)).collect()}
    assert found.keys() == expected.keys()
    assert all(abs(found[i][0] - s) < 1e-4 and found[i][1] == int(found[i][0] >= 0.7) for i, s in expected.items())


def test_blocks_are_left_out():
    """Queries near one group of examples do not open the blocks of others."""
    rng = np.random.default_rng(9)
    weights = np.ones(60)
    vectors = [t.unit({int(n): int(rng.integers(1, 3)) for n in [*rng.choice(np.arange(20 * g, 20 * g + 20), 12, replace=False)]}, weights) for g in range(3) for _ in range(256)]
    index = t.BlockMaxIndex.build(vectors, 60)
    opened = []

    class Told(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, tuple) and isinstance(key[1], slice):
                opened.append(key[1].start)
            return np.asarray(super().__getitem__(key))

    index.make_lists()
    index.common = index.common.view(Told)
    ids, _ = index.nearest(vectors[700], 5)
    assert len(index.common) == 60 and (ids >= 512).all() and set(opened) < set(range(0, 768, t.BLOCK))


def test_blocks_whose_members_share_little_are_left_out():
    """Members with one common term each have high block maxima together, but no member can be near."""
    high = [{**{c: 0.3 for c in range(8)}, 8 + i: 0.5} for i in range(4 * t.BLOCK)]
    low = [{i % 8: 0.4, 8 + 4 * t.BLOCK + i: 0.9} for i in range(2 * t.BLOCK)]
    index = t.BlockMaxIndex.build(high + low, 8 + 6 * t.BLOCK)
    opened = []

    class Told(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, tuple) and isinstance(key[1], slice):
                opened.append(key[1].start)
            return np.asarray(super().__getitem__(key))

    index.make_lists()
    index.common = index.common.view(Told)
    ids, cosines = index.nearest({c: 8 ** -0.5 for c in range(8)}, 5)
    assert list(ids) == list(range(4 * t.BLOCK)) and np.allclose(cosines, 0.3 * 8 ** 0.5)
    assert opened and max(opened) < 4 * t.BLOCK


def test_terms_of_texts_leave_nothing_behind():
    """Words of a batch are let go at once, not when Python looks for cycles, which is seldom where there are few objects."""
    texts = [f"north{i} south east" for i in range(200)]
    known = t.Vocabulary()
    known.counts_of(texts)
    gc.collect()
    gc.disable()
    try:
        known.counts_of(texts)
        assert not gc.collect()
    finally:
        gc.enable()


def sparse_vectors(rng, size, words):
    sizes = rng.integers(20, 60, size)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    # some terms are far more common than others
    terms = np.concatenate([np.sort(np.unique((words * rng.random(4 * n) ** 4).astype(np.int32))[rng.permutation(n // 2)]) for n in sizes])
    starts = np.concatenate([[0], np.cumsum(sizes // 2)])
    values = rng.random(len(terms)).astype(np.float32)
    values /= np.repeat(np.sqrt(np.add.reduceat(values * values, starts[:-1])), sizes // 2)
    return starts, terms, values


def test_shared_columns_change_no_cosine(monkeypatch):
    monkeypatch.setattr(t, "COLUMNS", 16)
    starts, terms, values = sparse_vectors(np.random.default_rng(3), 900, 400)
    dense = np.zeros((900, 400))
    dense[np.repeat(np.arange(900), np.diff(starts)), terms] = values
    index = t.BlockMaxIndex(starts, terms, values, 400)
    queries = [(np.flatnonzero(dense[n]), dense[n][np.flatnonzero(dense[n])]) for n in range(0, 900, 7)]
    found = list(index.nearest_many(queries, 10))
    assert len(index.common) == 16 and (index.place >= 0).sum() > 16
    for n, (ids, cosines) in zip(range(0, 900, 7), found):
        all_ = dense @ dense[n]
        assert set(ids) == set(np.flatnonzero((all_ >= np.sort(all_)[-10] - 1e-9) & (all_ > 0))) and np.allclose(cosines, all_[ids])


def test_an_index_is_made_in_little_memory():
    rng = np.random.default_rng(4)
    terms, starts = rng.integers(0, 50_000, 2_000_000).astype(np.int32), np.arange(0, 2_000_001, 200)
    index = t.BlockMaxIndex(starts, terms, np.ones(len(terms), np.float32), 50_000)
    del terms
    tracemalloc.start()
    try:
        index.make_lists()
        now, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    # 8 bytes an entry stay, and no more is needed twice over; the vectors are let go
    assert index.terms is None and now < 12 * 2_000_000 and peak < 25 * 2_000_000
