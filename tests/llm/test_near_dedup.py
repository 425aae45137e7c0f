import itertools
import random

import numpy as np
from corpus_cases import no_documents, odd_documents, prose, with_clashes
from demandgrid.llm import near_dedup as n

SMALL = "/root/testdata/sf0.001"


def brute(rows, idf):
    """Class of every row by comparing all pairs of texts that share a shingle."""
    hashes = n.WordHashes()
    sets = [n.shingle_weights(hashes.of(t), idf) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if len(sets[a][0]) and len(sets[b][0]) and (rows[a][1] == rows[b][1] or n.weighted_jaccard(sets[a], sets[b]) >= n.SIMILARITY):
            parent[max(root(a), root(b))] = min(root(a), root(b))
    names = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            names[root(i)] = min(names.get(root(i), doc_id), doc_id)
    return sorted((str(d), str(names.get(root(i)) if len(sets[i][0]) else d)) for i, (d, _) in enumerate(rows))


def found(docs):
    return sorted((str(r["doc_id"]), str(r["class_id"])) for r in n.near_duplicates(docs).collect())


def test_classes_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert found(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()], n.word_idf(docs))


def test_chains_and_groups_of_near_copies(spark, monkeypatch):
    random.seed(4)
    rows = []
    for g in range(4):
        words = prose(g + 20, 120).split()
        for _ in range(12):
            copy = list(words)
            for at in random.sample(range(120), random.choice([0, 1, 2, 5])):
                copy[at] = f"new{random.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy), "en", "a", 0))
            words = copy if g == 3 else words      # the last group drifts away from its start
    docs = spark.createDataFrame(rows, odd_documents(spark).schema)
    monkeypatch.setattr(n, "BLOCK_MEMBERS", 3)     # blocks within buckets
    assert found(docs) == brute([(r[0], r[1]) for r in rows], n.word_idf(docs))


def test_samples_estimate_the_weighted_similarity():
    rng = np.random.default_rng(5)
    sampler = n.Sampler(4096)
    keys = np.unique(rng.integers(0, 1 << 62, 500).astype(np.uint64))
    weights = rng.uniform(1, 9, len(keys)).astype(np.float32)
    a, b = (keys[:450], weights[:450]), (keys[50:], (weights * rng.choice([1, 1.5], len(keys)).astype(np.float32))[50:])
    equal = (sampler.sample(*a) == sampler.sample(*b)).mean()
    assert abs(equal - n.weighted_jaccard(a, b)) < 0.03


def test_odd_rows(spark):
    docs = odd_documents(spark)
    assert found(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()], n.word_idf(docs))
    kept = n.stage(spark, with_clashes(docs), "")
    assert kept.columns == with_clashes(docs).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [-3, 1, 3, 4, 5, 6, 8, 10, 12, 12] and ids.count(None) == 2
    assert found(no_documents(spark)) == [] and n.stage(spark, no_documents(spark), "").count() == 0


def test_members_near_other_classes_like_all_pairs():
    rng = np.random.default_rng(6)
    for classes in (1, 2, 7):
        samples = rng.integers(0, 2, (60, n.BANDS * n.ROWS)).astype(np.uint32)
        samples[30:] = samples[:30] ^ (rng.random((30, n.BANDS * n.ROWS)) < 0.4)
        label = rng.integers(0, classes, 60)
        near = [any(label[x] != label[y] and (samples[x] == samples[y]).mean() >= 0.6 for y in range(60)) for x in range(60)]
        assert n.near_other_classes(samples, label, 0.6).tolist() == near and (classes == 1 or 0 < sum(near) < 60 or classes == 7)
