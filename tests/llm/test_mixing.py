import re

import pytest

from corpus_cases import no_documents, odd_documents, with_clashes
from demandgrid.llm import mixing

SMALL = "/root/testdata/sf0.001"


def targets(sizes, share=1.5):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {n: (3, 1, 2)[i % 3] for i, n in enumerate(names)}
    budget, full = share * sum(sizes.values()), set()
    while True:
        rest = [n for n in names if n not in full]
        level = (budget - sum(2 * sizes[n] for n in full)) / sum(weight[n] for n in rest) if rest else 0
        over = {n for n in rest if level * weight[n] > 2 * sizes[n]}
        if not over:
            return {n: 2 * sizes[n] if n in full else level * weight[n] for n in names}
        full |= over


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_rates_and_reruns(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    first = {r["doc_id"]: r for r in mixing.op2_mixing(spark, SMALL).collect()}
    again = {r["doc_id"]: r["taken"] for r in mixing.op2_mixing(spark, SMALL).collect()}
    assert {k: r["taken"] for k, r in first.items()} == again
    sizes = {}
    for r in docs.values():
        sizes[r["source"]] = sizes.get(r["source"], 0) + words(r["text"])
    expected = targets(sizes)
    for k, r in first.items():
        assert r["size"] == words(docs[k]["text"]) and r["source_size"] == sizes[docs[k]["source"]]
        assert r["target"] == pytest.approx(expected[docs[k]["source"]]) and 0 <= r["taken"] <= 2 * r["size"]
    for source, target in expected.items():
        own = [r for k, r in first.items() if docs[k]["source"] == source]
        assert abs(sum(r["taken"] for r in own) - target) <= max(r["size"] for r in own)


def test_multipliers_meet_the_words_of_every_source(spark):
    cells = spark.createDataFrame([("=a", 10, 4), ("=a", 100, 2), ("=b", 7, 30), ("=b", 5000, 1), ("", 3, 5)], "_s string, size long, n long")
    for r in mixing.multipliers(cells, mixing.source_targets(cells)).collect():
        if r["multiplier"] is not None:
            own = [(c["size"], c["n"]) for c in cells.collect() if c["_s"] == r["_s"]]
            from math import exp
            taken = sum(n * s * min(2, exp(r["multiplier"] * s / r["mean"])) for s, n in own)
            assert taken == pytest.approx(r["target"], rel=1e-4)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    sized = docs.select("doc_id", "source", mixing.size_of(docs["text"]).alias("size"))
    rows = mixing.mix(sized, sized).collect()
    assert len(rows) == docs.count() and all(0 <= r["copies"] <= 2 for r in rows)
    assert all(r["copies"] == 0 for r in rows if r["size"] == 0)
    made = mixing.stage(spark, with_clashes(docs), "")
    assert set(with_clashes(docs).columns) < set(made.columns)
    assert made.count() == sum(r["copies"] for r in rows)
    assert mixing.stage(spark, no_documents(spark), "").count() == 0
