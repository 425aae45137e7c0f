import random

from corpus_cases import no_documents, odd_documents, prose, with_clashes
from demandgrid.llm import decontamination as d
from pyspark.sql import functions as F


def nearest(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != x)))
        row = new
    return min(row), row.index(min(row))


def test_myers_against_dynamic_programming():
    random.seed(1)
    for _ in range(500):
        p = "".join(random.choice("abc") for _ in range(random.randint(1, 80)))
        t = "".join(random.choice("abc") for _ in range(random.randint(0, 120)))
        assert d.Myers(p).nearest(t) == nearest(p, t)


def test_every_passage_within_the_budget_is_found():
    random.seed(2)
    items = [d.Item(i, " ".join(random.choice("lorem ipsum dolor sit amet elit sed eius tempor".split()) + str(random.randint(0, 99)) for _ in range(30))) for i in range(20)]
    matcher = d.Matcher(items)
    for item in items:
        text = list(item.text)
        for _ in range(d.budget(item.text)):
            at = random.randrange(len(text))
            kind = random.random()
            text[at:at + 1] = ["z"] if kind < 0.4 else [] if kind < 0.7 else [text[at], "q"]
        whole = prose(9, 50) + " " + "".join(text) + " " + prose(8, 50)
        distance, _ = nearest(item.text, whole)
        hit = [m for m in matcher.matches(whole) if m["item_id"] == item.item_id]
        assert distance <= d.budget(item.text) and hit and hit[0]["distance"] == distance
    assert matcher.matches(prose(7, 3000)) == []


def test_odd_rows(spark):
    items = spark.createDataFrame([(1, "Alpha, beta; GAMMA delta epsilon zeta eta theta!"), (2, None), (3, " ... "), (4, "short text"), (None, "alpha beta gamma delta epsilon zeta eta theta")], "item_id long, text string")
    docs = odd_documents(spark).unionByName(spark.createDataFrame([(70, "x " * 5000 + "alpha  BETA gamma delta, epsilon zeta eta theta y", "en", "a", 1)], odd_documents(spark).schema))
    found = docs.select("doc_id", F.inline(d.matches(F.col("text"), items))).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(70, 1), (70, None), (10, 4), (11, 4)}
    one_block = {(r["doc_id"], r["item_id"]) for r in docs.select("doc_id", F.inline(d.matches(F.col("text"), items, block_chars=30))).collect()}
    assert one_block == {(r["doc_id"], r["item_id"]) for r in found}
    kept = with_clashes(docs).filter(F.size(d.matches(F.col("text"), items)) == 0)
    assert kept.count() == docs.count() - 3 and kept.columns == with_clashes(docs).columns
    assert no_documents(spark).select(F.inline(d.matches(F.col("text"), items.limit(0)))).count() == 0
