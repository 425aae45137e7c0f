import math
import random
import re

import duckdb
import numpy as np
from corpus_cases import no_documents, odd_documents, with_clashes
from demandgrid.llm import lexical as x

ITEMS = "item_id long, text string"
SMALL = "/root/testdata/sf0.001"


def brute_force(docs, items, k=20):
    """Straight from the formulas, with a loop over everything."""
    def terms(text):
        return re.findall(x.TERM, (text or "").translate(str.maketrans(x.UPPER, x.LOWER)))
    found = [(i, terms(t)) for i, t in docs]
    total, many = sum(len(t) for _, t in found), sum(bool(t) for _, t in found)
    df = {}
    for _, t in found:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    out = []
    for item, text in items:
        scores = []
        for i, t in found:
            score = 0
            for w in terms(text):
                tf = t.count(w)
                if tf:
                    m = 100 - 25 + 25 * len(t) * many // total
                    score += math.floor(1000 * math.log((2 * many + 2) / (2 * df[w] + 1))) * (10**9 * tf // (1000 * tf + 12 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def rows(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def found(spark, docs, items, k=20, **sizes):
    index, documents = x.build_index(docs, **sizes)
    return rows(x.search(index, documents, spark.createDataFrame(items, ITEMS), k))


def test_like_brute_force_in_many_small_shards(spark):
    random.seed(3)
    words = ["the"] * 30 + ["of"] * 15 + [f"w{i}" for i in range(60)] + ["Über", "naïve", "x1", "日本"]
    docs = [(random.choice([None, *range(40)]), " ".join(random.choices(words, k=random.choice([1, 4, 30, 200])))) for _ in range(250)]
    items = [(i, " ".join(random.choices(words, k=12))) for i in range(30)] + [(7, "the THE the w1"), (None, "w2, w3"), (50, None), (51, "!!"), (52, "never")]
    for sizes in ({}, {"shard_terms": 300}):
        assert found(spark, spark.createDataFrame(docs, "doc_id long, text string"), items, 5, **sizes) == brute_force(docs, items, 5)


def test_odd_documents(spark):
    docs = odd_documents(spark)
    items = [(1, "alpha3 beta4 BETA4 ünïcode short"), (2, ""), (1, "alpha3 beta4 BETA4 ünïcode short"), (3, "text 😀")]
    known = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(spark, with_clashes(docs), items) == brute_force(known, items)
    assert found(spark, no_documents(spark), items) == []
    assert found(spark, docs, []) == []


def test_lists_that_are_not_essential_are_opened_only_where_needed():
    random.seed(4)
    common, rare = np.arange(0, 60000, 2), np.array(sorted(random.sample(range(0, 60000, 2), 40)))
    def postings(docs, impacts):
        cuts = range(0, len(docs), x.BLOCK)
        return x.Postings(len(docs), *(np.array([f(v[c:c + x.BLOCK]) for c in cuts], np.int32).tobytes() for f, v in ((min, docs), (max, docs), (max, impacts))),
                          [x.packed(docs[c:c + x.BLOCK].astype(np.uint16).tobytes(), impacts[c:c + x.BLOCK].astype(np.int32).tobytes(), len(docs[c:c + x.BLOCK]))
                           for c in cuts])
    some = np.array([random.randrange(1, 100) for _ in common])
    lists = [(postings(common, some), 1), (postings(rare, np.full(len(rare), 1000)), 50)]
    docs, scores = x.best_of(lists, 60000, 10)
    truth = dict(zip(common.tolist(), some.tolist()))
    for r in rare.tolist():
        truth[r] += 50000
    best = sorted(truth.items(), key=lambda p: (-p[1], p[0]))[:10]
    assert list(zip(docs.tolist(), scores.tolist())) == best
    assert len(lists[0][0].opened) < len(lists[0][0].blocks) / 3


def test_terms_are_cut_alike_in_bytes_and_text():
    text = "A-b_C9 Ünï\x7f\x80 x y\x00z 日本,語"
    assert [t.decode() for t in x.terms_of(text.encode())] == re.findall(x.TERM, text.translate(str.maketrans(x.UPPER, x.LOWER)))


def test_query_like_sql(spark):
    c = duckdb.connect()
    for name in ("documents", "benchmark"):
        c.execute(f"create view {name} as select * from '{SMALL}/{name}.parquet'")
    answer = c.execute(x.OP12_SQL)
    names = [d[0] for d in answer.description]
    expected = sorted((tuple(dict(zip(names, r))[n] for n in ("item_id", "rank", "doc_id", "score")) for r in answer.fetchall()), key=str)
    assert rows(x.op12_lexical(spark, SMALL)) == expected
