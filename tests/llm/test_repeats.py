import random
from hashlib import sha256

import pytest
from corpus_cases import no_documents, odd_documents, prose, with_clashes
from demandgrid.llm import repeats as r

SMALL = "/root/testdata/sf0.001"


def brute(rows):
    """Results by walking every 100-byte string of all documents in order."""
    seen, out = set(), {}
    for doc_id, text in sorted({(d, t or "") for d, t in rows}, key=lambda x: (x[0] is None, x[0] or 0, x[1])):
        raw = text.encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            if raw[i:i + 100] in seen:
                gone[i:i + 100] = b"\1" * 100
            seen.add(raw[i:i + 100])
        spans = sum(gone[i] and (i == 0 or not gone[i - 1]) for i in range(len(gone)))
        out[doc_id, text] = (len(raw), sum(gone), spans, sha256(bytes(c for c, g in zip(raw, gone) if not g)).hexdigest())
    return sorted(map(str, ((d, *out[d, t or ""]) for d, t in rows)))


def found(docs, **options):
    return sorted(map(str, ((x["doc_id"], x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in r.repeats(docs, **options).collect())))


def pairs(docs):
    return [(x["doc_id"], x["text"]) for x in docs.collect()]


@pytest.mark.parametrize("crowded", [r.CROWDED, 1])
def test_given_documents(spark, crowded):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert found(docs, crowded=crowded) == brute(pairs(docs))


def test_repeats_within_and_across(spark, monkeypatch):
    random.seed(6)
    monkeypatch.setattr(r, "CHUNK", 500)       # texts of several chunks
    monkeypatch.setattr(r, "GATHER", 2_000)    # tasks that work off their groups in parts
    blocks = ["".join(random.choice("ab ") for _ in range(n)) for n in (99, 100, 101, 160, 400)] + ["\0" * 300, "é" * 130, "z" * 1500]
    rows = [(i, "".join(random.choice(blocks) + random.choice(["", "x", "yy"]) for _ in range(6)), "en", "a", 0) for i in range(40)]
    docs = spark.createDataFrame(rows, odd_documents(spark).schema)
    assert found(docs) == found(docs, crowded=2) == brute(pairs(docs))


def test_odd_rows(spark):
    docs = odd_documents(spark).filter("doc_id is null or doc_id <> 12")   # two texts under one id have no order to compare
    assert found(with_clashes(docs)) == brute(pairs(docs))
    assert found(no_documents(spark)) == []
