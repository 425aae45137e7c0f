import random
from collections import Counter
from hashlib import sha256

import pytest
from corpus_cases import no_documents, odd_documents, prose, with_clashes
from demandgrid.llm import alignment as x

SMALL = "/root/testdata/sf0.001"
ZEROS = (0, 0, 0, 0, 0, 0)


@pytest.fixture(scope="module")
def aligner():
    return x.Aligner(x.read_file(x.BYTE_FILE), x.read_file(x.PIECE_FILE))


def groups_of(aligner, text):
    """Groups by a walk over single bytes; None without tokens."""
    if not text:
        return None
    ids_a = aligner.a.encode(f" {text}", add_special_tokens=False).ids
    ids_b = aligner.b.encode(text)
    owner = []
    for ids, table in ((ids_a, aligner.bytes_a), (ids_b, aligner.bytes_b)):
        joined = b"".join(table[i] for i in ids)
        if joined != f" {text}".encode():
            return None
        owner.append([n for n, i in enumerate(ids) for _ in table[i]])
    groups, a, b = [], [], []
    size = len(owner[0])
    for at in range(size):
        end_a = at + 1 == size or owner[0][at + 1] != owner[0][at]
        end_b = at + 1 == size or owner[1][at + 1] != owner[1][at]
        if end_a:
            a.append(ids_a[owner[0][at]])
        if end_b:
            b.append(ids_b[owner[1][at]])
        if end_a and end_b:
            groups.append((a, b))
            a, b = [], []
    return groups


def brute_force(aligner, docs):
    found = [(i, groups_of(aligner, t)) for i, t in docs]
    links = [Counter((p, q) for a, b in g or [] for p in a for q in b) for _, g in found]
    held = Counter(pair for one in links for pair in one)
    best = {}
    for (p, _), n in held.items():
        best[p] = max(best.get(p, 0), n)
    out = []
    for (i, g), one in zip(found, links):
        if g is None:
            out.append((i, *ZEROS, ""))
            continue
        told = ";".join("|".join(",".join(map(str, side)) for side in group) for group in g)
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), sum(one.values()),
                    sum(n for pair, n in one.items() if held[pair] == best[pair[0]]), sum(n * held[pair] for pair, n in one.items()), told))
    return sorted(out, key=str)


def rows(df, text="groups"):
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", text]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_odd_documents(spark, aligner, monkeypatch):
    docs = odd_documents(spark)
    more = [(20, " "), (21, "  two  blanks "), (22, "tab\tline\nline"), (23, "<|endoftext|> and <s> </s> <unk>"), (24, "▁ is a piece"), (25, "ﬁ ½ ² é ​"),
            (26, "x" * 3000), (27, " " * 3000), (28, "\x00\x01"), (29, "日本語のテキスト😀"), (30, "<0x41> bytes"), (None, "the same"), (None, "the same")]
    docs = docs.unionByName(spark.createDataFrame([(i, t, None, None, None) for i, t in more], docs.schema))
    known = [(r["doc_id"], r["text"]) for r in docs.collect()]
    truth = brute_force(aligner, known)
    assert rows(x.align(with_clashes(docs))) == truth
    monkeypatch.setattr(x, "SEGMENT_PAIRS", 50)
    monkeypatch.setattr(x, "EXPANDED", 64)
    monkeypatch.setattr(x, "LARGE_SLICE", 3)
    assert rows(x.align(docs.repartition(3))) == truth
    assert any(r[1:] == (*ZEROS, "") for r in truth) and any(r[1] for r in truth)


def test_empty_table(spark):
    assert rows(x.align(no_documents(spark))) == []


def test_only_documents_without_tokens(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "▁")], "doc_id long, text string")
    assert rows(x.align(docs)) == [(i, *ZEROS, "") for i in (1, 2, 3)]


def test_the_faster_encoder_gives_the_ids_of_the_file(spark, aligner):
    assert aligner.ranked
    random.seed(6)
    signs = [chr(c) for c in [*range(1, 0x250)]] + list("  \n\n\t'sdmtlver0123456789")
    texts = [f" {''.join(random.choices(signs, k=200))}" for _ in range(400)] + ["  a", " ", "   ", " a  ", " don't we'LL 'S \n\n  x"]
    texts += [f" {r['text']}" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    for text in texts:
        assert aligner.encode_a(text) == aligner.a.encode(text, add_special_tokens=False).ids


def test_groups_can_be_read_back(aligner):
    text = prose(4, 300)
    ids_a, ids_b = next(iter(aligner.encode([text])))
    told = aligner.written_groups(*aligner.slices(text, ids_a, ids_b))
    sides = [[[int(i) for i in side.split(",")] for side in group.split("|")] for group in told.split(";")]
    assert [i for a, _ in sides for i in a] == ids_a and [i for _, b in sides for i in b] == ids_b


def test_query_like_brute_force(spark, aligner):
    known = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    truth = sorted(((*r[:7], sha256(r[7].encode()).hexdigest() if r[7] else "") for r in brute_force(aligner, known)), key=str)
    assert rows(x.op11_alignment(spark, SMALL), "groups_sha256") == truth
