import pytest
import tiktoken
from corpus_cases import no_documents, odd_documents
from demandgrid.llm import token_counts as t
from demandgrid.llm.secrets import PIECES, parsed_ranks
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
CHANGE = "op string, source string, lang string, version string, tokens long, old_tokens long, old_source string, old_lang string"


def totals(ledger):
    return sorted(map(str, ((r["source"], r["lang"], r["version"], r["docs"], r["tokens"]) for r in ledger.totals().collect())))


def test_signed_changes_and_idempotent_commits(spark, tmp_path):
    ledger = t.Ledger(spark, str(tmp_path / "ledger"))
    assert totals(ledger) == []
    load = spark.createDataFrame([("insert", "a", "en", "v1", 10, None, None, None)] * 3 + [("insert", None, None, "v1", 0, None, None, None)], CHANGE)
    assert ledger.apply("b1", load) and not ledger.apply("b1", load)
    change = spark.createDataFrame([("delete", "a", "en", "v1", None, 10, None, None), ("revise", "b", "en", "v1", 7, 10, "a", "en")], CHANGE)
    assert ledger.apply("b2", change) and not ledger.apply("b2", load)
    expected = sorted(map(str, [("a", "en", "v1", 1, 10), ("b", "en", "v1", 1, 7), (None, None, "v1", 1, 0)]))
    assert totals(ledger) == expected
    # an attempt that was written but never committed is not read
    t.Ledger.signed(load).write.parquet(f"{ledger.folder}/deltas/b3-lost")
    assert totals(ledger) == expected
    assert ledger.compact("s1") and not ledger.compact("s1") and totals(ledger) == expected
    assert not ledger.apply("b1", load)
    assert ledger.apply("b3", spark.createDataFrame([("delete", "b", "en", "v1", None, 7, None, None)], CHANGE))
    assert ledger.compact("s2") and totals(ledger) == [x for x in expected if "'b'" not in x]


@pytest.mark.parametrize("row", [("drop", "a", "en", "v", 1, 1, "a", "en"), (None, "a", "en", "v", 1, 1, "a", "en"),
                                 ("insert", "a", "en", None, 1, 1, "a", "en"), ("revise", "a", "en", "v", 1, None, "a", "en")])
def test_invalid_changes_are_errors(spark, tmp_path, row):
    with pytest.raises(Exception, match="no valid change"):
        t.Ledger(spark, str(tmp_path / "l")).apply("b", spark.createDataFrame([row], CHANGE))


def test_counts_of_odd_rows(spark):
    encoding = tiktoken.Encoding("t", pat_str=PIECES, mergeable_ranks=parsed_ranks(open(t.VOCABULARY, "rb").read()), special_tokens={})
    docs = odd_documents(spark)
    for r in docs.select("text", t.token_count(spark, F.col("text")).alias("n"), t.word_count(F.col("text")).alias("w")).collect():
        assert r["n"] == len(encoding.encode_ordinary(r["text"] or "")) and r["w"] == len((r["text"] or "").split())
    assert no_documents(spark).select(t.token_count(spark, F.col("text"))).count() == 0


def test_query_against_a_recount(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").toPandas()
    marks = spark.read.parquet(f"{SMALL}/labels.parquet").toPandas()
    encoding = tiktoken.Encoding("t", pat_str=PIECES, mergeable_ranks=parsed_ranks(open(t.VOCABULARY, "rb").read()), special_tokens={})
    docs["words-1"] = [len(x.split()) for x in docs.text]
    docs["byte-bpe-50k"] = [len(encoding.encode_ordinary(x)) for x in docs.text]
    docs = docs.merge(marks, on="doc_id", how="left")
    docs.loc[docs.toxic == 1, "source"] = "quarantine"
    long = docs.melt(["source", "lang", "quality", "toxic"], ["words-1", "byte-bpe-50k"], "version", "tokens")
    long = long[~((long.version == "byte-bpe-50k") & (long.quality == 0) & (long.toxic != 1))]
    expected = long.groupby(["source", "lang", "version"]).tokens.agg(["size", "sum"])
    found = {(r["source"], r["lang"], r["version"]): (r["docs"], r["tokens"]) for r in t.op1_token_counts(spark, SMALL).collect()}
    assert found == {k: (v["size"], v["sum"]) for k, v in expected.iterrows()}
