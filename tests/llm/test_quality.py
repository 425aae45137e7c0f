import re
from collections import Counter

from corpus_cases import no_documents, odd_documents, prose, with_clashes
from demandgrid.llm import quality

SMALL = "/root/testdata/sf0.001"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def counts(r):
    return r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]


def test_counts_of_given_documents(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = quality.op3_quality(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert counts(r) == brute(texts[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"])


def test_odd_rows(spark):
    extra = spark.createDataFrame([(90, "a b c d e f g h " * 5, "en", "a", 1), (91, "x\n \nx\n\nx\ty", "en", "a", 1),
                                   (92, "one two three four five six seven eight nine one two three four five six seven eight", None, None, 1)],
                                  odd_documents(spark).schema)
    docs = odd_documents(spark).unionByName(extra)
    rows = quality.judged(with_clashes(docs).withColumnRenamed("n_chars", "n_chars_")).collect()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], []).append(brute(r["text"]))
    for r in rows:
        assert counts(r) in texts[r["doc_id"]] and r["score"] == "mine-score"
    assert len(rows) == docs.count()
    assert quality.judged(no_documents(spark)).count() == 0


def test_outliers_go_and_clean_texts_stay(spark):
    rows = [(i, prose(i, 60 + i % 90), "en", "a", 0) for i in range(300)] + [(1000 + i, " ".join(f"{w}###" for w in prose(i, 80).split()), "en", "a", 0) for i in range(30)]
    kept = {r["doc_id"]: r["kept"] for r in quality.judged(spark.createDataFrame(rows, odd_documents(spark).schema)).collect()}
    assert not any(kept[1000 + i] for i in range(30))
    assert sum(kept[i] for i in range(300)) >= 299


def test_chi_square():
    assert abs(quality.chi_square(11.0705, 5) - 0.95) < 1e-5
    assert abs(quality.chi_square_quantile(0.95, 5) - 11.0705) < 1e-3


def test_main_path_runs_no_python(spark):
    plan = quality.op3_quality(spark, SMALL)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
