import corpus_pipeline
from demandgrid.llm import decontamination, near_dedup, pii
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"


def test_stages_take_effect_one_after_the_other(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        counts.append(docs.count())
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    toxic, single, clean, private, mixed = counts[1:]
    assert counts[0] > toxic > single >= clean == private > 0 and mixed > 0
    rows = [spark.read.parquet(str(tmp_path / str(i))) for i in range(5)]
    classes = near_dedup.near_duplicates(rows[0])
    assert {r["doc_id"] for r in rows[1].collect()} == {r["class_id"] for r in classes.collect()}
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    assert rows[2].filter(F.size(decontamination.matches(F.col("text"), items)) > 0).count() == 0
    old, new = ({r["doc_id"]: r["text"] for r in d.collect()} for d in (rows[2], rows[3]))
    for k, text in old.items():
        spans = pii.detect(text)
        assert (new[k] != text) == bool(spans)
    run = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(str, run.collect())) == sorted(map(str, rows[4].collect()))
