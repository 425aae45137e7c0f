"""Token counts as rollups kept up to date by signed deltas.

A ledger is a folder of batches. A change is one of

* ``insert``: a document with its tokens,
* ``delete``: a document with the tokens it was counted with,
* ``revise``: a document with its former and its new tokens (and, where these changed, its former source and language),

each for a tokenizer version. A batch sums its changes to signed totals of documents and tokens by (source, lang,
version) and writes these few rows; totals are sums over batches, so a batch never reads the corpus or an earlier batch.

Commits are idempotent. A batch is written to a folder of its own attempt; the commit is one file named after the batch,
created only if it does not exist yet, that names the attempt. A batch id that was committed before changes nothing,
whatever is sent with it; attempts that were never committed are not read. ``compact`` folds committed batches into one
snapshot batch whose commit file lists what it covers.

Counting reads whole texts in Arrow batches with a byte-pair vocabulary given by path (read once by the driver and
shipped, a fixed size) or counts words without Python.

Defined results: NULL and empty texts have 0 tokens and count as documents; NULL sources and languages are groups of
their own; a NULL version, operation or count in a change is an error; repeated changes in one batch all count (they are
separate documents); groups whose documents and tokens are both 0 are left out of totals. Other columns are not read.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator

import pandas as pd
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from demandgrid.llm.common import WORD, held, table
from demandgrid.llm.secrets import PIECES, parsed_ranks, read_ranks
from demandgrid.session import shared_path

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
KEYS = ["source", "lang", "version"]


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def token_count(spark: SparkSession, text: Column, vocabulary: str = VOCABULARY) -> Column:
    data = spark.sparkContext.broadcast(read_ranks(spark, vocabulary))

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoding = tiktoken.Encoding("counts", pat_str=PIECES, mergeable_ranks=parsed_ranks(data.value), special_tokens={})
        for texts in batches:
            yield pd.Series([len(encoding.encode_ordinary(t)) if t else 0 for t in texts], dtype="int64")

    return counted(text)


class Ledger:
    """Batches of signed totals in a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark = spark
        self.folder = folder or shared_path(spark, "token-ledger")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _commit_file(self, batch: str):
        if not re.fullmatch(r"[\w.-]+", batch):
            raise ValueError("a batch id consists of letters, digits, '_', '.' and '-'")
        return self._path(f"{self.folder}/commits/{batch}.json")

    def committed(self) -> dict[str, dict]:
        """Commit records by batch id."""
        folder = self._path(f"{self.folder}/commits")
        if not self._files.exists(folder):
            return {}
        records = {}
        for status in self._files.listStatus(folder):
            name = status.getPath().getName()
            if name.endswith(".json"):
                stream = self._files.open(status.getPath())
                try:
                    records[name[:-5]] = json.loads(bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
                finally:
                    stream.close()
        return records

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commit ``changes`` (op, source, lang, version, tokens, old_tokens, old_source, old_lang); False if the batch was
        committed before."""
        if self._files.exists(self._commit_file(batch)):
            return False
        attempt = f"{self.folder}/deltas/{batch}-{uuid.uuid4().hex}"
        self.signed(changes).write.parquet(attempt)
        return self._commit(batch, {"path": attempt, "covers": [batch]})

    def _commit(self, batch: str, record: dict) -> bool:
        try:
            stream = self._files.create(self._commit_file(batch), False)
        except Exception:
            if self._files.exists(self._commit_file(batch)):
                return False   # another writer was first
            raise
        stream.write(bytearray(json.dumps(record).encode()))
        stream.close()
        return True

    @staticmethod
    def signed(changes: DataFrame) -> DataFrame:
        """Signed documents and tokens of changes, summed in every task before the shuffle."""
        unknown = F.concat(F.lit("no valid change: "), F.to_json(F.struct("op", "version", "tokens", "old_tokens")))
        revise = F.col("op") == "revise"
        valid = F.col("version").isNotNull() & F.coalesce(F.col("op").isin("insert", "delete", "revise"), F.lit(False)) & (
            (F.col("op") == "delete") | F.col("tokens").isNotNull()) & ((F.col("op") == "insert") | F.col("old_tokens").isNotNull())
        plus = F.struct("source", "lang", "version", F.lit(1).cast("long").alias("docs"), F.col("tokens").cast("long").alias("tokens"))
        minus = F.struct(F.when(revise, F.col("old_source")).otherwise(F.col("source")).alias("source"),
                         F.when(revise, F.col("old_lang")).otherwise(F.col("lang")).alias("lang"), "version",
                         F.lit(-1).cast("long").alias("docs"), (-F.col("old_tokens")).cast("long").alias("tokens"))
        entries = (F.when(~valid, F.raise_error(unknown).cast("array<struct<source:string,lang:string,version:string,docs:bigint,tokens:bigint>>"))
                   .when(F.col("op") == "insert", F.array(plus)).when(F.col("op") == "delete", F.array(minus)).otherwise(F.array(plus, minus)))
        return changes.select(F.inline(entries)).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))

    def _live(self) -> list[str]:
        records = self.committed()
        covered = {b for name, r in records.items() for b in r["covers"] if b != name}
        return [r["path"] for name, r in sorted(records.items()) if name not in covered]

    def totals(self) -> DataFrame:
        paths = self._live()
        schema = "source string, lang string, version string, docs long, tokens long"
        rows = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        return (rows.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
                .filter("docs <> 0 OR tokens <> 0"))

    def compact(self, name: str) -> bool:
        """One snapshot batch in place of all committed ones; a snapshot is a commit like any other."""
        records = self.committed()
        if name in records:
            return False
        path = f"{self.folder}/deltas/{name}-{uuid.uuid4().hex}"
        self.totals().write.parquet(path)
        return self._commit(name, {"path": path, "covers": sorted({name, *records, *(b for r in records.values() for b in r["covers"])})})


def changes(df: DataFrame, op: str, tokens: Column | None = None, old_tokens: Column | None = None) -> DataFrame:
    """Changes of one kind for rows with source, lang and version that keep their group."""
    none = F.lit(None).cast("long")
    return df.select(F.lit(op).alias("op"), "source", "lang", "version", (none if tokens is None else tokens).alias("tokens"),
                     (none if old_tokens is None else old_tokens).alias("old_tokens"), F.col("source").alias("old_source"), F.col("lang").alias("old_lang"))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents inserted under two versions, then one revision and one deletion, each sent twice.

    The revision moves documents labelled toxic to the source "quarantine". The deletion takes other documents labelled
    as of low quality out of the byte-pair version.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    marks = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    counts = held(docs.select("doc_id", "source", "lang", word_count(F.col("text")).alias("words"),
                              token_count(spark, F.col("text")).alias("bytes")), "counts")
    versions = F.explode(F.array(F.struct(F.lit("words-1").alias("version"), F.col("words").alias("tokens")),
                                 F.struct(F.lit("byte-bpe-50k").alias("version"), F.col("bytes").alias("tokens")))).alias("v")

    def by_version(df: DataFrame) -> DataFrame:
        return df.select("doc_id", "source", "lang", versions).select("doc_id", "source", "lang", "v.*")

    toxic = counts.join(marks.filter("toxic = 1").select("doc_id"), "doc_id")
    low = counts.join(marks.filter("quality = 0 AND coalesce(toxic, 0) <> 1").select("doc_id"), "doc_id")
    moved = changes(by_version(toxic), "revise", F.col("tokens"), F.col("tokens")).withColumn("source", F.lit("quarantine"))
    gone = changes(by_version(low).filter("version = 'byte-bpe-50k'"), "delete", None, F.col("tokens"))
    ledger = Ledger(spark)
    ledger.apply("load", changes(by_version(counts), "insert", F.col("tokens")))
    for _ in range(2):
        ledger.apply("quarantine-toxic", moved)
        ledger.apply("drop-low-quality", gone)
    return ledger.totals()
