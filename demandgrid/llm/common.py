"""What the corpus operators share: reading tables, words, content keys and batch sizes."""

from __future__ import annotations

import gc
import time

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from demandgrid.session import written

#: A word is a run of characters other than blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"

#: Rows per Arrow batch: with very long texts a batch of the default 10,000 rows would not fit a worker.
BATCH_ROWS = 500
BATCH_BYTES = 16 << 20


def settle(spark: SparkSession) -> None:
    """Settings that the operators rely on for bounded memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    settle(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def content_key(text: Column) -> Column:
    """16 bytes that stand for a whole text, so that rows without a usable id can be told apart."""
    return F.unhex(F.md5(text.cast("binary")))


def words_of(text: Column) -> Column:
    """Array of all words of a whole text; a NULL text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def held(df: DataFrame, name: str, free: bool = False) -> DataFrame:
    """Write to the shared folder and read back, so that loops do not carry their whole past.

    Spark drops the shuffle files of a finished job once the driver has collected its garbage, by default every half
    hour. After a step with large shuffles ``free`` asks for that at once.
    """
    result = written(df, f"llm-{name}")
    if free:
        for _ in range(2):   # the first round lets go of the plans, the second of their shuffles
            gc.collect()
            df.sparkSession.sparkContext._jvm.System.gc()
            time.sleep(0.5)
    return result
