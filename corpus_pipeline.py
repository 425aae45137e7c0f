"""The corpus pipeline: rejects toxic documents, then removes near copies and benchmark passages, hides personal data
and mixes the sources to their target weights. Every stage works on all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from demandgrid.llm import decontamination, mixing, near_dedup, pii, toxicity
from demandgrid.llm.common import held, table

STAGES = [
    ("toxicity", toxicity.stage),
    ("minhash near-dedup", near_dedup.stage),
    ("benchmark decontamination", decontamination.stage),
    ("personal data", pii.stage),
    ("mixing to target weights", mixing.stage),
]

#: Nearest neighbours, sketches, edit distances and Newton steps are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = held(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
