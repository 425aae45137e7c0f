"""Mixing sources to target weights by entropy balancing, with DataFrame operations only.

Sources in code-point order (NULL last) weigh 3, 1, 2, repeating, and share 1.5 times all words; a target stops at twice
its source's size and what is left over is shared again by weight.

The document rates w that stay closest to 1 in relative entropy, do not exceed 2 and give every source its words solve a
convex problem. In its dual each source has one multiplier, and a rate is the exponential tilt

    w = min(2, exp(multiplier * size / mean size of the source)).

The dual gradient is the gap between taken and target words; safeguarded Newton steps (a bisection wherever a step leaves
the bracket) run for all sources at once, each step one aggregation over the distinct (source, size) pairs of the corpus.
Sums are taken over rounded integers, so their order does not matter and reruns agree to the last bit.

Rates become copies by systematic rounding: going through a source by falling size, the extra copies of each size are
the whole steps of the running sum of fractional rates; inside a size they are dealt to lanes of documents and, in a
lane, to the documents of smallest hash. No window holds more than the sizes of a source, the lanes of a size, or the
documents of a lane.

Defined results: a NULL, empty or blank text has size 0 and takes 0 words; NULL is a source of its own, named last;
repeated rows are separate documents; a source without words has target 0; an empty table gives an empty result. Other
columns pass through ``mix``; helper columns begin with an underscore.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from demandgrid.llm.common import WORD, held, table

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
LANES = 4_096
STEPS = 80
TOLERANCE = 1e-9
UNIT = 1_000_000   # fractional rates are counted in this many parts


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _source_key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source), F.lit(""))


def source_targets(cells: DataFrame) -> DataFrame:
    """``_s``, ``source_size`` and ``target`` of every source; one row per source is all that is ordered here."""
    totals = cells.groupBy("_s").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("docs"), F.min(F.when(F.col("size") > 0, F.col("size"))).alias("least"))
    place = F.row_number().over(W.orderBy((F.col("_s") == "").cast("int"), "_s")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (place % len(WEIGHTS) + 1).cast("int"))
    ranked = held(totals.withColumn("weight", weight), "sources")
    most = F.col("source_size") * float(MOST_COPIES)
    budget = SHARE * float(ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, before = 0.0, -1.0
    while level != before:
        full = most <= F.col("weight") * level
        row = ranked.agg(F.sum(F.when(full, most).otherwise(0.0)).alias("fixed"), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open")).first()
        before, level = level, max(level, (budget - row["fixed"]) / row["open"]) if row["open"] else level
    return ranked.withColumn("target", F.least(most, F.col("weight") * level))


def _rate(multiplier: Column, x: Column) -> Column:
    return F.least(F.lit(float(MOST_COPIES)), F.exp(multiplier * x))


def multipliers(cells: DataFrame, targets: DataFrame) -> DataFrame:
    """``targets`` with the ``multiplier`` of every source that has words and a target strictly inside (0, 2 x size)."""
    mean = F.col("source_size") / F.col("docs")
    lowest = F.col("least") / mean
    inside = targets.filter((F.col("target") > 0) & (F.col("target") < F.col("source_size") * float(MOST_COPIES)))
    state = held(inside.select("_s", "source_size", "target", mean.alias("mean"), F.lit(0.0).alias("multiplier"),
                               (F.least(F.lit(0.0), F.log(F.col("target") / F.col("source_size"))) / lowest - 1e-6).alias("low"),
                               (F.log(F.lit(float(MOST_COPIES))) / lowest).alias("high")), "dual")
    x, rate = F.col("size") / F.col("mean"), _rate(F.col("multiplier"), F.col("size") / F.col("mean"))
    words = F.col("n") * F.col("size")
    for _ in range(STEPS):
        sums = (cells.filter("size > 0").join(state.select("_s", "mean", "multiplier"), "_s").groupBy("_s").agg(
            F.sum(F.round(words * rate * 1000).cast("long")).alias("taken"),
            F.sum(F.when(rate < float(MOST_COPIES), F.round(words * x * rate).cast("long")).otherwise(0)).alias("slope")))
        gap = F.col("taken") / 1000 - F.col("target")
        low = F.when(gap < 0, F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("multiplier")).otherwise(F.col("high"))
        step = F.col("multiplier") - gap / F.col("slope")
        state = held(state.join(sums, "_s").withColumn("gap", gap).withColumn("low", low).withColumn("high", high)
                     .withColumn("step", F.when(F.col("slope") > 0, step))
                     .withColumn("multiplier", F.when(F.abs("gap") <= TOLERANCE * F.col("target") + 0.01, F.col("multiplier"))
                                 .when(F.col("step").between(F.col("low"), F.col("high")), F.col("step"))
                                 .otherwise((F.col("low") + F.col("high")) / 2))
                     .select("_s", "source_size", "target", "mean", "multiplier", "low", "high", "gap"), "dual")
        far = (F.abs("gap") > TOLERANCE * F.col("target") + 0.01) & (F.col("high") - F.col("low") > 1e-12 * F.abs("high"))
        if state.filter(far).isEmpty():
            break
    return targets.join(state.select("_s", "mean", "multiplier"), "_s", "left")


def mix(rows: DataFrame, sized: DataFrame) -> DataFrame:
    """``rows`` (doc_id, source, size, ...) with source_size, target and copies; ``sized`` has the same rows' three columns."""
    lane = F.pmod(F.xxhash64("doc_id"), F.lit(LANES)).cast("int")
    laned = held(sized.withColumn("_s", _source_key(F.col("source"))).withColumn("lane", lane)
                 .groupBy("_s", "size", "lane").agg(F.count("*").alias("n")), "lanes")
    cells = held(laned.groupBy("_s", "size").agg(F.sum("n").alias("n")), "cells")
    solved = multipliers(cells, source_targets(cells))
    full = F.col("multiplier").isNull()
    rate = F.when(full, F.when(F.col("target") > 0, float(MOST_COPIES)).otherwise(0.0)).otherwise(
        _rate(F.col("multiplier"), F.col("size") / F.col("mean")))
    parts = F.when(F.col("size") > 0, F.round(rate * UNIT).cast("long")).otherwise(F.lit(0))
    in_source = W.partitionBy("_s").orderBy(F.desc("size")).rowsBetween(W.unboundedPreceding, -1)
    rated = (cells.join(solved.select("_s", "source_size", "target", "mean", "multiplier"), "_s")
             .withColumn("base", F.floor(parts / UNIT).cast("long")).withColumn("part", parts - F.col("base") * UNIT)
             .withColumn("start", F.coalesce(F.sum(F.col("n") * F.col("part")).over(in_source), F.lit(0)))
             .select("_s", "size", "source_size", "target", "base", "part", "start"))
    in_size = W.partitionBy("_s", "size").orderBy("lane").rowsBetween(W.unboundedPreceding, -1)

    dealt = (laned.withColumn("before", F.coalesce(F.sum("n").over(in_size), F.lit(0))).join(rated, ["_s", "size"])
             .withColumn("_from", F.col("start") + F.col("before") * F.col("part"))
             .withColumn("extra", F.expr(f"(_from + n * part + {UNIT // 2}) div {UNIT} - (_from + {UNIT // 2}) div {UNIT}"))
             .select("_s", F.col("size").alias("_size"), F.col("lane").alias("_lane"), "source_size", "target", "base", "extra"))
    held_rows = rows.withColumn("_s", _source_key(F.col("source"))).withColumn("_lane", lane).withColumn("_size", F.col("size"))
    in_lane = W.partitionBy("_s", "_size", "_lane").orderBy(F.xxhash64("doc_id"), "doc_id")
    return (held_rows.join(held(dealt, "dealt"), ["_s", "_size", "_lane"])
            .withColumn("copies", F.col("base") + (F.row_number().over(in_lane) <= F.col("extra")).cast("long"))
            .drop("_s", "_size", "_lane", "base", "extra"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = held(docs.select("doc_id", "source", size_of(F.col("text")).alias("size")), "sized")
    return mix(sized, sized).select("doc_id", "size", "source_size", "target",
                                    (F.col("copies") * F.col("size")).alias("taken"), "copies")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, numbered by ``copy``."""
    packed = docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), F.struct(*docs.columns).alias("_row"))
    sized = held(packed.select("doc_id", "source", "size"), "sized")
    mixed = mix(packed, sized).filter("copies > 0")
    copy = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    name = "copy" if "copy" not in docs.columns else "_copy"
    return mixed.withColumn("_n", copy).select("_row.*", F.col("_n").alias(name))
