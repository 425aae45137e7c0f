"""Quality rules and robust multivariate outliers, with DataFrame operations only.

Rules: a text fails with fewer than 20 words, or with more than 30 % of its words in eight-word windows that occur twice.

Outliers: the texts that pass form cells by language and source; cells of fewer than ``LEAST_CELL`` texts are pooled by
language, and pools that are still smaller are pooled together. In each cell the minimum-covariance-determinant estimate
of five transformed statistics (``FEATURES``) is found by concentration steps: from medians and quartiles on, mean and
covariance are taken again and again over the three quarters of the texts with the least Mahalanobis distance, until the
determinants settle. A text is rejected when its squared distance exceeds ``cutoff``, the chi-square quantile that one
clean text in a million exceeds. ``FLOORS`` are least standard deviations, as symbols and repeated lines are absent from
most texts and a variance of nothing would reject every text that has one.

Quartiles in a step come from a mergeable sketch and moments from sums, so a hot cell is summed up in every task before
anything is shuffled. Estimates have one row a cell.

Defined results: a NULL, empty or blank text has no words and fails; NULL languages and sources are cells of their own;
in a last pool of fewer than ``LEAST_POOL`` texts there is no estimate and only the rules decide; repeated rows are
judged alike. Other columns pass through ``judged``; helper columns begin with an underscore.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from demandgrid.llm.common import held, table, words_of

WINDOW = 8
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED_PERCENT = 20, 30
LEAST_CELL, LEAST_POOL = 100, 20
SUBSET = 0.75
STEPS = 10
TAIL = 1e-6
#: Least standard deviation of each feature.
FLOORS = {"f_length": 0.3, "f_word": 0.06, "f_symbols": 0.05, "f_repeats": 0.1, "f_lines": 0.1}
FEATURES = list(FLOORS)


def let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once."""
    return F.transform(F.array(value), then)[0]


def repeated_words(words: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that occur twice or more, the first occurrence included."""

    def covered(places: Column) -> Column:
        last = F.size(places) - 1
        return F.aggregate(F.sequence(F.lit(0), last), F.lit(0).cast("long"), lambda total, i: total + F.when(
            i == last, WINDOW).otherwise(F.least(F.lit(WINDOW), F.get(places, i + 1) - F.get(places, i))))

    def places(ordered: Column) -> Column:
        same = lambda a, b: F.coalesce(F.get(ordered, a)["h"] == F.get(ordered, b)["h"], F.lit(False))
        kept = F.transform(ordered, lambda e, i: F.when(same(i, i - 1) | same(i, i + 1), e["i"]))
        return F.sort_array(F.filter(kept, lambda i: i.isNotNull()))

    def of_windows(windows: Column) -> Column:
        ordered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(
            let(let(ordered, places), covered))

    def of_hashes(hashes: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(1), F.size(hashes) - WINDOW + 1), lambda i: F.xxhash64(F.slice(hashes, i, WINDOW)))
        return F.when(F.size(hashes) < WINDOW, F.lit(0).cast("long")).otherwise(let(windows, of_windows))

    return let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def statistics(docs: DataFrame) -> DataFrame:
    """Counts of every whole text."""
    text = F.coalesce("text", F.lit(""))

    def of_words(words: Column) -> Column:
        return F.struct(F.size(words).cast("long").alias("n_words"), repeated_words(words).alias("n_repeat_words"))

    def of_lines(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("long").alias("n_lines"),
                        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    lines = F.filter(F.split(text, "\n", -1), lambda l: l.rlike(r"[^\x20\x09-\x0D]"))
    return (docs.withColumn("_words", let(words_of(F.col("text")), of_words)).withColumn("_lines", let(lines, of_lines))
            .withColumn("word_chars", F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long"))
            .withColumn("n_symbols", (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"))
            .select(*[c for c in docs.columns if c != "text"], "_words.*", "_lines.*", "word_chars", "n_symbols"))


def features() -> dict[str, Column]:
    """The statistics on scales where clean texts spread evenly; short texts are drawn towards the middle."""
    return {"f_length": F.log(F.col("n_words") + 1.0),
            "f_word": F.log((F.col("word_chars") + 200.0) / (F.col("n_words") + 40.0)),
            "f_symbols": F.sqrt(F.col("n_symbols") / (F.col("word_chars") + 40.0)),
            "f_repeats": F.sqrt(F.col("n_repeat_words") / (F.col("n_words") + 8.0)),
            "f_lines": F.col("n_dup_lines") / (F.col("n_lines") + 2.0)}


def chi_square(x: float, freedom: int) -> float:
    """Distribution function, by the series of the incomplete gamma function."""
    a, half = freedom / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-16:
        n += 1
        term *= half / n
        total += term
    return total * math.exp(-half + a * math.log(half) - math.lgamma(a)) if x > 0 else 0.0


def chi_square_quantile(p: float, freedom: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, freedom) < p else (low, middle)
    return low


def cutoff() -> float:
    return chi_square_quantile(1 - TAIL, len(FEATURES))


def consistency() -> float:
    """Makes the covariance of the innermost part of normal data that of all of it."""
    return SUBSET / chi_square(chi_square_quantile(SUBSET, len(FEATURES)), len(FEATURES) + 2)


def with_cells(passed: DataFrame) -> DataFrame:
    """``passed`` with ``_cell``, NULL where a text belongs to no cell that is large enough."""
    lang, source = (F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("")) for c in ("lang", "source"))
    keyed = passed.withColumn("_lang", lang).withColumn("_source", source)
    counts = held(keyed.groupBy("_lang", "_source").agg(F.count("*").alias("n")), "cell-sizes")
    small = counts.filter(F.col("n") < LEAST_CELL)
    by_lang = small.groupBy("_lang").agg(F.sum("n").alias("pool"))
    rest = by_lang.filter(F.col("pool") < LEAST_CELL).agg(F.coalesce(F.sum("pool"), F.lit(0)).alias("rest"))
    cell = (F.when(F.col("n") >= LEAST_CELL, F.to_json(F.array("_lang", "_source")))
            .when(F.col("pool") >= LEAST_CELL, F.to_json(F.array("_lang")))
            .when(F.lit(rest.first()[0] >= LEAST_POOL), F.lit("rest")))
    named = held(counts.join(by_lang, "_lang", "left").select("_lang", "_source", cell.alias("_cell")), "cells")
    return keyed.join(named, ["_lang", "_source"]).drop("_lang", "_source")


def _whitening(moments: DataFrame) -> DataFrame:
    """From m0..m4 and s00..s44: the inverse of the lower Cholesky factor, u00..u44, and the logarithm of the determinant."""
    size = range(len(FEATURES))
    for i in size:
        for j in range(i + 1):
            rest = F.col(f"s{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"c{i}{k}") * F.col(f"c{j}{k}")
            moments = moments.withColumn(f"c{i}{j}", F.sqrt(rest) if i == j else rest / F.col(f"c{j}{j}"))
    for j in size:
        for i in range(j, len(FEATURES)):
            if i == j:
                value = 1.0 / F.col(f"c{i}{i}")
            else:
                value = -sum((F.col(f"c{i}{k}") * F.col(f"u{k}{j}") for k in range(j, i)), F.lit(0.0)) / F.col(f"c{i}{i}")
            moments = moments.withColumn(f"u{i}{j}", value)
    log_det = sum((2 * F.log(f"c{i}{i}") for i in size), F.lit(0.0))
    return moments.select("_cell", *[f"m{i}" for i in size], *[f"u{i}{j}" for i in size for j in range(i + 1)], log_det.alias("log_det"))


def _distance() -> Column:
    total = F.lit(0.0)
    for i in range(len(FEATURES)):
        row = sum((F.col(f"u{i}{j}") * (F.col(FEATURES[j]) - F.col(f"m{j}")) for j in range(i + 1)), F.lit(0.0))
        total = total + F.pow(row, F.lit(2.0))
    return total


def estimates(cells: DataFrame) -> DataFrame:
    """Centre and whitening matrix of every ``_cell`` of ``cells`` (_cell and the features)."""
    size = range(len(FEATURES))
    quartiles = F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))
    start = cells.groupBy("_cell").agg(*[F.percentile_approx(f, quartiles, 1000).alias(f) for f in FEATURES])
    spread = {i: F.greatest(F.pow((F.col(f)[2] - F.col(f)[0]) / 1.349, F.lit(2.0)), F.lit(FLOORS[f] ** 2)) for i, f in enumerate(FEATURES)}
    state = held(_whitening(start.select("_cell", *[F.col(f)[1].alias(f"m{i}") for i, f in enumerate(FEATURES)],
                                         *[(spread[i] if i == j else F.lit(0.0)).alias(f"s{i}{j}") for i in size for j in range(i + 1)])), "mcd")
    scale = consistency()
    for _ in range(STEPS):
        near = cells.join(state, "_cell").select("_cell", *FEATURES, _distance().alias("d"))
        limits = held(near.groupBy("_cell").agg(F.percentile_approx("d", F.lit(SUBSET), 1000).alias("limit")), "mcd-limits")
        inner = near.join(limits, "_cell").filter("d <= limit")
        means = {i: F.avg(f) for i, f in enumerate(FEATURES)}
        moments = inner.groupBy("_cell").agg(*[means[i].alias(f"m{i}") for i in size], *[
            ((F.avg(F.col(FEATURES[i]) * F.col(FEATURES[j])) - means[i] * means[j]) * scale
             + (F.lit(FLOORS[FEATURES[i]] ** 2) if i == j else F.lit(0.0))).alias(f"s{i}{j}") for i in size for j in range(i + 1)])
        before, state = state, held(_whitening(moments), "mcd")
        moved = state.join(before.select("_cell", F.col("log_det").alias("before")), "_cell").filter(F.abs(F.col("before") - F.col("log_det")) > 1e-3)
        if moved.isEmpty():
            break
    return state


def judged(docs: DataFrame) -> DataFrame:
    """``docs`` without text, with the counts, ``base_failed``, the squared ``distance`` (NULL without estimate) and ``kept``."""
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    counted = held(statistics(docs).withColumn("base_failed", failed), "statistics")
    passed = with_cells(counted.filter(~F.col("base_failed")))
    for name, value in features().items():
        passed = passed.withColumn(name, value)
    passed = held(passed, "features")
    state = estimates(passed.filter("_cell IS NOT NULL").select("_cell", *FEATURES))
    measured = passed.join(state, "_cell", "left").withColumn("distance", _distance())
    columns = [*counted.columns, "distance"]
    return (measured.select(*columns).unionByName(counted.filter("base_failed").withColumn("distance", F.lit(None).cast("double")))
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff(), F.lit(True))))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                               "kept", "distance")
