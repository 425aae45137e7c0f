"""Hand tables for the corpus operators: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(seed: int, count: int) -> str:
    return " ".join(f"{WORDS[(seed * 7 + i * i * 3 + i * seed) % len(WORDS)]}{(seed * 31 + i * 17) % 97}" for i in range(count))


def odd_documents(spark):
    long_text = prose(1, 4000)
    near = prose(2, 200)
    rows = [
        (1, prose(3, 60), "en", "a"), (2, prose(3, 60), "en", "a"), (2, prose(3, 60), "en", "a"), (3, None, "en", "a"),
        (4, "", "en", None), (5, "   \n ", None, "b"), (None, prose(3, 60), "en", "b"), (None, None, None, None),
        (6, near, "fr", "b"), (7, near.replace("alpha", "ALPHA", 1) + " end", "fr", "b"), (8, long_text, "de", "c"),
        (9, long_text + " tail", "de", "c"), (10, "short text", "en", "c"), (11, "short text", "en", "c"), (12, prose(5, 90), "en", "\x80"),
        (12, prose(6, 90), "en", "é"), (-3, "naïve ünïcode 😀 " * 30, "en", "a")]
    return spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows], SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def with_clashes(docs):
    """Columns whose names the operators use themselves."""
    for name in ("score", "label", "key", "size", "copies", "uid", "_row", "count", "value", "copy"):
        docs = docs.withColumn(name, F.lit(f"mine-{name}"))
    return docs


def stored(df, folder, name="documents"):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
