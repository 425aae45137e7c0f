"""Seeded samples that do not depend on partitioning: a row is kept for its key, not for its place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

DIGITS_PER_STEP = 4
RANKED_ROWS = 100_000


def key_digest(keys: list[str], seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keys]))


def sample_fraction(df: DataFrame, fraction: float, keys: list[str], seed: int = 42) -> DataFrame:
    """Keep about ``fraction`` of the rows: a filter, no shuffle."""
    if fraction >= 1:
        return df
    bound = format(int(fraction * 2**32), "08x")
    return df.filter(F.substring(key_digest(keys, seed), 1, 8) < bound)


def sample_rows(df: DataFrame, n: int, keys: list[str], seed: int = 42, ranked: int = RANKED_ROWS) -> DataFrame:
    """Keep the ``n`` rows with the smallest key digest, all of them if there are no more.

    Counts by the first digits of the digest tell which bucket holds the n-th row. A bucket with more than
    ``ranked`` rows is cut by its next digits. Everything below the bucket passes by filter and only the bucket
    is ranked, so ``n`` may be far beyond what one task can sort. The keys are those of a unique row.
    """
    marked = df.withColumn("_digest", key_digest(keys, seed))
    prefix, left = _boundary(marked, n, ranked)
    if prefix is None:
        return df
    start = F.substring("_digest", 1, len(prefix))
    whole = marked.filter(start < prefix)
    part = marked.filter(start == prefix).orderBy("_digest", *keys).limit(left)
    return whole.unionByName(part).drop("_digest")


def _boundary(marked: DataFrame, n: int, ranked: int) -> tuple[str | None, int]:
    """First digits of the n-th row's bucket and how many of its rows are needed. A step brings back at most
    65,536 counts."""
    left, prefix, size = n, "", None
    while size is None or (size > ranked and len(prefix) < 32):
        inside = marked.filter(F.substring("_digest", 1, len(prefix)) == prefix) if prefix else marked
        counts = inside.groupBy(F.substring("_digest", 1, len(prefix) + DIGITS_PER_STEP).alias("b")).count().collect()
        for bucket, size in sorted(map(tuple, counts)):
            if size > left:
                prefix = bucket
                break
            left -= size
        else:
            return None, 0
    return prefix, left
