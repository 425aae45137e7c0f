"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles.

A document is the multiset of its five-word shingles (lower case, words split at ASCII blanks; a shorter text is one
shingle of all its words). A shingle weighs its count times the mean inverse document frequency of its words. The
frequencies are counted over all documents in ``IDF_BUCKETS`` hash buckets of words, so the table that every task reads
has a fixed size at any corpus size. (Frequencies of whole shingles would make the weight of a text depend on how many
copies it has: in a group of 2,000 near copies every edited shingle would outweigh the shared ones.)

1. Equal texts are one content, named by a digest; later steps see each content once, so copies cost nothing more.
2. Every content gets ``BANDS * ROWS`` weighted samples. Contents that agree on a whole band are candidates; at a
   weighted Jaccard similarity of 0.8 one in 550 pairs is missed, at 0.85 one in 6,500.
3. In every bucket all contents are compared with the smallest one, linear in the bucket. Pairs with at least
   ``LEAST_ESTIMATE`` equal samples are verified by their exact weighted Jaccard similarity and linked.
4. Buckets whose contents still lie in different classes then compare all contents of different classes, in blocks, so
   no link between different texts that share a band is lost. A block computes all its similarities at once and emits no
   more links than join its classes.
5. Classes are connected components, by labels that move along links and jump over labels.

A class is named by its smallest ``doc_id``.

Defined results: NULL, empty and blank texts have no shingle and are a class of their own each (of their ``doc_id``). A
NULL ``doc_id`` takes part by its content; the class name skips it. Repeated rows are copies. Any text length is read
whole. Other columns are not read; ``stage`` returns them unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from demandgrid.llm.common import content_key, held, table

SHINGLE_WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 12, 4
LEAST_ESTIMATE = 0.6
IDF_BUCKETS = 1 << 18
BLOCK_MEMBERS = 500
COLUMNS = 4_096
TABLE_BITS = 13
CHUNK = 256
PART = 1 << 17
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                        0x85EBCA77C2B2AE63], np.uint64)


class WordHashes:
    """64-bit hashes of the words of a text, in lower case, computed for all bytes at once.

    With running sums of ``byte * base ** place`` the difference over a word, divided by ``base ** start``, depends on its
    bytes alone. Long texts are worked off in parts that end at a blank.
    """

    def __init__(self):
        base = 0x9E3779B97F4A7C15
        self.powers, self.inverses = np.full(PART + 1, base, np.uint64), np.full(PART + 1, pow(base, -1, 1 << 64), np.uint64)
        for powers in (self.powers, self.inverses):
            powers[0] = 1
            np.cumprod(powers, out=powers)
        self.blank = np.zeros(256, bool)
        self.blank[[9, 10, 11, 12, 13, 32]] = True

    def of(self, text: str | None) -> np.ndarray:
        data = (text or "").lower().encode()
        found, at = [], 0
        while at < len(data):
            end = len(data)
            if end - at > PART:
                end = 1 + max((data.rfind(c, at, at + PART) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")), default=-1)
                end = end if end > at else at + PART   # a word longer than a part counts as several
            found.append(self._part(np.frombuffer(data, np.uint8, end - at, at)))
            at = end
        return np.concatenate(found) if found else np.zeros(0, np.uint64)

    def _part(self, data: np.ndarray) -> np.ndarray:
        inside = np.zeros(len(data) + 2, np.int8)
        inside[1:-1] = ~self.blank[data]
        edge = np.diff(inside)
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * self.powers[:len(data)], out=sums[1:])
        return mixed(mixed((sums[end] - sums[start]) * self.inverses[start]))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(33))


def shingle_counts(words: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes ascending, the mean word frequency weight of each, and how often each occurs."""
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0, np.float32), np.zeros(0, np.int64)
    size = min(SHINGLE_WORDS, len(words))
    count = len(words) - size + 1
    value = idf[(words >> np.uint64(46)).astype(np.int64)]
    hashes, weight = np.full(count, size, np.uint64), np.zeros(count, np.float32)
    for i in range(size):
        hashes = hashes * MULTIPLIERS[i] + words[i:i + count]
        weight += value[i:i + count]
    shingles, first, times = np.unique(mixed(hashes), return_index=True, return_counts=True)
    return shingles, weight[first] / np.float32(size), times


def shingle_weights(words: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes ascending and their weights."""
    shingles, weight, times = shingle_counts(words, idf)
    return shingles, weight * times.astype(np.float32)


class Sampler:
    """Consistent weighted samples; the random variables of a shingle are read from fixed tables by its hash.

    A shingle of weight S has ln a = ln c - r (t - beta + 1) with t = floor(ln S / r + beta), and the smallest a wins. As
    r (t - beta) <= ln S, ln a is at least ln c - r - ln S: only shingles whose bound is within the value of the shingle
    of least bound are computed in full.
    """

    def __init__(self, samples: int = BANDS * ROWS):
        rng = np.random.Generator(np.random.PCG64(20_241))
        size = 1 << TABLE_BITS
        self.r = rng.gamma(2.0, 1.0, size).astype(np.float32)
        self.log_c = np.log(rng.gamma(2.0, 1.0, size)).astype(np.float32)
        self.beta = rng.random(size).astype(np.float32)
        self.bound = self.log_c - self.r
        self.odd = (rng.integers(1 << 31, size=samples, dtype=np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
        self.turn = rng.integers(1 << 32, size=samples, dtype=np.uint64).astype(np.uint32)[:, None]

    def exact(self, at: np.ndarray, log_weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        r, beta = self.r[at], self.beta[at]
        steps = np.floor(log_weight / r + beta)
        return self.log_c[at] - r * (steps - beta + np.float32(1)), steps

    def sample(self, shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One 64-bit value per sample: equal with the probability of the weighted Jaccard similarity."""
        samples = np.arange(len(self.odd))
        best = np.full(len(samples), np.inf, np.float32)
        chosen = np.zeros(len(samples), np.uint64)
        high = (shingles >> np.uint64(32)).astype(np.uint32)
        logs = np.log(weights).astype(np.float32)
        for a in range(0, len(shingles), CHUNK):
            at = (((self.turn ^ high[a:a + CHUNK]) * self.odd) >> np.uint32(32 - TABLE_BITS)).astype(np.intp)
            log_weight = logs[a:a + CHUNK]
            bound = np.take(self.bound, at, mode="clip")
            bound -= log_weight
            lowest = bound.argmin(axis=1)
            limit, _ = self.exact(at[samples, lowest], log_weight[lowest])
            j, i = np.nonzero(bound <= np.minimum(limit, best)[:, None] + np.float32(1e-4))
            value, steps = self.exact(at[j, i], log_weight[i])
            order = np.lexsort((i, value, j))
            first = order[np.r_[True, j[order][1:] != j[order][:-1]]] if len(order) else order
            first = first[value[first] < best[j[first]]]
            best[j[first]] = value[first]
            chosen[j[first]] = mixed(shingles[a:a + CHUNK][i[first]] + steps[first].astype(np.int64).astype(np.uint64)
                                     * np.uint64(0x9E3779B97F4A7C15))
        return chosen


def band_values(samples: np.ndarray) -> np.ndarray:
    """One 64-bit value per band, different bands never meant to meet."""
    value = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for row in samples.reshape(BANDS, ROWS).T:
        value = mixed(value * np.uint64(0xC2B2AE3D27D4EB4F) + row)
    return value.view(np.int64)


def word_idf(docs: DataFrame) -> np.ndarray:
    """Smoothed inverse document frequency per hash bucket of words, over all documents."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, seen, rows = WordHashes(), np.zeros(IDF_BUCKETS, np.int64), 0
        for batch in batches:
            rows += len(batch)
            for text in batch["text"]:
                seen[np.unique((hashes.of(text) >> np.uint64(46)).astype(np.int32))] += 1
        at = np.flatnonzero(seen)
        yield pd.DataFrame({"bucket": np.append(at, -1), "n": np.append(seen[at], rows)})

    found = docs.select("text").mapInPandas(counted, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    buckets, counts = found["bucket"].to_numpy(), found["n"].to_numpy()
    df, rows = np.zeros(IDF_BUCKETS), counts[buckets < 0].sum()
    df[buckets[buckets >= 0]] = counts[buckets >= 0]
    return (1 + np.log((1 + rows) / (1 + df))).astype(np.float32)


def sketches(docs: DataFrame, idf: np.ndarray) -> DataFrame:
    """Samples and band values of every distinct content that has a word."""
    # IDF_BUCKETS floats: a fixed size
    shipped = docs.sparkSession.sparkContext.broadcast(idf)

    def sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, sampler, rows = WordHashes(), Sampler(), []
        for batch in batches:
            rows = []
            for key, text in zip(batch["key"], batch["text"]):
                shingles, weights = shingle_weights(hashes.of(text), shipped.value)
                if len(shingles):
                    samples = sampler.sample(shingles, weights)
                    rows.append((key, samples.astype(np.uint32).tobytes(), band_values(samples)))
            yield pd.DataFrame(rows, columns=["key", "sketch", "bands"])

    return (docs.select(content_key(F.col("text")).alias("key"), "text").filter("key IS NOT NULL")
            .mapInPandas(sketched, "key binary, sketch binary, bands array<long>").dropDuplicates(["key"]))


@F.pandas_udf(T.DoubleType())
def equal_samples(a: pd.Series, b: pd.Series) -> pd.Series:
    size = BANDS * ROWS
    left, right = (np.frombuffer(b"".join(s), np.uint32).reshape(-1, size) for s in (a, b))
    return pd.Series((left == right).mean(axis=1), dtype="float64")


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    total = float(a[1].sum(dtype=np.float64) + b[1].sum(dtype=np.float64))
    _, at, bt = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = float(np.minimum(a[1][at], b[1][bt]).sum(dtype=np.float64))
    return shared / (total - shared) if total > shared else 1.0


def verified(pairs: DataFrame, texts: DataFrame, idf: np.ndarray, least: float) -> DataFrame:
    """Pairs (a, b) whose exact weighted Jaccard similarity is at least ``least``."""
    shipped = pairs.sparkSession.sparkContext.broadcast(idf)

    @F.pandas_udf("double")
    def similarity(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        hashes = WordHashes()
        last: tuple[str, tuple] = ("", (np.zeros(0, np.uint64), np.zeros(0, np.float32)))
        for left, right in batches:
            values = []
            for a, b in zip(left, right):
                if a != last[0]:
                    last = (a, shingle_weights(hashes.of(a), shipped.value))
                values.append(weighted_jaccard(last[1], shingle_weights(hashes.of(b), shipped.value)))
            yield pd.Series(values, dtype="float64")

    with_a = pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a")
    both = with_a.join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")
    return both.withColumn("similarity", similarity("text_a", "text_b")).filter(F.col("similarity") >= least).select("a", "b")


def components(links: DataFrame, name: str) -> DataFrame:
    """Every node of ``links`` (a, b) with the smallest node of its connected component as ``label``."""
    both = held(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), f"{name}-links")
    labels = held(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("label")), f"{name}-labels")
    while True:
        near = (both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near")))
        lower = (labels.join(near, F.col("node") == F.col("a"))
                 .select("node", F.col("label").alias("before"), F.least("label", "near").alias("label")))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("beyond"))
        after = held(lower.join(jump, "label", "left")
                     .select("node", "before", F.least("label", F.coalesce("beyond", "label")).alias("label")), f"{name}-labels")
        labels = after.select("node", "label")
        if after.filter(F.col("before") != F.col("label")).isEmpty():
            return labels


def layered(text: str | None, hashes: WordHashes, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingles one by one: the n-th occurrence of a shingle is an element of its own, so that the shared weight of two
    texts is that of their common elements."""
    shingles, weight, times = shingle_counts(hashes.of(text), idf)
    nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    return mixed(np.repeat(shingles, times) + nth.astype(np.uint64)), np.repeat(weight, times)


def similarities(texts: list[str], hashes: WordHashes, idf: np.ndarray) -> np.ndarray:
    """Exact weighted Jaccard similarities of all texts of a block, over the elements that at least two of them have."""
    sets = [layered(t, hashes, idf) for t in texts]
    sums = np.array([w.sum(dtype=np.float64) for _, w in sets])
    rows = np.repeat(np.arange(len(sets)), [len(e) for e, _ in sets])
    elements, column, count = np.unique(np.concatenate([e for e, _ in sets]), return_inverse=True, return_counts=True)
    weight = np.zeros(len(elements))
    weight[column] = np.concatenate([w for _, w in sets])
    place = np.cumsum(count > 1) - 1
    common = count[column] > 1
    rows, column, weight = rows[common], place[column[common]], weight[count > 1]
    shared = np.zeros((len(sets), len(sets)))
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    for low in range(0, len(weight), COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        part = np.zeros((len(sets), min(COLUMNS, len(weight) - low)))
        part[rows[a:b], column[a:b] - low] = 1.0
        shared += (part * weight[low:low + COLUMNS]) @ part.T
    return shared / np.maximum(sums[:, None] + sums[None, :] - shared, 1e-12)


def joining_links(linked: np.ndarray, label: np.ndarray) -> list[tuple[int, int]]:
    """Links (row, column) of a matrix that join different labels, no more than are needed to join all they can."""
    label, found = label.copy(), []
    for x in range(len(label)):
        near = np.flatnonzero(linked[x] & (label != label[x]))
        others, first = np.unique(label[near], return_index=True)
        found += [(x, int(near[i])) for i in first]
        label[np.isin(label, others)] = label[x]
    return found


def numbered(labels: pa.ChunkedArray) -> np.ndarray:
    """A number for each different label."""
    return labels.combine_chunks().dictionary_encode().indices.to_numpy()


def near_other_classes(samples: np.ndarray, label: np.ndarray, least: float) -> np.ndarray:
    """Which rows agree with a row of another label in at least ``least`` of their samples. Every such pair has a row outside the
    largest class, so the others need not ask."""
    kept = np.zeros(len(label), bool)
    for x in np.flatnonzero(label != np.bincount(label).argmax()):
        # eight comparisons lie in one number: no byte of the sum overflows, and the product adds them up in the highest one
        equal = (samples == samples[x]).view(np.uint64).sum(axis=1, dtype=np.uint64) * np.uint64(0x0101010101010101) >> np.uint64(56)
        hits = (label != label[x]) & (equal / samples.shape[1] >= least)
        hits[x] = hits.any()
        kept |= hits
    return kept


def across_classes(members: DataFrame, labels: DataFrame, sketch: DataFrame, texts: DataFrame, idf: np.ndarray, least: float,
                   estimate: float) -> DataFrame:
    """Links (a, b) between classes within buckets, from blocks of bounded size.

    Samples tell which members of a block come near a member of another class; only their texts are compared, exactly
    and all at once.
    """
    classed = (members.join(labels, F.col("key") == F.col("node"), "left")
               .select("value", "key", F.coalesce("label", "key").alias("label")))
    open_buckets = (classed.groupBy("value").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("n"))
                    .filter("low <> high").select("value", "n"))
    parts = F.ceil(F.col("n") / BLOCK_MEMBERS).cast("int")
    own = F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")
    # a member meets every part of its bucket once: one block for nearly all buckets
    blocks = (classed.join(open_buckets, "value").withColumn("parts", parts).withColumn("own", own)
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
              .select("value", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "key", "label")
              .join(sketch.select("key", "sketch"), "key"))
    shipped = members.sparkSession.sparkContext.broadcast(idf)
    schema = "value long, i int, j int, own int, key binary, label binary"

    def near(block: pa.Table) -> pa.Table:
        samples = np.frombuffer(b"".join(block["sketch"].to_pylist()), np.uint32).reshape(-1, BANDS * ROWS)
        return block.filter(pa.array(near_other_classes(samples, numbered(block["label"]), estimate))).select(["value", "i", "j", "own", "key", "label"])

    tables: list[WordHashes] = []   # made once in a task, for all its blocks

    def linked(block: pa.Table) -> pa.Table:
        if not tables:
            tables.append(WordHashes())
        own, keys = block["own"].to_numpy(), block["key"].to_pylist()
        i, j = block["i"][0].as_py(), block["j"][0].as_py()
        meets = np.equal.outer(own, own) if i == j else np.not_equal.outer(own, own)
        links = joining_links((similarities(block["text"].to_pylist(), tables[0], shipped.value) >= least) & meets, numbered(block["label"]))
        return pa.table({"a": pa.array([min(keys[a], keys[b]) for a, b in links], pa.binary()),
                         "b": pa.array([max(keys[a], keys[b]) for a, b in links], pa.binary())})

    held_blocks = held(blocks.groupBy("value", "i", "j").applyInArrow(near, schema), "open-blocks", free=True)
    return (held_blocks.join(texts, "key").groupBy("value", "i", "j").applyInArrow(linked, "a binary, b binary").distinct())


def classes(docs: DataFrame, least: float = SIMILARITY, estimate: float = LEAST_ESTIMATE) -> DataFrame:
    """Column ``key`` of every content that has links, and ``label``, the smallest key of its class."""
    idf = word_idf(docs)
    sketch = held(sketches(docs, idf), "sketches", free=True)
    bands = sketch.select("key", F.explode("bands").alias("value"))
    shared = bands.groupBy("value").agg(F.min("key").alias("hub"), F.count("*").alias("n")).filter("n > 1").select("value", "hub")
    members = held(bands.join(shared, "value"), "members", free=True)
    hub_pairs = members.filter("key <> hub").select(F.col("hub").alias("a"), F.col("key").alias("b")).distinct()
    side = sketch.select("key", "sketch")
    hub_pairs = (hub_pairs.join(side.select(F.col("key").alias("a"), F.col("sketch").alias("x")), "a")
                 .join(side.select(F.col("key").alias("b"), F.col("sketch").alias("y")), "b")
                 .filter(equal_samples("x", "y") >= estimate).select("a", "b"))
    hub_pairs = held(hub_pairs, "pairs")
    involved = members.select("key").distinct()
    # copies meet in the partial aggregate, before any shuffle
    texts = held(docs.select(content_key(F.col("text")).alias("key"), "text").groupBy("key").agg(F.first("text").alias("text"))
                 .join(involved, "key", "left_semi"), "texts", free=True)
    links = held(verified(hub_pairs, texts, idf, least), "links", free=True)
    labels = components(links, "hubs")
    late = held(across_classes(members.select("value", "key"), labels, sketch, texts, idf, least, estimate), "late-links", free=True)
    if late.isEmpty():
        return labels.select(F.col("node").alias("key"), "label")
    return components(links.union(late), "all").select(F.col("node").alias("key"), "label")


def near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``doc_id`` and ``class_id`` of every row of ``docs`` (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    found = classes(docs, least)
    blank = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", "")) == ""
    keyed = docs.select("doc_id", F.when(~blank, content_key(F.col("text"))).alias("key"))
    labelled = held(keyed.join(found, "key", "left").select("doc_id", F.coalesce("label", "key").alias("label")), "labelled")
    names = labelled.filter("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("first"))
    return labelled.join(names, "label", "left").select("doc_id", F.coalesce("first", "doc_id").alias("class_id"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest ``doc_id`` of each class. Rows without ``doc_id`` are kept, as no other can stand
    for them by name; of rows that repeat the id of a kept document in full, one stays."""
    found = held(near_duplicates(docs), "classes")
    later = held(found.filter("doc_id <> class_id").select(F.col("doc_id").alias("_later")).distinct(), "later")
    kept = docs.join(later, F.col("doc_id") == F.col("_later"), "left_anti")
    repeated = held(found.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("_twice")), "twice")
    if repeated.isEmpty():
        return kept
    single = kept.join(repeated, F.col("doc_id") == F.col("_twice"), "left_anti")
    again = kept.join(repeated, F.col("doc_id") == F.col("_twice"), "left_semi").dropDuplicates(["doc_id", "text"])
    return single.unionByName(again)
