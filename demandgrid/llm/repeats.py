"""Long repeats by longest-previous-factor arrays: later copies of 100-byte strings go, the first stays.

The order of texts is that of ``doc_id`` (NULL last), then of the place inside a document. A byte goes if a string of
``LENGTH`` bytes that covers it also starts earlier. One suffix array over a whole corpus cannot be dealt out, but a
longest previous factor of at least ``LENGTH`` bytes depends only on suffixes that agree in their first ``LENGTH``
bytes, so any dealing that keeps those together will do:

1. Equal texts are one content; all but its first document are later copies and go wholly.
2. In every window of ``LENGTH`` bytes the ``GRAM``-byte string of smallest hash is its anchor. Equal windows have equal
   anchors, and about one byte in 35 is an anchor. Anchors that occur once in the corpus cannot lie in a repeat.
3. The windows of each repeated anchor are sent, as one short string, to the task that owns the anchor. Equal strings are
   summed up before: of these all but the first occurrence go, however many there are.
4. A task sorts the suffixes of its strings by their first ``LENGTH`` bytes. In suffix order the previous and the next
   suffix of smaller text position within an equal run tell whether a suffix has an earlier match of that length.
5. Anchors with more than ``CROWDED`` different strings (a common line in different surroundings) would load one task;
   their windows are dealt out one by one, by their own bytes, and summed up the same way.

Bytes are compared throughout; hashes only deal work out.

Defined results: a NULL or empty text has no bytes, nothing is removed; texts shorter than ``LENGTH`` stay; documents
with NULL ids come last; rows that repeat an id and a text are one document and get one result each; different texts under
one id follow each other in the order of a hash. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from demandgrid.llm.common import content_key, held, table

LENGTH = 100
GRAM = 32
CROWDED = 5_000
CHUNK = 1 << 20
GATHER = 2 << 20
FEW_ROWS = 20_000
LAST = (1 << 63) - 1


class Anchors:
    """Anchor of every window of a text, by a rolling hash over chunks of bounded size."""

    def __init__(self):
        base = 0x9E3779B97F4A7C15
        inverse = pow(base, -1, 1 << 64)
        size = CHUNK + LENGTH + 1
        self.powers, self.inverses = np.ones(size, np.uint64), np.ones(size, np.uint64)
        self.powers[1:], self.inverses[1:] = np.uint64(base), np.uint64(inverse)
        np.cumprod(self.powers, out=self.powers)
        np.cumprod(self.inverses, out=self.inverses)

    def chunks(self, data: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(offset, hash and place of the anchor of each window from there on); every window is in one chunk."""
        for offset in range(0, max(0, len(data) - LENGTH + 1), CHUNK):
            part = data[offset:offset + CHUNK + LENGTH - 1]
            count = len(part) - LENGTH + 1
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * self.powers[:len(part)], out=sums[1:])
            grams = (sums[GRAM:] - sums[:-GRAM]) * self.inverses[:len(part) - GRAM + 1]
            grams = (grams ^ (grams >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            grams ^= grams >> np.uint64(32)
            width = LENGTH - GRAM + 1
            low = np.uint64((1 << 21) - 1)
            key = grams & ~low | np.arange(len(grams), dtype=np.uint64)
            rows = -(-len(key) // width)
            padded = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
            padded[:len(key)] = key
            grid = padded.reshape(rows, width)
            left = np.minimum.accumulate(grid, axis=1).ravel()
            right = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
            place = (np.minimum(right[:count], left[width - 1:width - 1 + count]) & low).astype(np.int64)
            yield offset, grams, place


def text_bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)


def window_runs(offset: int, grams: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: first window, number of windows, place and hash of the anchor."""
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    many = np.diff(np.r_[first, len(place)])
    return offset + first, many, offset + place[first], grams[place[first]].view(np.int64)


def contents(docs: DataFrame) -> DataFrame:
    """One row per content: its 8-byte name for dealing, its key, its first document and its text."""
    return (docs.filter(F.octet_length("text") >= LENGTH)
            .select(F.xxhash64("text").alias("uid"), content_key(F.col("text")).alias("key"), F.coalesce("doc_id", F.lit(LAST)).alias("doc"), "text")
            .groupBy("uid", "key").agg(F.min("doc").alias("doc"), F.first("text").alias("text")))


def all_anchors(docs: DataFrame) -> DataFrame:
    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        anchors = Anchors()
        for batch in batches:
            hashes, uids, places = [], [], []
            for uid, text in zip(batch["uid"], batch["text"]):
                for chunk in anchors.chunks(text_bytes(text)):
                    _, _, place, value = window_runs(*chunk)
                    hashes.append(value)
                    places.append(place)
                    uids.append(np.full(len(place), uid))
            if hashes:
                yield pd.DataFrame({"anchor": np.concatenate(hashes), "uid": np.concatenate(uids), "place": np.concatenate(places)})

    return (docs.filter(F.octet_length("text") >= LENGTH).select(F.xxhash64("text").alias("uid"), "text")
            .mapInPandas(found, "anchor long, uid long, place int"))


def repeated_places(docs: DataFrame) -> DataFrame:
    """Places of anchors that occur more than once, as one array per content."""
    anchors = all_anchors(docs)
    # copies of a whole text repeat all its anchors; that costs those texts a look and changes nothing
    repeated = anchors.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    return anchors.join(repeated, "anchor").groupBy("uid").agg(F.collect_set("place").alias("places"))


def windows(affected: DataFrame, with_bytes: bool) -> DataFrame:
    """Strings of the windows of each repeated anchor: where they start, how many windows, a digest, perhaps the bytes."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from hashlib import md5

        anchors = Anchors()
        for batch in batches:
            rows = []
            for uid, doc, text, places in zip(batch["uid"], batch["doc"], batch["text"], batch["places"]):
                data = text_bytes(text)
                raw = data.tobytes()
                for chunk in anchors.chunks(data):
                    first, many, place, value = window_runs(*chunk)
                    kept = np.flatnonzero(np.isin(place, places))
                    for start, count, anchor in zip(first[kept].tolist(), many[kept].tolist(), value[kept].tolist()):
                        string = raw[start:start + count + LENGTH - 1]
                        row = (md5(string).digest(), doc, uid, start, count)
                        rows.append((*row, anchor, string) if with_bytes else row)
                if len(rows) > FEW_ROWS:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            yield pd.DataFrame(rows, columns=names)

    names = ["digest", "doc", "uid", "start", "many", *(["anchor", "string"] if with_bytes else [])]
    schema = "digest binary, doc long, uid long, start long, many long" + (", anchor long, string binary" if with_bytes else "")
    return affected.select("uid", "doc", "text", "places").mapInPandas(cut, schema)


def earlier_matches(suffixes: np.ndarray, position: np.ndarray) -> np.ndarray:
    """For suffixes cut at ``LENGTH`` bytes and their text positions: whether an equal one starts earlier.

    In suffix order, runs of equal suffixes have common prefixes of ``LENGTH`` bytes. Within a run, a suffix has a longest
    previous factor of that length if the previous or the next smaller position lies in the run.
    """
    order = np.argsort(suffixes, kind="stable")
    sorted_suffixes, at = suffixes[order], position[order].astype(np.int64)
    run = np.cumsum(np.r_[0, sorted_suffixes[1:] != sorted_suffixes[:-1]])
    wide = np.int64(len(at) + 1)
    previous_smaller = np.minimum.accumulate(at - run * wide) < at - run * wide
    next_smaller = np.minimum.accumulate((at + run * wide)[::-1])[::-1] < at + run * wide
    found = np.zeros(len(at), bool)
    found[order] = previous_smaller | next_smaller
    return found


def matched_in_groups(rows: pd.DataFrame) -> pd.DataFrame:
    """Byte ranges (uid, start, end) that go, from complete groups of strings by anchor."""
    rows = rows.sort_values(["doc", "uid", "start"], kind="stable")
    many = rows["many"].to_numpy()
    total = int(many.sum())
    data = np.frombuffer(b"".join(rows["string"]), np.uint8)
    begins = np.cumsum(np.r_[0, many[:-1] + LENGTH - 1])
    string = np.repeat(np.arange(len(rows)), many)
    inside = np.arange(total) - np.repeat(np.cumsum(np.r_[0, many[:-1]]), many)
    cut = np.lib.stride_tricks.sliding_window_view(data, LENGTH)[begins[string] + inside]
    suffixes = np.ascontiguousarray(cut).view(f"S{LENGTH}").ravel()
    # equal bytes have equal anchors, so groups need no mark of their own
    found = np.flatnonzero(earlier_matches(suffixes, np.arange(total)))
    if not len(found):
        return pd.DataFrame({"uid": [], "start": [], "end": []}, dtype="int64")
    fresh = np.r_[True, (np.diff(found) > 1) | (string[found][1:] != string[found][:-1])]
    first = found[fresh]
    last = found[np.r_[fresh[1:], True]]
    where = rows["start"].to_numpy()[string[first]]
    return pd.DataFrame({"uid": rows["uid"].to_numpy()[string[first]], "start": where + inside[first], "end": where + inside[last] + LENGTH})


def match_groups(strings: DataFrame) -> DataFrame:
    """All groups, a bounded number of bytes at a time."""

    def matched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            kept.append(batch)
            size += int(batch["string"].str.len().sum())
            if size > GATHER:
                rows = pd.concat(kept, ignore_index=True)
                open_group = rows["anchor"] == rows["anchor"].iloc[-1]
                if not open_group.all():
                    yield matched_in_groups(rows[~open_group])
                    kept = [rows[open_group]]
                    size = int(kept[0]["string"].str.len().sum())
        if kept:
            yield matched_in_groups(pd.concat(kept, ignore_index=True))

    return (strings.select("anchor", "doc", "uid", "start", "many", "string").repartition("anchor").sortWithinPartitions("anchor")
            .mapInPandas(matched, "uid long, start long, end long"))


def removed_ranges(affected: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """Byte ranges (uid, start, end) that go, overlapping ranges included."""
    order = F.struct("doc", "uid", "start")
    firsts = held(windows(affected, True).groupBy("digest").agg(
        F.min(order).alias("first"), F.first("anchor").alias("anchor"), F.first("many").alias("many"), F.first("string").alias("string"))
        .select("digest", "first.*", "anchor", "many", "string"), "strings", free=True)
    late = (windows(affected, False).join(firsts.select("digest", F.struct("doc", "uid", "start").alias("first")), "digest")
            .filter(order != F.col("first")).select("uid", "start", (F.col("start") + F.col("many") + LENGTH - 1).alias("end")))
    groups = held(firsts.groupBy("anchor").count().filter("count > 1"), "groups")
    normal = firsts.join(groups.filter(F.col("count") <= crowded).select("anchor"), "anchor")
    split = (firsts.join(groups.filter(F.col("count") > crowded).select("anchor"), "anchor")
             .select("doc", "uid", F.posexplode(F.transform(F.sequence(F.lit(1), F.col("many").cast("int")), lambda i: F.substring("string", i, LENGTH))), "start")
             .select("doc", "uid", (F.col("start") + F.col("pos")).alias("start"), F.col("col").alias("window")))
    earliest = split.groupBy("window").agg(F.min(order).alias("first"))
    crowd = split.join(earliest, "window").filter(order != F.col("first")).select("uid", "start", (F.col("start") + LENGTH).alias("end"))
    return late.unionByName(match_groups(normal)).unionByName(crowd)


@F.pandas_udf(T.StructType().add("n_removed", "long").add("n_spans", "long").add("kept_sha256", "string")
              .add("spans", T.ArrayType(T.StructType().add("start", "long").add("end", "long"))))
def applied(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, ranges in batches:
        rows = []
        for text, found in zip(texts, ranges):
            raw = (text or "").encode()
            spans: list[dict] = []
            for start, end in sorted((r["start"], r["end"]) for r in (found if found is not None else ())):
                if spans and start <= spans[-1]["end"]:
                    spans[-1]["end"] = max(spans[-1]["end"], end)
                else:
                    spans.append({"start": start, "end": end})
            digest, at = sha256(), 0
            for s in spans:
                digest.update(raw[at:s["start"]])
                at = s["end"]
            digest.update(raw[at:])
            rows.append((sum(s["end"] - s["start"] for s in spans), len(spans), digest.hexdigest(), spans))
        yield pd.DataFrame(rows, columns=["n_removed", "n_spans", "kept_sha256", "spans"])


def repeats(docs: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans (start, end) of every row of ``docs`` (doc_id, text)."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    small = held(docs.select("doc_id", content_key(F.col("text")).alias("key"), F.octet_length("text").cast("long").alias("n_bytes"),
                             F.sha2(F.col("text").cast("binary"), 256).alias("whole")), "documents")
    first = small.groupBy("key").agg(F.min(F.coalesce("doc_id", F.lit(LAST))).alias("doc"))
    places = held(repeated_places(docs), "places", free=True)
    affected = held(contents(docs).join(places, "uid"), "affected", free=True)
    ranges = held(removed_ranges(affected, crowded).groupBy("uid").agg(F.collect_list(F.struct("start", "end")).alias("ranges")), "ranges", free=True)
    found = (affected.select("uid", "key", "text").join(ranges, "uid").select("key", applied("text", "ranges").alias("found"))
             .select("key", "found.*"))
    rows = small.join(first, "key").join(found, "key", "left")
    copy = (F.coalesce("doc_id", F.lit(LAST)) != F.col("doc")) & (F.col("n_bytes") >= LENGTH)

    def result(copied: Column, otherwise: Column, name: str) -> Column:
        return F.when(copy, copied).otherwise(F.coalesce(F.col(name), otherwise)).alias(name)

    none = F.array().cast("array<struct<start: bigint, end: bigint>>")
    return rows.select("doc_id", "n_bytes", result(F.col("n_bytes"), F.lit(0).cast("long"), "n_removed"),
                       result(F.lit(1).cast("long"), F.lit(0).cast("long"), "n_spans"),
                       result(F.lit(sha256(b"").hexdigest()), F.col("whole"), "kept_sha256"),
                       result(F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end"))), none, "spans"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(table(spark, sf_dir, "documents")).drop("spans")
