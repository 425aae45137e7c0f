"""Ranked lexical search: Block-Max MaxScore over an inverted index in shards.

Index. One pass counts the documents with a term (N) and all terms (L); a second one cuts every task's documents into
shards of at most ``SHARD_TERMS`` terms (a longer document is a shard of its own) and writes one row for each shard and
term: the postings of all its documents in compressed blocks of ``BLOCK`` postings, and for each block its first and last
document and its largest impact. An impact is the part of a score that depends on the document alone,
``(10^9 * tf) div (1000 * tf + 12 * m)`` with ``m = 75 + (25 * n * N) div L``. The index holds all terms and serves any items.

Search. Items are taken in chunks; a join on the term brings each shard the lists that a chunk asks for. Within a shard,
documents go by in windows in ascending order of ``doc_id``. The lists whose global bounds together cannot lift a document
over the item's k-th score are not essential: documents come from the essential lists only, block maxima of the others
reject candidates before anything of them is decompressed, and only blocks with a surviving candidate are. Shards hand on
their heaps, at most k rows an item, which a ranking by item merges.

Defined results: a NULL or empty text has no term, is not counted in N and never found; an item without a term that occurs
has no rows; equal scores go by ascending ``doc_id``, NULL last; repeated rows, ids or items are ranked each on their own;
terms that an item repeats count as often; texts are read whole; other columns are not read. Empty tables give no rows.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from demandgrid.llm.common import held, table

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of UTF-8 that belong to terms, in lower case; every byte from 0x80 on does, all others are blanks.
FOLD = bytes(b if b >= 0x80 else (b | 0x20 if chr(b).isalpha() else b) if chr(b).isalnum() else 0x20 for b in range(256))
RANKS = 20
BLOCK = 128
#: Blocks of fewer postings are stored as they are.
LEAST_PACKED = 24
SHARD_TERMS = 4_000_000
SHARD_DOCS = 1 << 16
ITEMS_LOG2 = 10
WINDOWS = (256, 512, 1024, 2048)
NO_ID = np.iinfo(np.int64).max
INDEX = "shard long, term binary, n long, firsts binary, lasts binary, maxima binary, blocks array<binary>, empty_ids long"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def impact(tf: np.ndarray, size: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """Impact of ``tf`` occurrences in documents of ``size`` terms."""
    return 1_000_000_000 * tf // (1000 * tf + 12 * (100 - 25 + 25 * size * documents // terms))


def packed(docs: bytes, impacts: bytes, size: int) -> bytes:
    return docs + impacts if size < LEAST_PACKED else zlib.compress(docs + impacts, 1)


def unpacked(block: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    raw = block if size < LEAST_PACKED else zlib.decompress(block)
    return np.frombuffer(raw, np.uint16, size).astype(np.int64), np.frombuffer(raw, np.int32, size, 2 * size).astype(np.int64)


def shard_rows(shard: int, ids: list, numbers: list[np.ndarray], names: list[bytes], documents: int, terms: int) -> Iterator[pa.RecordBatch]:
    """Rows of one shard, terms in ascending order; the row of the empty term holds its ids, those that are NULL last."""
    order = np.argsort(np.array([NO_ID if i is None else i for i in ids], np.int64), kind="stable")
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))
    sizes = np.array([len(x) for x in numbers], np.int64)
    alphabetical = np.argsort(np.array(names, object), kind="stable") if names else np.zeros(0, np.int64)
    rank = np.empty(len(names), np.int64)
    rank[alphabetical] = np.arange(len(names))
    keys, tf = np.unique((rank[np.concatenate(numbers)] << 16) | np.repeat(place, sizes), return_counts=True) if names else (np.zeros(0, np.int64),) * 2
    term, doc = keys >> 16, keys & 0xFFFF
    by_place = np.empty(len(ids), np.int64)
    by_place[place] = sizes
    impacts = impact(tf.astype(np.int64), by_place[doc], documents, terms) if len(keys) else keys
    starts = np.searchsorted(term, np.arange(len(names) + 1))
    many = -(-np.diff(starts) // BLOCK)
    first_block = np.concatenate([[0], np.cumsum(many)])
    cuts = np.repeat(starts[:-1], many) + BLOCK * (np.arange(first_block[-1]) - np.repeat(first_block[:-1], many))
    ends = np.minimum(cuts + BLOCK, np.repeat(starts[1:], many))
    docs16, impacts32 = doc.astype(np.uint16), impacts.astype(np.int32)
    blocks = [packed(docs16[c:e].tobytes(), impacts32[c:e].tobytes(), e - c) for c, e in zip(cuts.tolist(), ends.tolist())]
    known = [ids[i] for i in order if ids[i] is not None]
    yield batch_of([[shard], [b""], [len(ids)], [None], [None], [None], [[np.array(known, np.int64).tobytes()]], [len(ids) - len(known)]])

    def numbers_of(values: np.ndarray) -> pa.Array:
        """For each term the 32-bit values of its blocks."""
        places = pa.py_buffer((4 * first_block).astype(np.int32))
        return pa.Array.from_buffers(pa.binary(), len(names), [None, places, pa.py_buffer(values.astype(np.int32))])

    if names:
        rows = batch_of([np.full(len(names), shard), [names[i] for i in alphabetical], np.diff(starts), numbers_of(doc[cuts]), numbers_of(doc[ends - 1]),
                         numbers_of(np.maximum.reduceat(impacts, cuts)),
                         pa.ListArray.from_arrays(pa.array(first_block, pa.int32()), pa.array(blocks, pa.binary())), pa.nulls(len(names), pa.int64())])
        for at in range(0, len(names), 4096):
            yield rows.slice(at, 4096)


def batch_of(columns: list) -> pa.RecordBatch:
    types = (pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.binary()), pa.int64())
    names = [x.split()[0] for x in INDEX.split(", ")]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)], names=names)


def corpus_sizes(docs: DataFrame) -> tuple[int, int]:
    """Documents with a term, and terms of all."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = terms = 0
        for batch in batches:
            for text in batch["text"]:
                found = len(terms_of(text.as_py() or b""))
                documents, terms = documents + bool(found), terms + found
        yield pa.RecordBatch.from_arrays([pa.array([documents]), pa.array([terms])], names=["documents", "terms"])

    row = (docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(counted, "documents long, terms long")
           .agg(F.sum("documents"), F.sum("terms")).first())
    return row[0] or 0, row[1] or 0


def build_index(docs: DataFrame, shard_terms: int = SHARD_TERMS) -> tuple[DataFrame, int]:
    """The written index of all terms of all documents, and the number of documents with a term."""
    documents, terms = corpus_sizes(docs)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made = TaskContext.get().partitionId() << 32, 0
        vocabulary: defaultdict[bytes, int] = defaultdict()
        vocabulary.default_factory = vocabulary.__len__
        ids: list = []
        numbers: list[np.ndarray] = []
        held_terms = 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                found = terms_of(text.as_py() or b"")
                if not found:
                    continue
                if ids and (held_terms + len(found) > shard_terms or len(ids) == SHARD_DOCS):
                    yield from shard_rows(first + made, ids, numbers, list(vocabulary), documents, terms)
                    made, held_terms = made + 1, 0
                    vocabulary.clear(), ids.clear(), numbers.clear()
                ids.append(doc_id)
                numbers.append(np.fromiter(map(vocabulary.__getitem__, found), np.int64, len(found)))
                held_terms += len(found)
        if ids:
            yield from shard_rows(first + made, ids, numbers, list(vocabulary), documents, terms)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(shards, INDEX)
    return held(rows, "lexical-index"), documents


class Postings:
    """One list of a shard; blocks are decompressed when first asked for."""

    def __init__(self, n: int, firsts: bytes, lasts: bytes, maxima: bytes, blocks: list[bytes]):
        self.n, self.blocks = n, blocks
        self.firsts, self.lasts = np.frombuffer(firsts, np.int32), np.frombuffer(lasts, np.int32)
        self.maxima = np.frombuffer(maxima, np.int32).astype(np.int64)
        self.largest = int(self.maxima.max())
        self.opened: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if i not in self.opened:
            self.opened[i] = unpacked(self.blocks[i], min(BLOCK, self.n - i * BLOCK))
        return self.opened[i]

    def add_range(self, lo: int, hi: int, weight: int, sums: np.ndarray) -> None:
        """Add the scores of documents from lo to hi to ``sums``, which starts at lo."""
        for i in range(int(np.searchsorted(self.lasts, lo)), int(np.searchsorted(self.firsts, hi))):
            docs, impacts = self.block(i)
            a, b = np.searchsorted(docs, (lo, hi))
            sums[docs[a:b] - lo] += weight * impacts[a:b]

    def places(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each document the block that may hold it, and that block's largest impact; 0 where none can."""
        at = np.searchsorted(self.lasts, docs)
        inside = at < len(self.lasts)
        at[~inside] = 0
        inside &= self.firsts[at] <= docs
        return at, np.where(inside, self.maxima[at], 0)

    def impacts_of(self, docs: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Impacts of single documents, given their blocks; only these blocks are opened."""
        out = np.zeros(len(docs), np.int64)
        for i in np.unique(at):
            mine = np.flatnonzero(at == i)
            there, impacts = self.block(int(i))
            where = np.minimum(np.searchsorted(there, docs[mine]), len(there) - 1)
            out[mine] = np.where(there[where] == docs[mine], impacts[where], 0)
        return out


def best_of(lists: list[tuple[Postings, int]], size: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the k best documents of a shard of ``size``; among equal scores the first places."""
    lists = sorted(((p, w) for p, w in lists if w > 0), key=lambda x: x[0].largest * x[1])
    reach = np.cumsum([p.largest * w for p, w in lists])
    docs, scores, least = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    lo, step = 0, 0
    while lo < size:
        hi = min(size, lo + WINDOWS[min(step, len(WINDOWS) - 1)])
        # lists before `cut` cannot lift a document over the k-th score, not even all together
        cut = int(np.searchsorted(reach, least, side="right"))
        if cut == len(lists):
            break
        sums = np.zeros(hi - lo, np.int64)
        for postings, weight in lists[cut:]:
            postings.add_range(lo, hi, weight, sums)
        found = np.flatnonzero(sums)
        total, found = sums[found], found + lo
        optional = []
        if cut:
            keep = total + reach[cut - 1] > least
            total, found = total[keep], found[keep]
            optional = [(*postings.places(found), weight) for postings, weight in lists[:cut]]
            total = total + sum(most * weight for _, most, weight in optional)
        alive = np.arange(len(found))
        for j in range(cut - 1, -1, -1):
            alive = alive[total[alive] > least]
            if not len(alive):
                break
            at, most, weight = optional[j]
            near = alive[most[alive] > 0]
            total[near] += weight * (lists[j][0].impacts_of(found[near], at[near]) - most[near])
        alive = alive[total[alive] > least]
        if len(alive):
            docs, scores = np.concatenate([docs, found[alive]]), np.concatenate([scores, total[alive]])
            order = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[order], scores[order]
            if len(scores) == k:
                least = int(scores[-1])
        lo, step = hi, step + 1
    return docs, scores


def item_terms(items: DataFrame) -> DataFrame:
    """Item number, term and its occurrences."""
    folded = F.translate(F.coalesce(F.col("text"), F.lit("")), UPPER, LOWER)
    return (items.select("item", F.explode(F.regexp_extract_all(folded, F.lit(TERM), F.lit(0))).alias("term"))
            .select("item", F.col("term").cast("binary").alias("term")).groupBy("item", "term").agg(F.count("*").alias("times")))


def search(index: DataFrame, documents: int, items: DataFrame, k: int = RANKS) -> DataFrame:
    """The k best documents of every item: item_id, rank, doc_id, score."""
    numbered = held(items.select("item_id", "text").withColumn("item", F.monotonically_increasing_id()), "lexical-items")
    asked = item_terms(numbered)
    seen = index.filter(F.length("term") > 0).join(asked.select("term").distinct(), "term", "left_semi")
    weight = F.floor(1000 * F.log((2.0 * F.lit(documents) + 2.0) / (2.0 * F.col("df") + 1.0))).cast("long")
    weights = seen.groupBy("term").agg(F.sum("n").alias("df")).select("term", weight.alias("weight"))
    weighed = asked.join(weights, "term").withColumn("chunk", F.shiftright("item", ITEMS_LOG2))
    # each chunk asks for its terms and, by the empty one, for the ids of every shard, which brings the items along
    packs = weighed.groupBy("chunk").agg(F.collect_list(F.struct("item", "term", (F.col("times") * F.col("weight")).alias("weight"))).alias("asked"))
    wanted = held(weighed.select("chunk", "term").distinct().withColumn("asked", F.lit(None).cast(packs.schema["asked"].dataType))
                  .unionByName(packs.select("chunk", F.lit(b"").alias("term"), "asked")), "lexical-wanted")

    def searched(key: tuple, rows: pa.Table) -> pa.Table:
        lists, ids, asks = {}, None, []
        for row in rows.to_batches():
            for r in row.to_pylist():
                if r["term"]:
                    lists[r["term"]] = Postings(r["n"], r["firsts"], r["lasts"], r["maxima"], r["blocks"])
                else:
                    ids, asks = [*np.frombuffer(r["blocks"][0], np.int64).tolist(), *[None] * r["empty_ids"]], r["asked"]
        by_item: dict[int, list] = defaultdict(list)
        for a in asks:
            if a["term"] in lists:
                by_item[a["item"]].append((lists[a["term"]], a["weight"]))
        out: list[list] = [[], [], []]
        for item, mine in by_item.items():
            docs, scores = best_of(mine, len(ids), k)
            out[0] += [item] * len(docs)
            out[1] += [ids[d] for d in docs]
            out[2] += scores.tolist()
        return pa.table([pa.array(c, pa.int64()) for c in out], names=["item", "doc_id", "score"])

    heaps = index.join(wanted, "term").groupBy("shard", "chunk").applyInArrow(searched, "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = heaps.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    index, documents = build_index(table(spark, sf_dir, "documents"))
    return search(index, documents, table(spark, sf_dir, "benchmark"))


OP12_SQL = rf"""
WITH words AS (
    SELECT rid, doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term
    FROM (SELECT row_number() OVER () AS rid, doc_id, text FROM documents)),
tf AS (SELECT rid, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
sizes AS (SELECT rid, sum(tf) AS n FROM tf GROUP BY rid),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sizes),
weights AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term),
asked AS (
    SELECT item, item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) AS term
    FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark)),
impacts AS (
    SELECT tf.rid, tf.doc_id, tf.term,
           (1000000000 * tf.tf::BIGINT) // (1000 * tf.tf::BIGINT + 12 * (100 - 25 + (25 * n::BIGINT * docs) // terms)) AS impact
    FROM tf JOIN sizes USING (rid), total),
scores AS (
    SELECT item, item_id, rid, doc_id, sum(times * w * impact)::BIGINT AS score
    FROM (SELECT item, item_id, term, count(*)::BIGINT AS times FROM asked GROUP BY ALL) JOIN weights USING (term) JOIN impacts USING (term)
    GROUP BY ALL)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
WHERE rank <= {RANKS}
"""
