"""Cross-tokenizer alignment: tokens of two vocabularies meet where both end at the same byte.

Each text is encoded with a byte-level pair vocabulary (A, over blank + text) and a sentence-piece vocabulary (B, which puts
the blank there itself). Where the file's merges allow it, A runs as a ranked vocabulary, which is faster and gives the same ids
for Latin texts; other texts go through the file's own encoder. Dictionaries from cumulative end to index are made of both; their keys in common, sorted, slice both
id lists into groups, and every slice is expanded into its links, all pairs of an A token and a B token in it. Links of one
document are kept as distinct id pairs with their number; large slices are expanded by distinct ids, so memory follows the
distinct pairs.

Corpus-wide counts. A pair's count is the number of documents that hold it linked. Documents are written in segments of a
bounded number of pairs. Each segment gives one row a distinct pair, which sums up to the counts; the counts come back
the same way, one row a segment and pair, and meet the documents of their segment in one task of bounded size.

Both vocabulary files are parameters; the driver reads them once and ships their bytes, a fixed size.

Defined results: NULL and empty texts, and texts whose joined token bytes differ from blank + text in A or B, have no tokens:
zeros and '' as groups. Special tokens' strings inside texts are plain text. Texts are read whole. Repeated rows and ids are
documents of their own, a NULL ``doc_id`` is kept; other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from hashlib import sha256
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from demandgrid.llm.common import held, table

BYTE_FILE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_FILE = "/opt/tokenizers/piece_bpe_32k.model"
#: How byte-level vocabularies cut a text before pairs are merged: contractions, words, numbers, other signs, blanks.
PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Below, all versions of Unicode agree on what is a letter or a number.
LATIN_END = "\u0250"
#: Links that are expanded at once, and links of a slice from which on distinct ids are paired.
EXPANDED = 1 << 21
LARGE_SLICE = 1 << 12
#: Distinct pairs of the documents of a segment.
SEGMENT_PAIRS = 1 << 20
DOCUMENTS = ("segment long, place int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
             "pairs binary, links binary")
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


def byte_of_sign() -> dict[str, int]:
    """Bytes by the signs of byte-level vocabularies: printable ones stand for themselves, others follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def ranked_encoding(file: dict, token_bytes: list[bytes]):
    """The same byte-pair vocabulary for a faster encoder, which takes the lowest id that a pair makes; None unless the merges of
    the file make its tokens in the order of their ids and texts are cut by the usual pattern alone."""
    import tiktoken

    model, cut = file["model"], file["pre_tokenizer"] or {}
    merged = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    ids = [model["vocab"].get("".join(m), -1) for m in merged]
    plain = (file["normalizer"] is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
             and not model.get("ignore_merges") and not model.get("dropout"))
    if not plain or ids != list(range(256, 256 + len(merged))):
        return None
    return tiktoken.Encoding("byte pairs", pat_str=PIECES, mergeable_ranks={token_bytes[i]: i for i in range(256 + len(merged))}, special_tokens={})


def code_type(pairs: int) -> np.dtype:
    """How a pair is packed."""
    return np.dtype(np.uint32 if pairs <= 1 << 32 else np.uint64)


class Aligner:
    """Both tokenizers with the bytes of every token."""

    def __init__(self, byte_file: bytes, piece_file: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_str(byte_file.decode()), SentencePieceProcessor(model_proto=piece_file)
        self.a.encode_special_tokens = True
        names, signs = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}, byte_of_sign()
        self.bytes_a = [b"".join(bytes([signs[c]]) if c in signs else c.encode() for c in names.get(i, "")) for i in range(max(names) + 1)]
        self.bytes_b = [self.piece_bytes(self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.get_piece_size())]
        self.size_a, self.size_b = (np.array([len(x) for x in table]) for table in (self.bytes_a, self.bytes_b))
        self.ranked = ranked_encoding(json.loads(byte_file), self.bytes_a)
        self.ids_b = len(self.bytes_b)
        self.code = code_type(len(self.bytes_a) * self.ids_b)
        # how an id is written before another of its slice, and at the end of an A and of a B slice
        written = [str(i) for i in range(max(len(self.bytes_a), self.ids_b))]
        self.signs = np.array([(w + end).encode() for end in (",", "|", ";") for w in written])
        self.written = len(written)

    @staticmethod
    def piece_bytes(piece: str, is_byte: bool) -> bytes:
        return bytes([int(piece[3:5], 16)]) if is_byte else piece.replace("▁", " ").encode()

    def encode_a(self, text: str) -> list[int]:
        if self.ranked and max(text) < LATIN_END:
            return self.ranked.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        return zip((self.encode_a(f" {t}") for t in texts), self.b.encode(texts, num_threads=1) if texts else [])

    def slices(self, text: str, ids_a: list[int], ids_b: list[int]) -> tuple[np.ndarray, ...] | None:
        """Both id lists as arrays, and where their slices end; None where the tokens are not the text."""
        whole = b" " + text.encode()
        if b"".join(map(self.bytes_a.__getitem__, ids_a)) != whole or b"".join(map(self.bytes_b.__getitem__, ids_b)) != whole:
            return None
        a, b = np.array(ids_a), np.array(ids_b)
        at_a, at_b = dict(zip(np.cumsum(self.size_a[a]).tolist(), range(1, len(a) + 1))), dict(zip(np.cumsum(self.size_b[b]).tolist(), range(1, len(b) + 1)))
        common = sorted(at_a.keys() & at_b.keys())
        return a, b, np.array(itemgetter(*common, common[-1])(at_a)[:-1]), np.array(itemgetter(*common, common[-1])(at_b)[:-1])

    def written_groups(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> str:
        """``a1,a2|b1;a3|b2,b3``"""
        starts_a, starts_b = np.concatenate([[0], ends_a[:-1]]), np.concatenate([[0], ends_b[:-1]])
        codes = np.zeros(len(a) + len(b), np.int64)
        codes[np.arange(len(a)) + np.repeat(starts_b, ends_a - starts_a)] = a
        codes[np.arange(len(b)) + np.repeat(ends_a, ends_b - starts_b)] = b
        codes[ends_a - 1 + starts_b] += self.written
        codes[ends_b - 1 + ends_a] += 2 * self.written
        return self.signs[codes].tobytes().replace(b"\0", b"")[:-1].decode()

    def linked(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Distinct pairs ``a * ids_b + b`` in ascending order, how often each is linked, and the links of all."""
        starts_a, starts_b = np.concatenate([[0], ends_a[:-1]]), np.concatenate([[0], ends_b[:-1]])
        wide = ends_b - starts_b
        links = (ends_a - starts_a) * wide
        pairs, times = [], []

        def keep(codes: np.ndarray, weights: np.ndarray | None = None) -> None:
            if weights is None:
                found, n = np.unique(codes, return_counts=True)
            else:
                found, inverse = np.unique(codes, return_inverse=True)
                n = np.zeros(len(found), np.int64)
                np.add.at(n, inverse, weights)
            pairs.append(found), times.append(n)

        small = np.flatnonzero(links <= LARGE_SLICE)
        for part in np.split(small, np.searchsorted(np.cumsum(links[small]), np.arange(EXPANDED, links[small].sum(), EXPANDED))):
            sizes = links[part]
            offset = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            across = np.repeat(wide[part], sizes)
            keep(a[np.repeat(starts_a[part], sizes) + offset // across] * self.ids_b + b[np.repeat(starts_b[part], sizes) + offset % across])
        for g in np.flatnonzero(links > LARGE_SLICE):
            (some_a, n_a), (some_b, n_b) = (np.unique(x, return_counts=True) for x in (a[starts_a[g]:ends_a[g]], b[starts_b[g]:ends_b[g]]))
            rows = max(1, EXPANDED // len(some_b))
            for at in range(0, len(some_a), rows):
                keep((some_a[at:at + rows, None] * self.ids_b + some_b).ravel(), (n_a[at:at + rows, None] * n_b).ravel())
        if len(pairs) > 1:
            codes, weights = np.concatenate(pairs), np.concatenate(times)
            pairs.clear(), times.clear()
            keep(codes, weights)
        return pairs[0], times[0], int(links.sum())


def read_file(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def aligned_documents(docs: DataFrame, byte_file: bytes, piece_file: bytes, digest: bool) -> DataFrame:
    """One row a document with its groups, and its distinct pairs and their links in packed form."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_file, piece_file)
        segment, place, filled = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            texts = batch["text"].to_pylist()
            encoded = aligner.encode([t for t in texts if t])
            out = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), texts):
                row = (doc_id, 0, 0, 0, 0, "", b"", b"")
                if text:
                    ids_a, ids_b = next(encoded)
                    ends = aligner.slices(text, ids_a, ids_b)
                    if ends is not None:
                        groups = aligner.written_groups(*ends)
                        pairs, times, links = aligner.linked(*ends)
                        row = (doc_id, len(ids_a), len(ids_b), len(ends[-1]), links, sha256(groups.encode()).hexdigest() if digest else groups,
                               pairs.astype(aligner.code).tobytes(), times.astype(np.uint32).tobytes())
                        filled += len(pairs)
                out.append((segment, place, *row))
                place += 1
                if filled >= SEGMENT_PAIRS:
                    segment, place, filled = segment + 1, 0, 0
            if out:
                types = (pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.string(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                 names=[x.split()[0] for x in DOCUMENTS.split(", ")])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return held(narrow.mapInArrow(rows, DOCUMENTS), "aligned")


def pairs_by_segment(documents: DataFrame, code: np.dtype) -> DataFrame:
    """For each segment its distinct pairs and how many of its documents hold each."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, waiting = None, []

        def counted() -> Iterator[pa.RecordBatch]:
            pairs, docs = np.unique(np.concatenate(waiting), return_counts=True)
            for at in range(0, len(pairs), 1 << 16):
                part = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs[part]), segment)), pa.array(pairs[part].astype(np.int64)),
                                                  pa.array(docs[part])], names=["segment", "pair", "docs"])

        for batch in batches:
            for at, data in zip(batch["segment"].to_pylist(), batch["pairs"]):
                if waiting and at != segment:
                    yield from counted()
                    waiting = []
                segment = at
                waiting.append(np.frombuffer(data.as_py(), code))
        if waiting:
            yield from counted()

    return held(documents.filter(F.length("pairs") > 0).select("segment", "pairs").mapInArrow(rows, "segment long, pair long, docs long"),
                "aligned-pairs")


def align(docs: DataFrame, byte_file: str = BYTE_FILE, piece_file: str = PIECE_FILE, digest: bool = False) -> DataFrame:
    """One row a document: sizes, links, links that are their A id's commonest, counts over all links, and the groups
    (their SHA-256 with ``digest``)."""
    files = read_file(byte_file), read_file(piece_file)
    documents = aligned_documents(docs, *files, digest)
    aligner = Aligner(*files)
    ids_b, code = aligner.ids_b, aligner.code
    seen = pairs_by_segment(documents, code)
    totals = seen.groupBy("pair").agg(F.sum("docs").alias("docs"))
    # the pairs of one A id are at most as many as B has ids
    of_a = Window.partitionBy(F.expr(f"pair div {ids_b}"))
    totals = totals.withColumn("best", (F.col("docs") == F.max("docs").over(of_a)))
    counts = seen.select("segment", "pair").join(totals, "pair")

    def summed(key: tuple, rows: pa.Table, known: pa.Table) -> pa.Table:
        pairs = known["pair"].to_numpy()
        order = np.argsort(pairs)
        pairs, number, best = pairs[order], known["docs"].to_numpy()[order], known["best"].to_numpy()[order].astype(np.int64)
        n_best, total = [], []
        for codes, links in zip(rows["pairs"], rows["links"]):
            times = np.frombuffer(links.as_py(), np.uint32).astype(np.int64)
            at = np.searchsorted(pairs, np.frombuffer(codes.as_py(), code).astype(np.int64))
            n_best.append(int((times * best[at]).sum()))
            total.append(int((times * number[at]).sum()))
        names = [x.split()[0] for x in RESULT.split(", ")]
        columns = {n: rows[n] for n in names if n in rows.column_names}
        return pa.table({**columns, "n_best": pa.array(n_best, pa.int64()), "count_sum": pa.array(total, pa.int64())}).select(names)

    with_tokens = documents.filter(F.length("pairs") > 0).drop("place").groupBy("segment").cogroup(counts.groupBy("segment")).applyInArrow(summed, RESULT)
    without = documents.filter(F.length("pairs") == 0).withColumn("n_best", F.lit(0).cast("long")).withColumn("count_sum", F.lit(0).cast("long"))
    names = [x.split()[0] for x in RESULT.split(", ")]
    return with_tokens.select(names).unionByName(without.select(names))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("groups", "groups_sha256")
