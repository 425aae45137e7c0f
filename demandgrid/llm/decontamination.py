"""Benchmark decontamination by pigeonhole edit matching.

Texts are compared in lower case with every run of characters that are neither letters nor digits turned into one
blank. An item of m characters may differ from a passage by at most ``m // PIECE - 1`` edits (insertions,
deletions, replacements). Split into one piece more than that budget, at least one piece must occur unchanged, at about its own
place, in any such passage. So

1. the pieces of a bounded block of items form one Aho-Corasick automaton, and every document is read once per block;
2. each hit tells where its item would start; starts that lie close together are one candidate;
3. Myers' bit-parallel algorithm gives the least edit distance between the item and any passage around the candidate.

Benchmarks of any size are handled in blocks of ``BLOCK_CHARS`` characters, one pass over the documents each. That
bound holds for what is shipped to executors.

Items of fewer than ``PIECE`` characters would hit by chance; they match a document only as its whole text. Items
without a letter or digit, and NULL items or texts, match nothing. Repeated items and repeated rows each give their own
matches. Long items and texts are read whole. Of several passages for an item in a document the nearest, then the first,
is reported. Other columns are not read; ``stage`` returns them unchanged, and keeps rows whatever their ``doc_id`` is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from demandgrid.llm.common import table

PIECE = 17
BLOCK_CHARS = 4_000_000


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))


def pieces(item: str) -> list[tuple[int, str]]:
    """Start and text of budget + 1 pieces of near equal length, at least ``PIECE`` if the item is that long."""
    count = max(1, len(item) // PIECE)
    cuts = [len(item) * i // count for i in range(count + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def budget(item: str) -> int:
    return len(pieces(item)) - 1


class Myers:
    """Least edit distance of a pattern to any passage of a text, a column of the matrix per step in machine words."""

    def __init__(self, pattern: str):
        self.size = len(pattern)
        self.masks: dict[str, int] = {}
        for i, c in enumerate(pattern):
            self.masks[c] = self.masks.get(c, 0) | 1 << i

    def nearest(self, text: str) -> tuple[int, int]:
        """(distance, end) of the nearest passage, the earliest end first."""
        full, high = (1 << self.size) - 1, 1 << self.size >> 1
        plus, minus, score = full, 0, self.size
        best, end = self.size, 0
        masks = self.masks
        for at, c in enumerate(text, 1):
            match = masks.get(c, 0)
            vertical = match | minus
            horizontal = (((match & plus) + plus) ^ plus) | match
            up = minus | full & ~(horizontal | plus)
            down = plus & horizontal
            if up & high:
                score += 1
            elif down & high:
                score -= 1
                if score < best:
                    best, end = score, at
            up = up << 1 & full
            plus = (down << 1 | ~(vertical | up)) & full
            minus = up & vertical
        return best, end


@dataclass
class Item:
    item_id: int | None
    text: str


class Matcher:
    """Finds a block of items in documents."""

    def __init__(self, items: list[Item]):
        self.items = items
        self.whole: dict[str, list[int]] = {}
        starts: dict[str, list[tuple[int, int]]] = {}
        for n, item in enumerate(items):
            if len(item.text) < PIECE:
                self.whole.setdefault(item.text, []).append(n)
            else:
                for at, piece in pieces(item.text):
                    starts.setdefault(piece, []).append((n, at))
        self.automaton = ahocorasick.Automaton() if starts else None
        for piece, places in starts.items():
            self.automaton.add_word(piece, (len(piece), places))
        if starts:
            self.automaton.make_automaton()
        self.searchers: dict[int, tuple[Myers, Myers]] = {}

    def matches(self, text: str) -> list[dict]:
        found = [self._told(n, 0, 0, len(text)) for n in self.whole.get(text, [])] if text else []
        wanted: dict[int, set[int]] = {}
        for last, (length, places) in self.automaton.iter(text) if self.automaton else ():
            for n, at in places:
                wanted.setdefault(n, set()).add(last + 1 - length - at)
        for n in sorted(wanted):
            hit = self._nearest(n, text, sorted(wanted[n]))
            if hit:
                found.append(self._told(n, *hit))
        return found

    def _told(self, n: int, distance: int, start: int, end: int) -> dict:
        return {"item_id": self.items[n].item_id, "distance": distance, "start": start, "end": end}

    def _nearest(self, n: int, text: str, starts: list[int]) -> tuple[int, int, int] | None:
        item = self.items[n].text
        size, edits = len(item), budget(item)
        best: tuple[int, int, int] | None = None
        first = previous = starts[0]
        for start in [*starts[1:], None]:
            if start is not None and start - previous <= 2 * edits:
                previous = start
                continue
            hit = self._verified(n, text, first, previous, edits, size)
            if hit and (best is None or hit < best):
                best = hit
            if best and best[0] == 0:
                break
            first = previous = start
        return best

    def _verified(self, n: int, text: str, first: int, last: int, edits: int, size: int) -> tuple[int, int, int] | None:
        item = self.items[n].text
        if first >= 0 and text.startswith(item, first):
            return 0, first, first + size
        forward, backward = self.searchers.setdefault(n, (Myers(item), Myers(item[::-1])))
        low = max(0, first - edits)
        distance, end = forward.nearest(text[low:last + size + edits])
        if distance > edits:
            return None
        _, length = backward.nearest(text[max(0, low + end - size - edits):low + end][::-1])
        return distance, low + end - length, low + end


MATCHES = "array<struct<item_id: bigint, distance: int, start: int, end: int>>"


def block_matches(items: list[Item]):
    @F.pandas_udf(MATCHES)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(items)
        for texts in batches:
            yield pd.Series([matcher.matches(t) for t in texts], dtype=object)

    return found


def matches(text: Column, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> Column:
    """Array of the matches of all items in ``text``; positions count characters of the normalised text."""
    items = benchmark.select("item_id", normal(F.col("text")).alias("text")).filter("text <> ''")
    blocks = max(1, -(-int(items.agg(F.sum(F.length("text"))).first()[0] or 0) // block_chars))
    columns = []
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect()
        known = sorted((Item(r["item_id"], r["text"]) for r in rows), key=lambda i: (i.item_id is None, i.item_id or 0, i.text))
        columns.append(block_matches(known)(normal(text)))
    return columns[0] if blocks == 1 else F.concat(*columns)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and item that match: doc_id, item_id, distance, start, end."""
    docs = table(spark, sf_dir, "documents")
    found = matches(F.col("text"), table(spark, sf_dir, "benchmark"))
    return docs.select("doc_id", F.inline(found))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return docs.filter(F.size(matches(F.col("text"), table(spark, sf_dir, "benchmark"))) == 0)
