"""Toxicity by nearest labelled examples: exact TF-IDF cosine with a block-max inverted index.

Fitting. At most ``max_examples`` labelled documents, chosen by a hash of their id, are the examples (the one bounded
sample here; its bound is a parameter). Terms are lower-case words, their leading four and five letters, and any
of them seen at least two or four times, all known by 64 bits of their hash; those that occur in an example are the vocabulary. The inverse document frequency of every vocabulary term is counted over all documents and
multiplied by its association with the label, a smooth function of the likelihood-ratio statistic that leaves no term out:
with raw inverse document frequencies topic outweighs a few insults. An example is the unit vector of
``(1 + ln tf) * weight``. Tasks make the vectors; the driver holds numbers only, 12 bytes a term of an example.

Index. Examples lie in blocks of ``BLOCK``. Lists of less common terms are essential: their postings are summed for each
query. The common terms lie in at most ``COLUMNS`` columns, the commonest alone, several others together with the length of
their weights, whose product with that of the query is never below the sum over its terms. Columns have block maxima.
What a block's best example has from the essential
lists and the block maxima of the columns bound all cosines in the block, and so do the lengths of query and example
over the common terms; blocks that cannot reach the k-th best cosine so far are left out before their columns
are touched. In the others the columns bound each example, and those that can reach the k-th best are candidates. Bounds are
computed with 32 bits and a slack that covers their rounding, the cosines of the candidates with 64.

Score. The k nearest (and all tied with the k-th) vote with weight 1 / (1.02 - cosine); the share of toxic votes is turned
into a probability by an isotonic fit on leave-one-out votes of the examples, which also choose k. Leave-one-out
searches run in tasks. Documents without any vocabulary term get the smoothed toxic rate of examples without any. The
nearest examples are returned as evidence.

Nulls and edge cases: a NULL or empty text has no terms and gets the no-term score; a NULL ``doc_id`` is never held out
and never an example; repeated labels of an id count once, as toxic if any of them is; labels that are NULL are left
out; without a single usable example every score is 0.5 and nothing is predicted toxic. Extra columns pass through
``score``; result columns must not exist beforehand.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, count

import numpy as np
import pandas as pd
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from xxhash import xxh3_64_intdigest

from demandgrid.llm.common import held, table

WORDS = re.compile(r"\w+")
PREFIXES = (4, 5)
LEVELS = (2, 4)
LEVEL_KEY = 0x2545F4914F6CDD1
#: Letters of a word that are hashed together with other words; longer words are hashed one by one.
WORD_LETTERS = 24
#: Bits of a hash that tell at once that most other terms are not in the vocabulary.
MAYBE_BITS = 24
#: Stands for a term that is not in the vocabulary.
NO_TERM = -1
MAX_EXAMPLES = 10_000
# likelihood ratio at which a term has half of its weight, and the share of it that a term without association keeps
HALF_WEIGHT = 24.0
LEAST_WEIGHT = 0.01
#: Numbers of neighbours that leave-one-out votes choose from.
NEIGHBOURS = (3, 5, 9, 15, 25)
#: Examples of a block, columns of common terms (in a 20th of the examples or more), queries at once.
BLOCK = 128
COLUMNS = 1536
COLUMN_SHARE = 20
TOGETHER = 128
#: Terms in a sixteenth of the examples or more tell which examples are alike.
COMMON_SHARE = 16
#: Terms of examples that are worked on at once.
PART = 1 << 17
#: Blocks with the highest bounds that are opened before any is left out.
OPENED_FIRST = 3
#: More than rounding to 32 bits can change a cosine.
SLACK = 1e-5
THRESHOLD = 0.7


def signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def mixed(letters: np.ndarray, seed: int) -> np.ndarray:
    """64 bits for every row of letters."""
    found = np.full(len(letters), seed, np.uint64)
    for column in letters.T:
        found = (found ^ column) * np.uint64(0x9E3779B97F4A7C15)
        found ^= found >> np.uint64(29)
    return found.view(np.int64)


def form_hashes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms of words, a row each: the word and its leading letters; and which of them there are."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    letters = np.array(words, f"U{WORD_LETTERS}").view(np.uint32).reshape(len(words), WORD_LETTERS).astype(np.uint64)
    found = np.column_stack([mixed(letters, 1), *(mixed(letters[:, :n], n) for n in PREFIXES)])
    for i in np.flatnonzero(sizes > WORD_LETTERS):
        found[i, 0] = signed(xxh3_64_intdigest(words[i]))
    return found, np.column_stack([sizes > 0, *(sizes >= n for n in PREFIXES)])


def raised(hashes: np.ndarray, least: int) -> np.ndarray:
    """Hashes of the terms that say that a form occurs so often."""
    return hashes ^ np.int64(LEVEL_KEY * least)


class Vocabulary:
    """Terms of texts by number. With ``hashes``, the sorted hashes of all terms, a number is a place in them, and other terms are
    left out; without, a number is the hash."""

    def __init__(self, hashes: np.ndarray | None = None):
        self.hashes = hashes
        if hashes is not None:
            self.maybe = np.zeros(1 << MAYBE_BITS, bool)
            self.maybe[hashes & ((1 << MAYBE_BITS) - 1)] = True
            self.levels = [self.places(raised(hashes, least)).astype(np.int32) for least in LEVELS]

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Numbers of terms; most of those that are not in the vocabulary are told by some of their bits."""
        found = np.full(len(keys), NO_TERM)
        likely = np.flatnonzero(self.maybe[keys & ((1 << MAYBE_BITS) - 1)])
        if len(likely):
            at = np.minimum(np.searchsorted(self.hashes, keys[likely]), len(self.hashes) - 1)
            found[likely] = np.where(self.hashes[at] == keys[likely], at, NO_TERM)
        return found

    def counts_of(self, texts: list[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Numbers and counts of the terms of each text; a form seen often enough also is a term of its own."""
        words = [WORDS.findall((t or "").lower()) for t in texts]
        # numbers come from a counter: a table that numbers by its own length refers to itself and stays until Python looks for cycles
        local: defaultdict[str, int] = defaultdict(count().__next__)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        word = np.fromiter(map(local.__getitem__, chain.from_iterable(words)), np.int64, sizes.sum())
        if not len(word):
            return [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in texts]
        pairs, times = np.unique(np.repeat(np.arange(len(texts)), sizes) * len(local) + word, return_counts=True)
        hashes, there = form_hashes(list(local))
        numbers, at = np.unique(hashes[there], return_inverse=True)
        if self.hashes is not None:
            numbers = self.places(numbers)
        form = np.full(hashes.shape, -1)
        form[there] = at
        # every word of a text stands for its forms; forms of several words add up
        text, form = np.repeat(pairs // len(local), form.shape[1]), form[pairs % len(local)].ravel()
        times = np.repeat(times, hashes.shape[1])
        known = form >= 0
        if self.hashes is not None:
            known &= numbers[form] != NO_TERM
        keys, inverse = np.unique(text[known] * len(numbers) + form[known], return_inverse=True)
        times = np.bincount(inverse, times[known], len(keys)).astype(np.int64)
        text, terms = keys // len(numbers), numbers[keys % len(numbers)]
        parts = [(text, terms, times)]
        for i, least in enumerate(LEVELS):
            often = times >= least
            more = raised(terms[often], least) if self.hashes is None else self.levels[i][terms[often]]
            held_ = np.ones(len(more), bool) if self.hashes is None else more != NO_TERM
            parts.append((text[often][held_], more[held_], np.ones(held_.sum(), np.int64)))
        text, terms, times = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(text.astype(np.int16) if len(texts) < 1 << 15 else text, kind="stable")
        ends = np.cumsum(np.bincount(text, minlength=len(texts)))
        terms, times = terms[order], times[order]
        return [(terms[lo:hi], times[lo:hi]) for lo, hi in zip(np.concatenate([[0], ends[:-1]]), ends)]


def packed_numbers(numbers: np.ndarray) -> bytes:
    """Compressed differences of 32-bit numbers, equal bytes of all side by side."""
    return zlib.compress(np.diff(numbers, prepend=0).astype(np.int32).view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked_numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    bytes_ = np.empty((planes.shape[1], 4), np.uint8)
    for i, plane in enumerate(planes):
        bytes_[:, i] = plane
    return np.cumsum(bytes_.view(np.int32).ravel(), dtype=np.int32)


def parts_of(starts: np.ndarray) -> list[tuple[int, int]]:
    """First examples and ends of parts with about ``PART`` terms each."""
    cuts = np.unique(np.append(np.searchsorted(starts, np.arange(0, starts[-1], PART)), len(starts) - 1)).tolist()
    return list(zip(cuts[:-1], cuts[1:]))


def unit_values(starts: np.ndarray, terms: np.ndarray, times: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weights of the unit vectors of all examples."""
    logs, found = 1 + np.log(np.arange(1, times.max(initial=0) + 1)), np.empty(len(terms), np.float32)
    for first, last in parts_of(starts):
        part, ends = slice(starts[first], starts[last]), starts[first:last + 1] - starts[first]
        values = logs[times[part] - 1] * weights[terms[part]]
        sums = np.concatenate([[0.0], np.cumsum(values * values)])
        values /= np.repeat(np.sqrt(sums[ends[1:]] - sums[ends[:-1]]), np.diff(ends))
        found[part] = values
    return found


def weighted(numbers: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending term numbers and weights of the unit vector."""
    order = np.argsort(numbers)
    numbers, counts = numbers[order], counts[order]
    raw = (1 + np.log(counts)) * weights[numbers]
    norm = np.sqrt(raw @ raw)
    return (numbers, raw / norm) if norm else (numbers[:0], raw[:0])


def unit(counts: dict[int, int], weights: np.ndarray) -> dict[int, float]:
    numbers, values = weighted(np.fromiter(sorted(counts), np.int64, len(counts)), np.array([counts[t] for t in sorted(counts)], np.int64), weights)
    return dict(zip(numbers.tolist(), values.tolist()))


class BlockMaxIndex:
    """Vectors of the examples, and their lists by term with block maxima, which are made where the index is used."""

    def __init__(self, starts: np.ndarray, terms: np.ndarray, values: np.ndarray, words: int):
        """Example n has ``terms`` and ``values`` from ``starts[n]`` to ``starts[n + 1]``, numbers ascending; ``words`` terms in all."""
        self.starts, self.terms, self.values, self.words = starts, terms, values, words
        self.size = len(starts) - 1
        self.place: np.ndarray | None = None

    @classmethod
    def build(cls, vectors: list[dict[int, float]], words: int) -> BlockMaxIndex:
        terms = [t for v in vectors for t in sorted(v)]
        values = [v[t] for v in vectors for t in sorted(v)]
        return cls(np.concatenate([[0], np.cumsum([len(v) for v in vectors])]).astype(np.int64), np.array(terms, np.int32), np.array(values, float), words)

    def make_lists(self) -> None:
        """Lists of the less common terms; columns of common terms by examples in whole blocks, and their block maxima."""
        blocks = max(1, -(-self.size // BLOCK))
        seen = np.bincount(self.terms, minlength=self.words)
        often = np.flatnonzero((seen * COLUMN_SHARE >= self.size) & (seen > 1))
        columns = min(len(often), COLUMNS)
        alone = often[np.argsort(-seen[often], kind="stable")[:COLUMNS if len(often) == columns else COLUMNS // 2]]
        # numbers go by hash, so neighbours are unrelated and seldom meet in an example
        others = np.setdiff1d(often, alone)
        self.place = np.full(self.words, -1, np.int32)
        self.place[alone] = np.arange(len(alone))
        self.place[others] = len(alone) + np.arange(len(others)) * (columns - len(alone)) // max(1, len(others))
        # numbers among the common terms, by which candidates keep their share of them
        self.common_words = len(often)
        self.number = np.full(self.words, len(often), np.int32)
        self.number[often] = np.arange(len(often))
        owner = np.repeat(np.arange(self.size, dtype=np.uint16 if self.size < 1 << 16 else np.int32), np.diff(self.starts))
        common = self.place[self.terms] >= 0
        seen[often] = 0
        self.list_starts = np.concatenate([[0], np.cumsum(seen)])
        # by term and then by place: numbers that hold both sort faster than places by term
        bits = len(self.terms).bit_length()
        order = np.flatnonzero(~common)
        for at in range(0, len(order), PART):
            order[at:at + PART] |= self.terms[order[at:at + PART]].astype(np.int64) << bits
        order.sort()
        order &= (1 << bits) - 1
        # a list entry is 8 bytes, value and example; it takes the place of its number
        for at in range(0, len(order), PART):
            part = order[at:at + PART]
            entries = np.empty((len(part), 2), np.int32)
            entries[:, 0], entries[:, 1] = self.values[part].astype(np.float32).view(np.int32), owner[part]
            order[at:at + PART] = entries.view(np.int64).ravel()
        self.lists = order
        members = owner[common]
        del owner
        self.own_starts = np.concatenate([[0], np.cumsum(np.bincount(members, minlength=self.size))])
        self.own_terms, self.own_values = self.number[self.terms[common]], self.values[common].astype(np.float32)
        # lists and own terms hold all there is
        self.terms = self.values = None
        # an example's columns side by side: a block is one stretch of memory
        rows, place = np.zeros((blocks * BLOCK, columns), np.float32), self.place[often]
        for at in range(0, len(members), PART):
            values = self.own_values[at:at + PART]
            np.add.at(rows.reshape(-1), members[at:at + PART].astype(np.int64) * columns + place[self.own_terms[at:at + PART]], values * values)
        self.common_lengths = np.sqrt(rows.sum(1))
        np.sqrt(rows, out=rows)
        self.common = rows.T
        self.maxima = rows.reshape(blocks, BLOCK, columns).max(1).T

    def nearest(self, query: dict[int, float], k: int, without: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and cosines of the k nearest examples and all tied with the k-th, best first; zero cosines are none."""
        arrays = np.array(sorted(query), np.int64), np.array([query[t] for t in sorted(query)], float)
        return next(self.nearest_many([arrays], k, None if without is None else [without]))

    def nearest_many(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int,
                     without: list[int] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """As ``nearest``, for ascending term numbers and weights of several queries."""
        for at in range(0, len(queries), TOGETHER):
            yield from self._nearest(queries[at:at + TOGETHER], k, without[at:at + TOGETHER] if without else None)

    def _nearest(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, without: list[int] | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if not self.size:
            yield from ((np.zeros(0, np.int64), np.zeros(0)) for _ in queries)
            return
        if self.place is None:
            self.make_lists()
        n, blocks = len(queries), self.maxima.shape[1]
        on_common = np.zeros((n, len(self.common)), np.float32)
        essential = np.zeros((n, blocks * BLOCK))
        for i, (terms, q) in enumerate(queries):
            place = self.place[terms]
            common = place >= 0
            on_common[i] = np.sqrt(np.bincount(place[common], q[common] * q[common], len(self.common)))
            essential[i] = self.summed(terms[~common], q[~common])
        essential[:, self.size:] = -np.inf
        if without is not None:
            essential[np.arange(n), without] = -np.inf
        # common terms: no more than the block maxima say, and no more than the lengths of both vectors
        lengths = np.sqrt((on_common * on_common).sum(1))
        bound = np.minimum(essential.reshape(n, blocks, BLOCK).max(2) + on_common @ self.maxima,
                           (essential + lengths[:, None] * self.common_lengths).reshape(n, blocks, BLOCK).max(2)) + SLACK
        scores = np.full((n, blocks * BLOCK), -np.inf, np.float32)

        def opened(wanted: np.ndarray) -> None:
            for b in np.flatnonzero(wanted.any(0)):
                own, part = np.flatnonzero(wanted[:, b]), slice(b * BLOCK, (b + 1) * BLOCK)
                scores[own, part] = essential[own, part] + on_common[own] @ self.common[:, part] + np.float32(SLACK)

        first = np.zeros((n, blocks), bool)
        count = min(blocks, max(OPENED_FIRST, -(-k // BLOCK)))
        best = np.argpartition(-bound, count - 1, axis=1)[:, :count]
        first[np.arange(n)[:, None], best] = True
        opened(first)
        # the k-th best of some examples is no better than the k-th best of all
        least = np.full(n, -np.inf)
        for i, query in enumerate(queries):
            least[i] = self.reached(self.on_own(query), essential[i], np.flatnonzero(scores[i] > 0), scores[i], k)
        opened((bound >= least[:, None] - SLACK) & ~first)
        for i, query in enumerate(queries):
            near = np.flatnonzero((scores[i] >= least[i] - SLACK) & (scores[i] > 0))
            dense = self.on_own(query)
            if len(near) > 4 * k:
                near = near[scores[i, near] >= max(least[i], self.reached(dense, essential[i], near, scores[i], k)) - SLACK]
            exact = self.cosines(dense, essential[i], near)
            near, exact = near[exact > 0], exact[exact > 0]
            if len(near) > k:
                last = np.partition(exact, len(exact) - k)[len(exact) - k]
                near, exact = near[exact >= last - 1e-9], exact[exact >= last - 1e-9]
            ranked = np.lexsort((near, -np.round(exact, 9)))
            yield near[ranked], exact[ranked]

    def on_own(self, query: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Weights of a query for every common term; those of other terms meet in a place that no example has."""
        dense = np.zeros(self.common_words + 1)
        dense[self.number[query[0]]] = query[1]
        return dense

    def reached(self, dense: np.ndarray, essential: np.ndarray, near: np.ndarray, bounds: np.ndarray, k: int) -> float:
        """The k-th best cosine of the 2 k examples of ``near`` with the highest bounds."""
        if len(near) < k:
            return -np.inf
        if len(near) > 2 * k:
            near = near[np.argpartition(bounds[near], len(near) - 2 * k)[len(near) - 2 * k:]]
        return float(np.partition(self.cosines(dense, essential, near), len(near) - k)[len(near) - k])

    def cosines(self, dense: np.ndarray, essential: np.ndarray, near: np.ndarray) -> np.ndarray:
        """Exact cosines with some examples: what they have from the essential lists and from their own common terms."""
        first, ends = self.own_starts[near], self.own_starts[near + 1]
        exact, filled = essential[near], ends > first
        if filled.any():
            first, ends = first[filled], ends[filled]
            parts = list(map(slice, first.tolist(), ends.tolist()))
            products = dense.take(np.concatenate([self.own_terms[part] for part in parts]), mode="clip")
            products *= np.concatenate([self.own_values[part] for part in parts])
            places = np.cumsum(ends - first)
            places -= ends - first
            exact[filled] += np.add.reduceat(products, places)
        return exact

    def summed(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Products of every example with the lists of less common terms. An entry is taken as a whole, value and example."""
        first, ends = self.list_starts[terms], self.list_starts[terms + 1]
        lists = [self.lists[lo:hi] for lo, hi in zip(first.tolist(), ends.tolist()) if hi > lo]
        if not lists:
            return np.zeros(self.maxima.shape[1] * BLOCK)
        entries = np.concatenate(lists)
        products = np.repeat(weights, ends - first)
        products *= entries.view(np.float32)[::2]
        return np.bincount(entries.view(np.int32)[1::2], products, self.maxima.shape[1] * BLOCK)


def vote(cosines: np.ndarray, labels: np.ndarray) -> float:
    weights = 1.0 / (1.02 - np.minimum(cosines, 1.0))
    return float((weights * labels).sum() / weights.sum())


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Steps of the best non-decreasing fit of y by x, shrunk by one pseudo-observation of 1/2 a step."""
    steps: list[list[float]] = []                  # sum of y, count, sum of x
    for i in np.argsort(x, kind="stable"):
        steps.append([float(y[i]), 1.0, float(x[i])])
        while len(steps) > 1 and steps[-2][0] * steps[-1][1] >= steps[-1][0] * steps[-2][1]:
            last = steps.pop()
            steps[-1] = [a + b for a, b in zip(steps[-1], last)]
    return np.array([s[2] / s[1] for s in steps]), np.array([(s[0] + 0.5) / (s[1] + 1) for s in steps])


@dataclass
class ToxicityModel:
    """``shipped`` is what tasks read, as plain arrays: sent once, it serves calibration and scoring."""
    hashes: np.ndarray
    weights: np.ndarray
    index: BlockMaxIndex
    labels: np.ndarray
    example_ids: np.ndarray
    no_term_score: float
    neighbours: int = NEIGHBOURS[-1]
    steps: tuple[np.ndarray, np.ndarray] = field(default_factory=lambda: (np.array([0.5]), np.array([0.5])))
    shipped: Broadcast | None = None

    def ship(self, spark: SparkSession, times: np.ndarray | None = None) -> Broadcast:
        """Vectors travel as packed term numbers and ``times`` (how often the terms occur), from which tasks work out the rest."""
        if self.shipped is None:
            starts, times = self.index.starts, np.zeros(0, np.int32) if times is None else times
            vectors = [(packed_numbers(self.index.terms[part]), packed_numbers(times[part]))
                       for first, last in parts_of(starts) for part in [slice(starts[first], starts[last])]]
            self.shipped = spark.sparkContext.broadcast((self.hashes, zlib.compress(self.weights.tobytes(), 1), starts, vectors,
                                                         self.labels, self.example_ids, self.no_term_score))
        return self.shipped

    @classmethod
    def arrived(cls, shipped: Broadcast, *calibrated) -> ToxicityModel:
        hashes, weights, starts, packed, *rest = shipped.value
        weights = np.frombuffer(zlib.decompress(weights))
        # one piece of memory, filled part by part: the system has it back when the lists are made
        vectors = np.empty((2, starts[-1]), np.int32)
        terms, values = vectors[0], vectors[1].view(np.float32)
        for (first, last), (numbers, times) in zip(parts_of(starts), packed):
            part = slice(starts[first], starts[last])
            terms[part] = unpacked_numbers(numbers)
            values[part] = unit_values(starts[first:last + 1] - starts[first], terms[part], unpacked_numbers(times), weights)
        index = BlockMaxIndex(starts, terms, values, len(hashes))
        return cls(hashes, weights, index, *rest, *calibrated)

    def score_many(self, found: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[float, str]]:
        return (self.told(*near) for near in self.index.nearest_many([weighted(*c, self.weights) for c in found], self.neighbours))

    def told(self, ids: np.ndarray, cosines: np.ndarray) -> tuple[float, str]:
        if not len(ids):
            return self.no_term_score, ""
        share = vote(cosines, self.labels[ids])
        told = ",".join(f"{self.example_ids[i]}:{c:.4f}:{int(self.labels[i])}" for i, c in zip(ids[:3], cosines[:3]))
        # the share itself breaks ties inside a flat step
        return min(1.0, max(0.0, 0.98 * float(np.interp(share, *self.steps)) + 0.02 * share)), told


def association(a: np.ndarray, b: np.ndarray, positives: int, negatives: int) -> np.ndarray:
    """Between LEAST_WEIGHT and 1 by the likelihood-ratio statistic of a term in ``a`` toxic and ``b`` clean examples."""
    total = positives + negatives

    def part(seen: np.ndarray, row: np.ndarray, size: int) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1) * total / (np.maximum(row, 1) * size)), 0.0)

    statistic = 2 * (part(a, a + b, positives) + part(b, a + b, negatives)
                     + part(positives - a, total - a - b, positives) + part(negatives - b, total - a - b, negatives))
    statistic = np.maximum(statistic, 0.0)
    return LEAST_WEIGHT + (1 - LEAST_WEIGHT) * statistic / (statistic + HALF_WEIGHT)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def example_labels(labels: DataFrame, max_examples: int) -> DataFrame:
    """At most ``max_examples`` labelled ids outside the held-out part, by a hash of the id."""
    usable = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    return (usable.groupBy(F.col("doc_id").alias("_example")).agg(F.max("toxic").alias("_toxic"))
            .orderBy(F.xxhash64("_example", F.lit("example")), "_example").limit(max_examples))


def fit(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES,
        neighbours: tuple[int, ...] = NEIGHBOURS) -> ToxicityModel:
    spark, chosen = docs.sparkSession, example_labels(labels, max_examples)
    # at most max_examples ids: the one broadcast here has that bound
    examples = held(docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_example"))
                    .select("doc_id", "text", F.col("_toxic").cast("int").alias("toxic")), "toxic-examples")

    def label_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, found, labels_ = Vocabulary(), [], []
        for batch in batches:
            found += [terms for terms, _ in known.counts_of(batch["text"].tolist())]
            labels_ += [int(n) for n in batch["toxic"]]
        terms, inverse = np.unique(np.concatenate([np.zeros(0, np.int64), *found]), return_inverse=True)
        toxic = np.bincount(inverse, np.repeat(labels_, [len(f) for f in found]) if found else None, len(terms)).astype(np.int64)
        yield pd.DataFrame({"term": pd.array(terms, "Int64"), "toxic": toxic, "clean": np.bincount(inverse, minlength=len(terms)) - toxic})
        yield pd.DataFrame({"term": pd.array([None], "Int64"), "toxic": [sum(labels_)], "clean": [len(labels_) - sum(labels_)]})

    counted = held(examples.mapInPandas(label_counts, "term long, toxic long, clean long")
                   .groupBy("term").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b")), "toxic-terms")
    # the row without a term carries the number of examples of each label
    sums = counted.filter("term is null").first()
    positives, negatives = (int(sums["a"] or 0), int(sums["b"] or 0)) if sums else (0, 0)
    if not positives or not negatives:
        return ToxicityModel(np.zeros(0, np.int64), np.zeros(0), BlockMaxIndex.build([], 0), np.zeros(0), np.zeros(0, np.int64), 0.5)
    counts = counted.filter("term is not null").orderBy("term").toArrow()
    hashes = counts["term"].to_numpy()
    weights = association(counts["a"].to_numpy(), counts["b"].to_numpy(), positives, negatives)
    del counts
    vocabulary = spark.sparkContext.broadcast(hashes)
    weights *= inverse_frequencies(docs, vocabulary)

    def example_vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Vocabulary(vocabulary.value)
        for batch in batches:
            found = [(terms[order], times[order]) for terms, times in known.counts_of(batch["text"].tolist()) for order in [np.argsort(terms)]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"], "size": [len(terms) for terms, _ in found],
                                "terms": [packed_numbers(terms) for terms, _ in found], "times": [packed_numbers(times) for _, times in found]})

    vectors = held(examples.mapInPandas(example_vectors, "doc_id long, toxic int, size long, terms binary, times binary"), "toxic-vectors")
    bare = vectors.filter("size = 0").agg(F.count("*"), F.sum("toxic")).first()
    usable = vectors.filter("size > 0")
    size = usable.agg(F.count("*"), F.sum("size")).first()
    # 8 bytes for each term of an example, a part of the examples at a time
    starts, terms, times = np.zeros(size[0] + 1, np.int64), np.zeros(size[1] or 0, np.int32), np.zeros(size[1] or 0, np.int32)
    names, toxic = np.zeros(size[0], np.int64), np.zeros(size[0])
    for n, r in enumerate(usable.toLocalIterator()):
        lo, hi = starts[n], starts[n] + r["size"]
        terms[lo:hi], times[lo:hi] = unpacked_numbers(r["terms"]), unpacked_numbers(r["times"])
        starts[n + 1], names[n], toxic[n] = hi, r["doc_id"], r["toxic"]
    by_name = np.argsort(names, kind="stable")
    starts, terms, times = reordered(starts, terms, times, by_name)
    order = alike_together(starts, terms, unit_values(starts, terms, times, weights), len(hashes))
    starts, terms, times = reordered(starts, terms, times, order)
    names, toxic = names[by_name][order], toxic[by_name][order]
    index = BlockMaxIndex(starts, terms, unit_values(starts, terms, times, weights), len(hashes))
    model = ToxicityModel(hashes, weights, index, toxic, names, ((bare[1] or 0) + 0.5) / (bare[0] + 1))
    model.ship(spark, times)
    if not index.size:
        return model
    shares = left_out_votes(vectors, model, neighbours)
    # squared error of the calibrated votes: the number of neighbours that leaves least of it
    model.neighbours, model.steps = min(((k, isotonic(votes, labels_)) for k, (votes, labels_) in shares.items()),
                                        key=lambda fit_: float(((np.interp(shares[fit_[0]][0], *fit_[1]) - shares[fit_[0]][1]) ** 2).mean()))
    return model


def alike_together(starts: np.ndarray, terms: np.ndarray, values: np.ndarray, words: int) -> np.ndarray:
    """An order that puts examples with the same heaviest common terms side by side, so that block maxima are near their members."""
    seen = np.bincount(terms, minlength=words)
    weight = np.where(seen[terms] * COMMON_SHARE >= len(starts) - 1, values, 0.0)
    owner = np.repeat(np.arange(len(starts) - 1, dtype=np.int32), np.diff(starts))
    ranked = np.lexsort((-weight, owner))
    first = terms[ranked[starts[:-1]]]
    second = terms[ranked[np.minimum(starts[:-1] + 1, starts[1:] - 1)]]
    return np.lexsort((second, first))


def reordered(starts: np.ndarray, terms: np.ndarray, values: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors in another order."""
    sizes = np.diff(starts)[order]
    ends = np.cumsum(sizes)
    out, weights = np.empty_like(terms), np.empty_like(values)
    for n, lo, hi in zip(order.tolist(), (ends - sizes).tolist(), ends.tolist()):
        out[lo:hi], weights[lo:hi] = terms[starts[n]:starts[n + 1]], values[starts[n]:starts[n + 1]]
    return np.concatenate([[0], ends]).astype(np.int64), out, weights


def left_out_votes(vectors: DataFrame, model: ToxicityModel, neighbours: tuple[int, ...]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each number of neighbours the votes of all other examples on each example, and its label. Searches run in tasks."""
    shipped = model.ship(vectors.sparkSession)
    most = max(neighbours)

    def votes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = ToxicityModel.arrived(shipped)
        places = {int(i): n for n, i in enumerate(known.example_ids)}
        for batch in batches:
            queries = [weighted(unpacked_numbers(terms), unpacked_numbers(times), known.weights) for terms, times in zip(batch["terms"], batch["times"])]
            own = [places[int(i)] for i in batch["doc_id"]]
            rows = []
            for place, (ids, cosines) in zip(own, known.index.nearest_many(queries, most, own)):
                rows.append([vote(*first_neighbours(ids, cosines, known.labels, k)) if len(ids) else known.no_term_score for k in neighbours])
            yield pd.DataFrame({"place": own, "votes": rows})

    # every task makes the lists anew, so tasks are few; a row for each example comes back
    spread = vectors.filter("size > 0").select("doc_id", "terms", "times").repartition(max(1, min(64, -(-model.index.size // 1024))))
    found = spread.mapInPandas(votes, "place long, votes array<double>").toPandas().sort_values("place")
    labels = model.labels[found["place"].to_numpy(np.int64)]
    shares = np.array(found["votes"].tolist(), float).reshape(len(found), len(neighbours))
    return {k: (shares[:, i], labels) for i, k in enumerate(neighbours)}


def first_neighbours(ids: np.ndarray, cosines: np.ndarray, labels: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Cosines and labels of the k nearest and those tied with the k-th."""
    keep = cosines >= cosines[k - 1] - 1e-9 if len(cosines) > k else np.ones(len(cosines), bool)
    return cosines[keep], labels[ids[keep]]


def inverse_frequencies(docs: DataFrame, vocabulary) -> np.ndarray:
    """Smoothed inverse document frequency of each term over all documents, from one partial count per task."""

    def document_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, counts, rows = Vocabulary(vocabulary.value), np.zeros(len(vocabulary.value) + 1, np.int64), 0
        for batch in batches:
            rows += len(batch)
            for terms, _ in known.counts_of(batch["text"].tolist()):
                counts[terms] += 1
        counts[-1] = rows
        seen = np.flatnonzero(counts)
        yield pd.DataFrame({"term": seen, "n": counts[seen]})

    found = (docs.select("text").mapInPandas(document_counts, "term long, n long")
             .groupBy("term").agg(F.sum("n").alias("n")).toArrow())
    counts = np.zeros(len(vocabulary.value) + 1, np.int64)
    counts[found["term"].to_numpy()] = found["n"].to_numpy()
    return 1 + np.log((1 + counts[-1]) / (1 + counts[:-1]))


def score(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score, predicted and evidence. The model's size is bounded by the number of examples."""
    shipped, neighbours, steps = model.ship(docs.sparkSession), model.neighbours, model.steps

    @F.pandas_udf("score double, evidence string")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = ToxicityModel.arrived(shipped, neighbours, steps)
        vocabulary = Vocabulary(known.hashes)
        for texts in batches:
            yield pd.DataFrame(known.score_many(vocabulary.counts_of(texts.tolist())), columns=["score", "evidence"])

    return (docs.withColumn("_scored", scored(F.col("text")))
            .withColumn("score", F.col("_scored.score")).withColumn("evidence", F.col("_scored.evidence"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")).drop("_scored"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return (score(docs, model)
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "evidence"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic, with the columns they came with."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    packed = docs.select(F.struct(*docs.columns).alias("_row"), "text")
    return score(packed, model).filter("predicted = 0").select("_row.*")
