"""Secret scans by token efficiency.

Plain patterns find assignments of passwords and tokens, access keys and long hexadecimal strings. Beyond these, a run of
at least ``LEAST_RUN`` key characters is taken for a random string if a byte-pair vocabulary needs many tokens for it:
fewer characters a token than ``LEAST_RATIO`` (from 20 characters on; less for shorter ones, see ``SHORTER``), where words
and names have four and more. If the whole run is not, each of its parts between "-", "_", ".", "/", "=" and "+" of that
length is looked at alone. Not looked at are what lies inside a span of the plain patterns, digits alone, known digests
(32, 40, 56, 64, 96 or 128 hexadecimal characters), UUIDs, and runs whose parts are all plain: numbers of up to eight
digits, words of up to seven letters, and longer words (up to four digits behind) that take few tokens themselves.
Random strings of fewer characters than ``LEAST_RUN`` are too short to tell by their tokens.

The vocabulary is a parameter. The driver reads its file once and ships its bytes, a fixed size.

Spans count code points, ends are exclusive. Defined results: a NULL or empty text has no span; texts of any length are
read whole; repeated rows are scanned alike; ``doc_id`` and other columns are not read.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from hashlib import sha256

import pandas as pd
import tiktoken
from pyspark.sql import DataFrame, SparkSession, functions as F

from demandgrid.llm.common import table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How a text is cut before byte pairs are merged: contractions, words, numbers, other signs, blanks.
PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KINDS = ("assign", "access", "hex", "random")
LEAST_RUN = 12
LEAST_RATIO = 2.3
#: Length below which a smaller share of LEAST_RATIO holds; few tokens vary more, in words and in random strings.
SHORTER = ((12, 2.0 / 2.3), (16, 1.75 / 2.3), (20, 2.0 / 2.3))
SHORT_WORD = 7

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# runs of fewer characters would be dropped anyway
HEX = re.compile(r"[0-9a-f]{24,}")
RUN = re.compile(rf"[A-Za-z0-9+/_=.-]{{{LEAST_RUN},}}")
DIGEST = re.compile(r"[0-9a-fA-F]+")
DIGEST_SIZES = {32, 40, 56, 64, 96, 128}
UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
NAME_PART = re.compile(r"[A-Za-z]+[0-9]{0,4}|[0-9]{1,8}")
PART = re.compile(r"[A-Za-z0-9]+")

Span = tuple[int, int, str]


def base_spans(text: str) -> list[Span]:
    found: list[Span] = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return found + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def known(run: str) -> bool:
    """Whether a run is a digest or a UUID."""
    return bool(DIGEST.fullmatch(run) and len(run) in DIGEST_SIZES or UUID.fullmatch(run))


def latin(c: str) -> bool:
    return "À" <= c <= "ɏ"


class Scanner:
    def __init__(self, ranks: dict[bytes, int], least_ratio: float):
        self.encoding = tiktoken.Encoding("secrets", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        self.least_ratio = least_ratio

    def efficient(self, run: str) -> bool:
        """Whether the vocabulary has long tokens for a run."""
        least = self.least_ratio * next((share for below, share in SHORTER if len(run) < below), 1.0)
        return len(run) >= least * len(self.encoding.encode_ordinary(run))

    def plain(self, part: str) -> bool:
        if known(part):
            return True
        if not NAME_PART.fullmatch(part):
            return False
        return part.isdigit() or len(part.rstrip("0123456789")) <= SHORT_WORD or self.efficient(part)

    def random_parts(self, run: str) -> list[tuple[int, int]]:
        """Places in a run that are random: all of it, or parts of it."""
        if known(run) or run.isdigit():
            return []
        # UUIDs are no parts; blanks keep the places
        rest = UUID.sub(lambda m: " " * len(m[0]), run)
        parts = [(m.start(), m.end(), m[0]) for m in PART.finditer(rest)]
        if all(self.plain(p) for _, _, p in parts):
            return []
        if rest == run and not self.efficient(run):
            return [(0, len(run))]
        return [(a, b) for a, b, p in parts
                if b - a >= LEAST_RUN and not p.isdigit() and not self.plain(p) and not self.efficient(p)]

    def spans(self, text: str | None) -> list[Span]:
        """Spans by start, then kind."""
        if not text:
            return []
        found = base_spans(text)
        base = sorted(found)
        for m in RUN.finditer(text):
            run = m[0].strip(".-/=")
            start = m.start() + m[0].index(run) if run else m.start()
            end = start + len(run)
            if len(run) < LEAST_RUN or any(a < end and start < b for a, b, _ in base):
                continue
            if run.isalpha() and len(run) < 20 and (latin(text[start - 1:start]) or latin(text[end:end + 1])):
                continue   # the rest of a word with accents
            found += [(start + a, start + b, "random") for a, b in self.random_parts(run)]
        return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def told(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


def read_ranks(spark: SparkSession, path: str) -> bytes:
    """Bytes of a vocabulary file of tiktoken's format, from any file system Spark can read."""
    with_scheme = path if re.match(r"\w+:", path) else f"file://{path}"
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(with_scheme)
    stream = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(hadoop)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def parsed_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


def scanned(docs: DataFrame, vocabulary: str = VOCABULARY, least_ratio: float = LEAST_RATIO) -> DataFrame:
    """``docs`` with ``_found``: counts of the plain kinds, their digest, and all spans as text and as an array."""
    data = docs.sparkSession.sparkContext.broadcast(read_ranks(docs.sparkSession, vocabulary))

    @F.pandas_udf("n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(parsed_ranks(data.value), least_ratio)
        for texts in batches:
            rows = []
            for text in texts:
                spans = scanner.spans(text)
                base = [s for s in spans if s[2] != "random"]
                kinds = [s[2] for s in base]
                rows.append((*(kinds.count(k) for k in KINDS[:3]), sha256(told(base).encode()).hexdigest(), told(spans)))
            yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.withColumn("_found", found("text"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scanned(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "_found.*")
