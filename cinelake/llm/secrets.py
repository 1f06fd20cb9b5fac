"""Secret scan: three fixed patterns, and password guess-cost dynamic programming on credential-context values.

Base spans (leftmost, non-overlapping per kind, too short ones dropped after matching): ``assign``, ``access``, ``hex``. The
method adds ``guess`` spans: values of at least six characters after a credential word and ``:``, ``=``, ``:=`` or ``=>``. The
word may be a part of a longer name (dbpwd, db_password, api-key_2), any blanks may stand around the sign.

Guess cost of a value, as log10 of the guesses: the least sum over all segmentations into words of a ranked list (their rank;
twice it where look-alike characters are read as letters; twice again with capitals), dates, walks over neighbouring keys or
letters, repeats (the least cost of the unit, times the copies) and brute-force spans (ten guesses a character). A repeat is
a maximal run of copies of a unit of at most MAX_UNIT characters, taken from its start on.

A value is a guess span if it mixes classes of characters and costs at least 10**min_log10, of which 10**MIN_BRUTE by brute
force, or 10**MIN_PHRASE in all; or if it is of one class (prose, unless it is of random letters) and costs at least
10**MIN_PLAIN, of which 10**MIN_BRUTE by brute force. URLs without a user name are none, nor is a value that overlaps a base span.

The word list: frequent passwords, then the words of a public tokenizer's vocabulary in its order, which follows frequency.

Defined results: a null text counts as empty and has no span; repeated rows get equal results; an empty table gives an empty
table; extra columns are not read. Offsets are code points, ends exclusive. Work and memory grow in proportion to the text,
with some hundred bytes for each character of a context value.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The base patterns and their least lengths.
ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")  # runs are maximal either way, so a run of 24 is a match of 24
MIN_ASSIGN, MIN_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "guess")

CONTEXT = re.compile(
    rb"""(pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|auth|(?:api|access|private|client)[_-]?key)"""
    rb"""(?:[_-][a-z0-9]+)*+[0-9]*+["']?[\x20\t]*+(?::=|=>|[:=])[\x20\t]*+["']?([^\s"'<>,;]{6,})""",
    re.IGNORECASE,
)
URL = re.compile(r"[a-z][a-z0-9+.-]*://[^@]*", re.IGNORECASE)
MIN_LOG10, MIN_BRUTE, MIN_PLAIN, MIN_PHRASE = 9.0, 6.0, 14.0, 20.0
MAX_UNIT = 64
WORDS_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# Frequent passwords and password parts, the most frequent first.
COMMON = (
    "password", "123456", "qwerty", "letmein", "admin", "welcome", "changeme", "secret", "default", "monkey", "dragon",
    "iloveyou", "login", "master", "sunshine", "princess", "football", "baseball", "shadow", "superman", "hello",
    "freedom", "whatever", "trustno", "batman", "starwars", "computer", "michael", "jordan", "hunter", "killer",
    "summer", "winter", "spring", "autumn", "monday", "friday", "january", "october", "test", "testing", "example",
    "sample", "dummy", "placeholder", "your", "user", "guest", "root", "pass", "token", "access", "null", "none",
    "true", "false", "redacted", "here", "love", "money", "soccer", "flower", "cookie", "orange", "banana", "cheese",
    "google", "internet", "company", "system", "server", "database", "oracle", "public", "private", "temp", "demo",
)
# Look-alike characters read as letters.
LEET = str.maketrans({"0": "o", "1": "l", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")
STEP = {(row[i], row[i + d]): d for row in ROWS for i in range(len(row)) for d in (1, -1) if 0 <= i + d < len(row)}
DATE = re.compile(
    r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])"
    r"|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)?\d\d"
    r"|(?:19|20)\d\d"
)
DATE_LENGTHS = (10, 8, 6, 4)


def word_list(path: str = WORDS_PATH) -> list[str]:
    """Frequent passwords, then the words of three letters or more of a vocabulary file (base64 token, rank on each line)."""
    with open(path, "rb") as f:
        tokens = [base64.b64decode(line.split()[0]).strip().lower() for line in f if line.strip()]
    words = (t.decode() for t in tokens if len(t) >= 3 and t.isalpha() and t.isascii())
    return list(dict.fromkeys([*COMMON, *words]))


class Guesser:
    """The least guess cost under a list of words, the most frequent first."""

    def __init__(self, words: Sequence[str]):
        self.rank = {w: i + 1 for i, w in enumerate(words)}
        self.lengths = sorted({len(w) for w in self.rank})
        self.cost = lru_cache(maxsize=1 << 14)(self._cost)

    def _words(self, value: str, found: list[list[tuple[int, float]]]) -> None:
        low = value.lower()
        if len(low) != len(value):  # a few letters change length in lower case
            low = value
        plain, n = low.translate(LEET), len(value)
        for start in range(n):
            for size in self.lengths:
                if start + size > n:
                    break
                rank = self.rank.get(low[start : start + size]) or 2 * self.rank.get(plain[start : start + size], 0)
                if rank:
                    upper = 0.0 if value[start : start + size].islower() else math.log10(2)
                    found[start + size].append((start, math.log10(rank) + upper))
            if value[start].isdigit():
                for size in DATE_LENGTHS:
                    if start + size <= n and DATE.fullmatch(value, start, start + size):
                        found[start + size].append((start, math.log10(365 * 150 if size > 4 else 150)))
        start = 0
        while start < n - 2:  # walks over neighbouring keys and letters, either way
            way, end = STEP.get((low[start], low[start + 1])), start + 1
            while way and end + 1 < n and STEP.get((low[end], low[end + 1])) == way:
                end += 1
            if way and end - start >= 2:
                for stop in range(start + 3, end + 2):
                    found[stop].append((start, math.log10(40 * (stop - start))))
            start = max(end, start + 1)

    def _repeats(self, value: str, found: list[list[tuple[int, float]]]) -> None:
        codes = np.frombuffer(value.encode("utf-32-le", "surrogatepass"), np.uint32)
        for unit in range(1, min(MAX_UNIT, len(value) // 2) + 1):
            same = np.flatnonzero(np.diff(np.concatenate([[False], codes[unit:] == codes[:-unit], [False]]).astype(np.int8)))
            for first, end in zip(same[::2].tolist(), same[1::2].tolist()):  # value[first : end + unit] has this period
                copies = (end - first) // unit + 1
                if copies >= (3 if unit == 1 else 2):
                    once = self.cost(value[first : first + unit])[0]
                    for k in range(2, copies + 1):
                        found[first + k * unit].append((first, once + math.log10(k)))

    def _cost(self, value: str) -> tuple[float, float]:
        n = len(value)
        found: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        self._words(value, found)
        self._repeats(value, found)
        best = [(0.0, 0.0)] * (n + 1)
        for end in range(1, n + 1):
            cost, brute = best[end - 1]
            cost, brute = cost + 1.0, brute + 1.0
            for start, c in found[end]:
                if best[start][0] + c < cost:
                    cost, brute = best[start][0] + c, best[start][1]
            best[end] = (cost, brute)
        return best[n]

    def judge(self, value: str, min_log10: float = MIN_LOG10) -> tuple[bool, float]:
        """(whether a value is a secret, its cost)."""
        cost, brute = self.cost(value)
        if URL.fullmatch(value):
            return False, cost
        if _classes(value) < 2:
            return cost >= max(MIN_PLAIN, min_log10) and brute >= MIN_BRUTE, cost
        return cost >= max(MIN_PHRASE, min_log10) or cost >= min_log10 and brute >= MIN_BRUTE, cost


def _classes(value: str) -> int:
    return len({"a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "#" for c in value.strip(".:!?)(")})


WORDS = (b"pass", b"pwd", b"secret", b"token", b"key", b"auth", b"credential")


def find_secrets(text: bytes, guesser: Guesser, min_log10: float = MIN_LOG10) -> tuple[list[tuple[int, int, int]], float]:
    """((start, kind index, end) in bytes, sorted), and the greatest log10 guesses of a context value (0 if none)."""
    spans: list[tuple[int, int, int]] = []
    low = text.lower()
    context = any(w in low for w in WORDS)
    if context:
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= MIN_ASSIGN]
    if b"AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    most = 0.0
    if context:
        spans.sort()
        starts = [x[0] for x in spans]
        reach = np.maximum.accumulate([x[2] for x in spans]).tolist() if spans else []  # furthest end so far
        for m in CONTEXT.finditer(text):
            found, cost = guesser.judge(m[2].decode("utf-8", "replace"), min_log10)
            most = max(most, cost)
            first, end = m.span(2)
            before = bisect_left(starts, end)  # base spans that start before its end
            if found and not (before and reach[before - 1] > first):
                spans.append((first, 3, end))
    return sorted(spans), most


SCHEMA = (
    "n_assign bigint, n_access bigint, n_hex bigint, n_guess bigint, base_sha256 string, spans string, "
    "max_guess_log10 double"
)


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_log10: float = MIN_LOG10, words: Sequence[str] | None = None
) -> DataFrame:
    """One row per row: counts by kind, digest of the base spans, all spans as ``kind:start:end``. words: ranked, by default
    those of WORDS_PATH, which the driver reads."""
    src = docs.select(id_col, text_col)
    out = T.StructType([src.schema[id_col], *T._parse_datatype_string(SCHEMA).fields])
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    shared = docs.sparkSession.sparkContext.broadcast(list(words) if words is not None else word_list())  # some 0.5 MB

    def one(text: bytes, guesser: Guesser) -> tuple:
        spans, most = find_secrets(text, guesser, min_log10)
        names, plain, at, chars = [], [], 0, 0
        points = {}
        for x in sorted({p for s in spans for p in (s[0], s[2])}):  # byte to code point offsets
            chars += len(text[at:x].decode("utf-8", "replace"))
            at = x
            points[x] = chars
        for start, kind, end in spans:
            name = f"{KINDS[kind]}:{points[start]}:{points[end]}"
            names.append(name)
            if kind < 3:
                plain.append(name)
        counts = [sum(k == i for _, k, _ in spans) for i in range(4)]
        return (*counts, hashlib.sha256(",".join(plain).encode()).hexdigest(), ",".join(names), most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        guesser = Guesser(shared.value)
        for b in batches:
            texts = b.column(1).fill_null("").cast(pa.binary())
            rows = [one(t.as_py(), guesser) for t in texts]
            cols = list(zip(*rows)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))], names=[f.name for f in out]
            )

    return src.mapInArrow(run, out)
