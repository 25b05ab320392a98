"""Secrets in texts: fixed patterns, and values in a credential context that
would be hard to guess.

Base spans, per kind leftmost and non-overlapping over the whole text: *assign*
(a credential name, ``:`` or ``=`` and a value of 6 or more characters), *access*
(AKIA and capitals or digits, 20 or more in all), *hex* (24 or more lower-case
hex digits).

Added spans (*guess*): the value after a wider set of credential names is scored
by the number of guesses that its cheapest explanation takes, as password
strength meters do. Dynamic programming over the value's positions finds the
minimum-cost segmentation into dictionary words (also reversed, capitalised or
with digits for letters), dates, repeats of units of up to ``LONGEST_UNIT``, walks
over keyboard or alphabet rows, and brute-force spans: pieces from every start to every
end. A value that takes ``MIN_GUESSES`` (log10) or more and isn't inside a base span
is added.

The dictionary is a fixed list of common passwords and, after it, the words of the
documents by the number of documents that hold them, counted over all whole texts:
the most frequent, up to ``DICTIONARY`` (a bound on the model, 24 letters each), of those
in at least ``WORD_DOCUMENTS`` documents, so that a value planted once is no word.

Positions are code points, ends exclusive. Null and empty texts have no spans;
repeated rows each get a result; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import datetime
import hashlib
import itertools
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.storage import materialise

MIN_GUESSES = 10.0
DICTIONARY = 20_000
WORD_DOCUMENTS = 5
LONGEST_UNIT = 32
_CLASSES_PER_DOUBLING = 64

KINDS = ("assign", "access", "hex", "guess")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII)
_ASSIGN_NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CONTEXT = re.compile(
    r"""(?<![A-Za-z])(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|credentials?|auth
        |(?:api|access|private|client|encryption)[_ -]?key)["']?[ \t]{0,8}[:=][ \t]{0,8}["']?([^\s"',;<>]{6,})""",
    re.IGNORECASE | re.ASCII | re.VERBOSE)
_CONTEXT_NAMES = ("pass", "pwd", "pin", "secret", "token", "credential", "auth", "key")

# fixed values: common passwords and words, the most common first
COMMON_WORDS = (
    "password", "qwerty", "dragon", "monkey", "letmein", "football", "iloveyou", "admin", "welcome", "login",
    "master", "sunshine", "princess", "shadow", "baseball", "superman", "michael", "jordan", "hunter", "secret",
    "summer", "winter", "spring", "autumn", "test", "user", "root", "guest", "default", "changeme",
    "love", "hello", "freedom", "whatever", "trustno", "batman", "flower", "cheese", "orange", "purple",
    "january", "february", "march", "april", "june", "july", "august", "september", "october", "november",
    "december", "monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday", "company", "server",
    "database", "system", "public", "private", "access", "token", "example", "sample", "temp", "demo",
    "the", "and", "for", "you", "not", "this", "that", "with", "from", "have",
)
# fixed values: rows of a keyboard and the alphabet
_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz")
_LEET = str.maketrans("@4301$57", "aaeolsst")

_STEPS = {a + b for row in _ROWS for a, b in zip(row, row[1:])}
_STEPS |= {b + a for a, b in (s for s in _STEPS)}
_STEPS |= {a + b for up, down in zip(_ROWS[:3], _ROWS[1:4]) for a, b in zip(up, down)}
_WALK_STARTS, _WALK_DEGREE = 47, 4
_YEAR = re.compile(r"(?:19|20)\d\d")
_DATE = re.compile(r"\d{4}([-/._]?)\d{1,2}\1\d{1,2}|\d{1,2}([-/._]?)\d{1,2}\2\d{4}")
_CLASSES = ((re.compile(r"[a-z]"), 26), (re.compile(r"[A-Z]"), 26), (re.compile(r"[0-9]"), 10),
            (re.compile(r"[^A-Za-z0-9]"), 33))
_SEGMENT = math.log10(2)                # what one more segment costs


class _Starts:
    """Starts i of pieces that cost base_i + log10((j - i) / unit) up to j. Of two
    starts the earlier one gains on the later as j grows, so a later start that is
    not ahead is never ahead again, and an earlier one with the larger base never is."""

    def __init__(self, unit: int = 1):
        self.unit, self.held = unit, []

    def add(self, i: int, base: float) -> None:
        while self.held and self.held[-1][1] >= base:
            self.held.pop()
        self.held.append((i, base))

    def least(self, j: int) -> float:
        best, ahead = math.inf, []
        for i, base in self.held:
            cost = base + math.log10((j - i) / self.unit)
            if cost < best:
                best = cost
                ahead.append((i, base))
        self.held = ahead
        return best


class _Walks:
    """The walk that a value's position is in: 3 or more characters, each a step from the last."""

    def __init__(self, value: str):
        self.lower, self.first = value.lower(), 0
        if len(self.lower) != len(value):           # a letter whose small form is longer
            self.lower = value
        self.turns, self.way = [0], None            # direction changes up to each step of the walk
        self.starts = _Starts()

    def least(self, j: int, best: list[float]) -> float:
        """Of the pieces that end before ``j``."""
        if j < 2 or self.lower[j - 2:j] not in _STEPS:
            self.first, self.turns, self.way, self.starts = j - 1, [0], None, _Starts()
            return math.inf
        step = ord(self.lower[j - 1]) - ord(self.lower[j - 2])
        self.turns.append(self.turns[-1] + (self.way is not None and step != self.way))
        self.way = step
        i = j - 3
        if i < self.first:
            return math.inf
        # turns inside a piece: those after its first step
        self.starts.add(i, best[i] - self.turns[i - self.first + 1] * math.log10(_WALK_DEGREE))
        return self.starts.least(j) + self.turns[-1] * math.log10(_WALK_DEGREE) + math.log10(_WALK_STARTS)


class _Repeats:
    """The run of one period that a value's position is in. The units of a run
    are turns of one another, so all have the same characters and cost."""

    def __init__(self, value: str, unit: int, brute):
        self.value, self.unit, self.brute = value, unit, brute
        self.reset(0)

    def reset(self, first: int) -> None:
        self.first, self.cost, self.starts = first, None, {}

    def least(self, j: int, best: list[float]) -> float:
        u = self.unit
        if j <= u:
            return math.inf
        if self.value[j - 1] != self.value[j - 1 - u]:
            self.reset(j - u)
            return math.inf
        i = j - 2 * u
        if i < self.first:
            return math.inf
        if self.cost is None:
            self.cost = self.brute(self.value[j - u:j])
        starts = self.starts.setdefault(j % u, _Starts(u))
        starts.add(i, best[i])
        return starts.least(j) + self.cost


class GuessCost:
    """log10 of the guesses that the cheapest segmentation of a value takes."""

    def __init__(self, words: tuple[str, ...] = COMMON_WORDS, this_year: int = 2025):
        self.rank = {w: i + 1 for i, w in reversed(list(enumerate(words)))}
        self.longest = max(map(len, words), default=0)
        self.this_year = this_year

    def _words(self, value: str) -> Iterator[tuple[int, int, float]]:
        lower = value.lower()
        plain = lower.translate(_LEET)
        for i in range(len(value)):
            for j in range(i + 3, min(len(value), i + self.longest) + 1):
                part = lower[i:j]
                for text, factor in ((part, 1), (plain[i:j], 4), (part[::-1], 2)):
                    rank = self.rank.get(text)
                    if rank:
                        if value[i:j] != part:
                            factor *= 2
                        yield i, j, math.log10(rank * factor)
                        break

    def _date(self, text: str) -> float | None:
        """Cost of a year or a whole date."""
        if _YEAR.fullmatch(text):
            return math.log10(max(20, abs(int(text) - self.this_year)))
        if not _DATE.fullmatch(text):
            return None
        parts = re.findall(r"\d+", text)
        marked = len(parts) > 1
        if not marked:
            if len(text) != 8:
                return None
            parts = [text[:4], text[4:6], text[6:]] if text[:2] in ("19", "20") else [text[:2], text[2:4], text[4:]]
        year = next((int(p) for p in parts if len(p) == 4), None)
        a, b = (int(p) for p in parts if len(p) != 4) if year is not None and len(parts) == 3 else (0, 0)
        if not any(self._is_date(year, x, y) for x, y in ((a, b), (b, a))):
            return None
        return math.log10(365 * max(20, abs(year - self.this_year)) * (4 if marked else 1))

    def _dates(self, value: str) -> Iterator[tuple[int, int, float]]:
        for i, char in enumerate(value):
            if char.isdigit():
                for length in (4, 6, 7, 8, 9, 10):
                    cost = self._date(value[i:i + length]) if i + length <= len(value) else None
                    if cost is not None:
                        yield i, i + length, cost

    @staticmethod
    def _is_date(year: int | None, month: int, day: int) -> bool:
        try:
            datetime.date(year or 0, month, day)
        except ValueError:
            return False
        return True

    @staticmethod
    def _alphabet(text: str) -> float:
        return math.log10(sum(size for pattern, size in _CLASSES if pattern.search(text)) or 1)

    def _brute(self, text: str) -> float:
        return len(text) * self._alphabet(text)

    def __call__(self, value: str) -> float:
        n = len(value)
        per_char = self._alphabet(value)
        into: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
        for find in (self._words, self._dates):
            for i, j, cost in find(value):
                into[j].append((i, cost))
        runs = [_Walks(value), *(_Repeats(value, u, self._brute) for u in range(1, min(LONGEST_UNIT, n // 2) + 1))]
        best = [0.0] * (n + 1)
        open_ = 0.0                     # least cost of a brute-force span from before, less its length
        for j in range(1, n + 1):
            cost = open_ + j * per_char + _SEGMENT
            for i, match in into[j]:
                cost = min(cost, best[i] + match + _SEGMENT)
            for run in runs:
                cost = min(cost, run.least(j, best) + _SEGMENT)
            best[j] = cost
            open_ = min(open_, cost - j * per_char)
        return best[n] - _SEGMENT if n else 0.0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end), sorted."""
    lower = text.lower()
    spans = []
    if any(name in lower for name in _ASSIGN_NAMES):
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(spans)


def guess_spans(text: str, covered: list[tuple[int, int, int]], cost: GuessCost,
                least: float = MIN_GUESSES) -> list[tuple[int, int, int]]:
    lower = text.lower()
    if not any(name in lower for name in _CONTEXT_NAMES):
        return []
    return [(m.start(1), 3, m.end(1)) for m in _CONTEXT.finditer(text)
            if not any(a <= m.start(1) and m.end(1) <= b for a, _, b in covered) and cost(m.group(1)) >= least]


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


def _scan(least: float, words: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost = GuessCost(words)
        for batch in batches:
            counts, digests, joined = ([], [], []), [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                base = base_spans(text)
                for kind in range(3):
                    counts[kind].append(sum(k == kind for _, k, _ in base))
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                joined.append(_joined(sorted(base + guess_spans(text, base, cost, least))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()),
                 pa.array(joined, pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
    return run


def corpus_words(docs: DataFrame, size: int = DICTIONARY, least: int = WORD_DOCUMENTS) -> tuple[str, ...]:
    """The words (runs of 3 to 24 letters, in small letters) that most rows hold, of
    those that ``least`` rows or more hold, by rows, then by word. Words fall into classes
    of about equal rows (``_CLASSES_PER_DOUBLING``); whole classes are taken, the most
    frequent first, as long as all of them are ``size`` words or fewer, so no more than
    these reach the driver. Each row counts a word once; counts are combined by each task
    before they are shuffled."""
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))
    counts = materialise(docs.select(F.explode(words).alias("word")).filter(F.length("word").between(3, 24))
                         .groupBy("word").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") >= least), "word-rows")
    # at most 64 doublings of classes
    classes = (counts.groupBy(F.floor(F.log2("rows") * _CLASSES_PER_DOUBLING).alias("class"))
               .agg(F.count(F.lit(1)).alias("words"), F.min("rows").alias("fewest")).orderBy(F.desc("class")).collect())
    fewest = [c.fewest for c, n in zip(classes, itertools.accumulate(c.words for c in classes)) if n <= size]
    if not fewest:
        return ()
    return tuple(r.word for r in sorted(counts.filter(F.col("rows") >= fewest[-1]).collect(),
                                        key=lambda r: (-r.rows, r.word)))


def find_secrets(docs: DataFrame, least: float = MIN_GUESSES, words: tuple[str, ...] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex,
    base_sha256 (of the base spans as kind:start:end, comma-joined), spans (all
    spans, joined likewise). ``words``: a dictionary, most common first; without one
    it is made of the documents by a pass before the scan."""
    if words is None:
        words = tuple(dict.fromkeys(COMMON_WORDS + corpus_words(docs)))
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(
        "n_assign long, n_access long, n_hex long, base_sha256 string, spans string").fields])
    return docs.select("doc_id", "text").mapInArrow(_scan(least, words), schema)
