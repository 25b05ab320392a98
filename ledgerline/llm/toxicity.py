"""Toxicity by a weighted finite-state pattern grammar.

Five small transducers read a clause word by word and write marks: *insult*
(words and word beginnings learned from labelled documents, each with a
weight), *threat* (verbs of harm), *target* (second and third persons),
*negation* and *reported speech*. Their composition, one automaton over the
marks, scores the clause: an insult's or threat's weight goes to the channel of
the state it is met in (plain, aimed at a target, negated, reported). A
document's score is a logistic function of its channels, so it rests on
matched clauses and their reading, not on isolated words.

*Learning.* Labels are used only from rows whose crc32(doc_id as text) mod 3 is
not 1. Up to ``TRAIN_ROWS`` of them, in the order of a hash of doc_id, are read;
of documents with the same whole text (copies) and the same label one counts, in
the patterns and in the channels' weights, wherever they lie. A
pattern is taken when at least ``PRECISION`` of the documents with it are toxic
and the chance of that is so small that ``MISTAKES`` patterns are expected to
be taken by accident; of nested word beginnings a longer one is taken too if
its weight is higher by ``FINER``. The channels' weights are a ridge logistic
regression on the same rows. Language, source, id and labels
are never inputs of a score.

*Scoring* is one pass: an Aho-Corasick automaton finds the patterns' places in
the whole text, and only clauses around a match are read by the transducers.

Defined cases: null and empty texts get the score of a text without a match;
without usable labels no pattern is known and every score is the base rate;
repeated label rows count once per label; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.storage import materialise

TRAIN_ROWS = 16_000
MISTAKES = 0.1                          # patterns expected to be taken by accident
LEAST_DOCUMENTS = 4
PRECISION = 0.7
FINER = 0.5                             # weight that a longer beginning must add
PREFIXES = range(3, 9)
THRESHOLD = 0.7

# fixed values: words of the grammar in four languages
THREATS = ("kill", "hurt", "destroy", "murder", "beat", "shoot", "stab", "burn", "töten", "umbringen", "schlagen",
           "tuer", "frapper", "détruire", "matar", "golpear", "destruir")
TARGETS = ("you", "your", "yourself", "he", "she", "they", "them", "him", "her", "du", "dich", "dir", "ihr", "euch",
           "tu", "toi", "te", "vous", "tú", "usted", "ustedes", "ti")
NEGATIONS = ("not", "no", "never", "isn", "aren", "wasn", "don", "nicht", "kein", "keine", "nie", "pas", "jamais",
             "ne", "nunca", "ni")
REPORTS = ("said", "says", "say", "called", "quoted", "wrote", "claimed", "reported", "sagte", "sagt", "schrieb",
           "nannte", "dit", "disait", "écrit", "dijo", "dice", "escribió", "llamó")

CHANNELS = ("plain", "aimed", "negated", "reported", "threat")
NEGATION_REACH = 3                      # words that a negation reaches

_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE_END = re.compile(r"[.!?;:\n,]")


class Transducer:
    """Word to (mark, weight): whole words, and beginnings of words."""

    def __init__(self, mark: str, words: dict[str, float], beginnings: dict[str, float] | None = None):
        self.mark, self.words, self.beginnings = mark, words, beginnings or {}
        self._lengths = sorted({len(b) for b in self.beginnings}, reverse=True)

    def __call__(self, word: str) -> float | None:
        weight = self.words.get(word)
        for n in self._lengths if weight is None else ():
            weight = self.beginnings.get(word[:n])
            if weight is not None:
                break
        return weight


class Grammar:
    """The composition of the five transducers over a clause."""

    def __init__(self, words: dict[str, float], beginnings: dict[str, float]):
        self.parts = (Transducer("insult", words, beginnings), Transducer("threat", dict.fromkeys(THREATS, 1.0)),
                      Transducer("target", dict.fromkeys(TARGETS, 0.0)),
                      Transducer("negation", dict.fromkeys(NEGATIONS, 0.0)),
                      Transducer("report", dict.fromkeys(REPORTS, 0.0)))

    def clause(self, words: list[str], quoted: bool = False) -> np.ndarray:
        """Weights by channel. The state is (words since a negation, reported
        speech open); whether a target is in the clause is known at its end."""
        out = np.zeros(len(CHANNELS))
        since, reported, aimed, hits = NEGATION_REACH + 1, quoted, False, []
        for word in words:
            since += 1
            for part in self.parts:
                weight = part(word)
                if weight is None:
                    continue
                if part.mark == "negation":
                    since = 0
                elif part.mark == "report":
                    reported = True
                elif part.mark == "target":
                    aimed = True
                else:
                    hits.append((part.mark, weight, since <= NEGATION_REACH, reported))
                break
        for mark, weight, negated, said in hits:
            if mark == "threat" and not aimed:
                continue
            channel = 3 if said else 2 if negated else 4 if mark == "threat" else 1 if aimed else 0
            out[channel] = max(out[channel], weight)
        return out


class Scanner:
    """Channels of a document: clauses around the places of patterns."""

    def __init__(self, grammar: Grammar):
        import ahocorasick
        self.grammar = grammar
        self._find = ahocorasick.Automaton()
        insult, threat = grammar.parts[:2]
        for text in {*insult.words, *insult.beginnings, *threat.words}:
            self._find.add_word(text, len(text))
        self._some = len(self._find) > 0
        if self._some:
            self._find.make_automaton()

    def channels(self, text: str) -> np.ndarray:
        out = np.zeros(len(CHANNELS))
        if not self._some or not text:
            return out
        lower, done = text.lower(), 0
        for last, size in self._find.iter(lower):
            start = last - size + 1
            if start < done or (start and lower[start - 1].isalpha()):
                continue
            a = max((lower.rfind(c, done, start) for c in ".!?;:\n,"), default=-1) + 1
            end = _CLAUSE_END.search(lower, last + 1)
            b = end.start() if end else len(lower)
            clause = lower[max(a, done):b]
            found = self.grammar.clause(_WORD.findall(clause), quoted='"' in clause[:start - max(a, done)])
            out = np.maximum(out, found)
            done = b
        return out


def features(channels: np.ndarray) -> np.ndarray:
    """The strongest clause of each channel, and of all plain readings."""
    return np.concatenate([channels, channels[..., :3].max(axis=-1, keepdims=True)], axis=-1)


@dataclass
class Model:
    words: dict[str, float]
    beginnings: dict[str, float]
    intercept: float
    weights: np.ndarray

    def score(self, channels: np.ndarray) -> float:
        z = self.intercept + float(features(channels) @ self.weights)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _rare(n: int, k: int, p: float) -> float:
    """Upper bound of P(at least k of n) for chance p (Chernoff)."""
    share = k / n
    if share <= p:
        return 1.0
    if share == 1:
        return p ** n
    return math.exp(-n * (share * math.log(share / p) + (1 - share) * math.log((1 - share) / (1 - p))))


def _rarer_than(chance: float, p: float):
    """Keeps the patterns whose toxic documents are rarer than ``chance``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = {name: i for i, name in enumerate(batch.schema.names)}
            n, k = batch.column(at["documents"]).to_pylist(), batch.column(at["toxic"]).to_pylist()
            yield batch.filter(pa.array([_rare(a, b, p) <= chance for a, b in zip(n, k)], pa.bool_()))
    return run


def _pattern_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(pattern, toxic, documents) of a partition; ``=w`` is a whole word. Also
    one row without pattern with all its documents. Texts without a word are
    no documents here."""
    toxic_counts, counts = Counter(), Counter()
    totals = [0, 0]
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if not text.strip(" \t\n\v\f\r"):
                continue
            found = set(_WORD.findall(text.lower()))
            patterns = {"=" + w for w in found if len(w) >= 3} | {w[:n] for w in found for n in PREFIXES if len(w) > n}
            counts.update(patterns)
            if toxic:
                toxic_counts.update(patterns)
            totals[toxic] += 1
    rows = [("", totals[1], totals[0] + totals[1]), *((p, toxic_counts[p], n) for p, n in counts.items())]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(
        (pa.string(), pa.int64(), pa.int64()))], ["pattern", "toxic", "documents"])


def learnable(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Label rows that may be learned from."""
    return labels.filter(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 != 1)


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """Written (text, toxic) of the bounded training sample, one row for each
    text and label: rows are dealt by a digest of the whole text, and a task
    sends one row of each group, so a large one doesn't gather in a task."""
    sample = (learnable(labels).filter(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
              .select(F.col("doc_id").alias("labelled"), "toxic"))
    return materialise(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
                       .join(F.broadcast(sample), F.col("doc_id") == F.col("labelled"))
                       .groupBy(F.sha2("text", 256).alias("copy"), "toxic").agg(F.first("text").alias("text"))
                       .select("text", "toxic"), "toxicity-sample")


def learn_patterns(sample: DataFrame) -> tuple[dict[str, float], dict[str, float]]:
    """Insult words and word beginnings with their weights (log odds)."""
    counts = materialise(
        sample.mapInArrow(_pattern_counts, "pattern string, toxic long, documents long")
        .groupBy("pattern").agg(F.sum("toxic").alias("toxic"), F.sum("documents").alias("documents"))
        .filter(F.col("toxic") > 0), "toxicity-patterns")
    total = counts.filter(F.col("pattern") == "").collect()
    if not total or total[0].toxic in (0, total[0].documents):
        return {}, {}
    p = total[0].toxic / total[0].documents
    tests = counts.filter(F.col("documents") >= LEAST_DOCUMENTS).count()
    chance = MISTAKES / max(1, tests)
    # the tasks test every candidate, so only patterns of the grammar reach the driver
    fit = (counts.filter((F.col("pattern") != "") & (F.col("toxic") >= PRECISION * F.col("documents"))
                         & (F.col("toxic") >= LEAST_DOCUMENTS) & (F.col("toxic") >= math.log(chance) / math.log(p)))
           .mapInArrow(_rarer_than(chance, p), counts.schema)
           .orderBy(F.col("toxic").desc(), F.length("pattern"), "pattern").collect())
    good = {r.pattern: math.log((r.toxic + 0.5) / (r.documents - r.toxic + 0.5) * (1 - p) / p) for r in fit}
    support = {r.pattern: r.toxic for r in fit}
    beginnings: dict[str, float] = {}

    def shorter(text: str) -> float:
        return max((beginnings.get(text[:n], -math.inf) for n in range(1, len(text))), default=-math.inf)

    for b in sorted((b for b in good if b[0] != "="), key=len):
        if good[b] > shorter(b) + FINER:
            beginnings[b] = good[b]
    # a beginning that only one word has is that word
    words = {w[1:]: good[w] for w in good if w[0] == "="}
    for b in list(beginnings):
        same = [w for w in words if w.startswith(b) and support["=" + w] == support[b]]
        if same:
            del beginnings[b]
    words = {w: x for w, x in words.items() if x > shorter(w) + FINER}
    return words, beginnings


def _fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, np.ndarray]:
    """Ridge logistic regression by Newton steps."""
    design = np.column_stack([np.ones(len(x)), x])
    penalty = np.diag([1e-6, *[ridge] * x.shape[1]])
    w = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + penalty,
                               design.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), w[1:]


def _channel_batches(words: dict[str, float], beginnings: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(Grammar(words, beginnings))
        for batch in batches:
            found = [scanner.channels(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column(1)],
                                             ["channels", "toxic"])
    return run


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """The grammar and its weights; what reaches the driver is bounded by the
    ``TRAIN_ROWS`` documents of the sample: their rows of channels, and those of their
    patterns that pass the test (no number of patterns is set)."""
    sample = training_rows(docs, labels)
    words, beginnings = learn_patterns(sample)
    rows = sample.mapInArrow(_channel_batches(words, beginnings), "channels array<double>, toxic int").collect()
    y = np.array([r.toxic for r in rows], dtype=float)
    x = features(np.array([r.channels for r in rows], dtype=float).reshape(-1, len(CHANNELS)))
    if len(y) == 0 or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1)
        return Model(words, beginnings, math.log(rate / (1 - rate)), np.zeros(len(CHANNELS) + 1))
    intercept, weights = _fit(x, y)
    return Model(words, beginnings, intercept, weights)


def _score_batches(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(Grammar(model.words, model.beginnings))
        for batch in batches:
            scores = [model.score(scanner.channels(t.as_py() or "")) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])
    return run


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    model = learn(docs, labels)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("score", T.DoubleType())])
    scored = docs.select("doc_id", "text").mapInArrow(_score_batches(model), schema)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    return scored.select("doc_id", (F.crc32(key) % 3 == 1).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
