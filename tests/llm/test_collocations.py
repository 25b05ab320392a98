"""Phrase mining against a brute-force version."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerline.llm import collocations as co
from tests.llm.cases import LONG, documents, empty, lower_ascii


def brute(rows, least, top=co.TOP, absorb=co.ABSORB):
    """rows of (lang, text)."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower_ascii(text or "")):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        phrases = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in phrases.items():
            if len(p) == 3:
                for part in (p[:2], p[1:]):
                    longer[part] = max(longer[part], a)
        found = []
        for p, a in phrases.items():
            if len(p) == 2 and p in longer and 100 * longer[p] >= absorb * a:
                continue
            score, _, left, right = min((10 ** 6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]])
                                        for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s)
                for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])]
    return sorted(out)


def got(docs, least, top=co.TOP, absorb=co.ABSORB):
    return sorted(tuple(r) for r in co.collocations(docs, least, top, absorb).collect())


def rows_of(docs):
    return [(r.lang, r.text) for r in docs.collect()]


def texts(n, seed=3, words=60):
    rng = random.Random(seed)
    vocabulary = ["The", "of", "a\x01", "a"] + [f"w{i}" for i in range(words)]
    def piece():
        return " ".join(vocabulary[min(len(vocabulary) - 1, int(rng.paretovariate(0.8)) - 1)] for _ in range(rng.randrange(12)))
    return [(i, rng.choice([". ", "\n", " ,", "\t"]).join(piece() for _ in range(rng.randrange(5)))) for i in range(n)]


@pytest.fixture
def many_partitions(spark):
    """Sorted streams cut inside words' and pairs' phrases."""
    settings = {"spark.sql.shuffle.partitions": "29", "spark.sql.adaptive.coalescePartitions.enabled": "false",
                "spark.sql.execution.arrow.maxRecordsPerBatch": "7"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("least, top, absorb", [(1, 2000, 50), (3, 2000, 50), (3, 7, 80)])
def test_against_brute_force(spark, least, top, absorb):
    docs = documents(spark, texts(200)).repartition(3)
    assert got(docs, least, top, absorb) == brute(rows_of(docs), least, top, absorb)


def test_streams_cut_anywhere(spark, many_partitions):
    docs = documents(spark, texts(150, words=8))
    assert got(docs, 2) == brute(rows_of(docs), 2)


def test_edges(spark):
    docs = documents(spark).unionByName(documents(spark, [(20, "Of the,of the of the"), (21, ".,.;"), (22, "a\tb  a b")] * 2))
    for least in (1, 2):
        assert got(docs, least) == brute(rows_of(docs), least)
    assert any(r[0] == "und" for r in got(docs, 2)) and LONG.split()[0] in {r[2].split()[0] for r in got(docs, 1, 10 ** 6)}


def test_empty_and_nothing_frequent(spark):
    assert got(empty(spark), 10) == [] and got(documents(spark, [(1, "one two three")]), 10) == []
    assert co.collocations(empty(spark)).columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_hot_word_and_full_filter(spark, monkeypatch):
    """A third of all words are one word, and the filter is far too small."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["hot", f"x{rng.randrange(30)}", f"y{rng.randrange(30)}"]) for _ in range(30))) for i in range(200)]
    docs = documents(spark, rows).repartition(4)
    want = brute(rows_of(docs), 3)
    assert got(docs, 3) == want
    full = co.phrase_filter
    monkeypatch.setattr(co, "phrase_filter", lambda frequent: full(frequent, 64))
    assert got(docs, 3) == want


def test_filter_loses_nothing(spark):
    phrases = spark.createDataFrame([(f"l{i % 3}", f"a{i} b{i * 7}") for i in range(3000)], "lang string, phrase string")
    table = co.phrase_filter(phrases)
    import pyarrow as pa
    hashes = lambda values: co._hashes(pa.array(values))      # noqa: E731

    def keys(rows):
        return co._key(hashes([r[0] for r in rows]), [hashes([r[1][i] for r in rows]) for i in (0, 1)])
    have = [(r.lang, r.phrase.split(" ")) for r in phrases.collect()]
    assert co._passes(keys(have), table).all()
    others = [(f"l{i % 3}", (f"b{i}", f"a{i}")) for i in range(3000)]
    assert np.mean(co._passes(keys(others), table)) < 0.05


def test_counts_pass_64_bits(spark):
    a = 4 * 10 ** 9                                              # 10^6 a a and l r exceed 64 bits
    rows = [("en", "p", a + 7), ("en", "q", a + 11), ("en", "p q", a)]
    counts = spark.createDataFrame(rows, "lang string, phrase string, f long")
    totals = spark.createDataFrame([("en", 10 ** 12)], "lang string, n long")
    real, co.phrase_counts = co.phrase_counts, lambda docs, least: (counts, totals)
    try:
        row = co.collocations(counts).first()
    finally:
        co.phrase_counts = real
    assert tuple(row) == ("en", 1, "p q", a, a + 7, a + 11, 10 ** 12, 10 ** 6 * a * a // ((a + 7) * (a + 11)))
