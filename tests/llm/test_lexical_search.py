"""Ranked search against a brute-force version."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import lexical_search as ls
from ledgerline.llm.storage import materialise
from tests.llm.cases import documents, empty, lower_ascii

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def items(spark, rows):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "item_id long, text string, rank int, doc_id string")


def brute(docs, queries, k):
    counted = [(i, Counter(TERM.findall(lower_ascii(t or "")))) for i, t in docs]
    n_docs = sum(1 for _, c in counted if c)
    n_terms = sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    wanted = {}
    for item, text in queries:
        wanted.setdefault(item, set()).update(TERM.findall(lower_ascii(text or "")))
    out = []
    for item, terms in wanted.items():
        scored = []
        for i, c in counted:
            m = 50 + 50 * sum(c.values()) * n_docs // n_terms if n_terms else 0
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in terms if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, row[3], -row[0]) for r, row in enumerate(sorted(scored, key=lambda r: r[:3])[:k])]
    return sorted(out, key=repr)


def got(docs, queries, k, block_docs=ls.BLOCK_DOCS, block_postings=ls.BLOCK_POSTINGS, portion=ls.PORTION_TERMS):
    lengths = ls.corpus_lengths(docs)
    index = ls.build_index(docs, lengths, block_docs, block_postings)
    return sorted((tuple(r) for r in ls.search(index, lengths, queries, k, portion).collect()), key=repr)


def texts(n, seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    return [(i, " ".join(words[min(399, int(rng.paretovariate(0.6)))] for _ in range(rng.randrange(0, 60)))) for i in range(n)]


@pytest.mark.parametrize("block_docs, block_postings, portion", [(ls.BLOCK_DOCS, ls.BLOCK_POSTINGS, ls.PORTION_TERMS), (37, 500, 40), (1, 1, 5)])
def test_against_brute_force(spark, block_docs, block_postings, portion):
    rows = texts(300 if block_docs > 1 else 40)
    queries = [(i, t) for i, t in texts(25, seed=2)] + [(100, "w1"), (101, "none such"), (102, "w399 W399 w3 w399")]
    docs = documents(spark, rows).repartition(3)
    assert got(docs, items(spark, queries), 10, block_docs, block_postings, portion) == brute(rows, queries, 10)


def test_edges_ties_and_repeated_rows(spark):
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    queries = [(1, "Fox DOG é"), (1, "word1x1 odd"), (None, "two bytes"), (2, None), (3, ""), (4, "..."), (5, "é" * 40_000)]
    for k in (1, 3, 50):
        for block_docs in (2, 8192):
            assert got(docs, items(spark, queries), k, block_docs) == brute(rows, queries, k)


def test_hot_group_of_copies(spark):
    rows = [(i * 7 % 600, "hot copy text w1 w2" if i % 3 == 0 else f"text w{i % 50} w{i}") for i in range(600)]
    queries = [(1, "hot copy"), (2, "text w1 w2 w3"), (3, "w599")]
    assert got(documents(spark, rows).repartition(5), items(spark, queries), 5, 64) == brute(rows, queries, 5)


def test_empty_tables(spark):
    docs = documents(spark)
    assert ls.rank_documents(empty(spark), items(spark, [(1, "fox")])).count() == 0
    assert ls.rank_documents(docs, items(spark, [])).count() == 0
    assert ls.rank_documents(docs, items(spark, [(1, "fox")])).columns == ["item_id", "rank", "doc_id", "score"]


def test_tree_holds_every_maximum():
    rng = np.random.default_rng(5)
    cells = np.unique(rng.integers(0, 100 * 16, 300))
    rows, cols, values = cells // 16, cells % 16, rng.integers(1, 1000, len(cells))
    masks, maxima, tops = ls.build_tree(rows, cols, values, 4)
    for depth, best in enumerate(maxima):
        side = 4 - depth
        want = {}
        for r, c, v in zip(rows >> side, cols >> side, values):
            want[r, c] = max(want.get((r, c), 0), v)
        assert sorted(want.values()) == sorted(best.tolist())
        if depth < 4:
            assert sum(bin(m).count("1") for m in masks[depth]) == len(maxima[depth + 1])
    assert tops.tolist() == sorted(set(rows >> 4))


def test_search_is_cut_off_by_the_maxima(spark):
    """One document has the rare terms: ranges without them are not opened."""
    rows = [(i, "common words here" + (" rare unusual" if i == 777 else "")) for i in range(4096)]
    docs = documents(spark, rows).coalesce(1)
    lengths = ls.corpus_lengths(docs)
    block = ls.Block(materialise(ls.build_index(docs, lengths), "t").first().asDict())
    opened = []
    block.first = Counted(block.first, opened)
    terms = ls.word_hashes(np.frombuffer(b"common rare unusual", np.uint8), np.array([0, 7, 12]), np.array([6, 11, 19]))
    found = block.search(terms, np.array([1, 9000, 9000]), 1, [])
    assert found[0][2] == 777 and sum(opened) < 4095 // 2         # of 4,095 inner ranges


class Counted:
    """Counts the ranges whose children are looked up."""

    def __init__(self, values, log):
        self.values, self.log = values, log

    def __getitem__(self, at):
        self.log.append(len(at))
        return self.values[at]
