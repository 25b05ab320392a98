"""Toxicity: the grammar's channels, learning without held-out labels,
held-out accuracy, edge cases."""

import zlib

import pytest

from ledgerline.llm import toxicity as tx
from tests.llm.cases import documents, empty

GRAMMAR = tx.Grammar({"fool": 4.0}, {"dolt": 3.0})


def channels(text):
    return dict(zip(tx.CHANNELS, tx.Scanner(GRAMMAR).channels(text)))


def test_clauses_are_read_not_words():
    zero = dict.fromkeys(tx.CHANNELS, 0.0)
    assert channels("what a fool. nothing") == zero | {"plain": 4.0}
    assert channels("you are a fool") == zero | {"aimed": 4.0}
    assert channels("you are not a fool") == zero | {"negated": 4.0}
    assert channels("not this, what a fool") == zero | {"plain": 4.0}       # a negation of another clause
    assert channels("she said you are a fool") == zero | {"reported": 4.0}
    assert channels('he read "fool" out') == zero | {"reported": 4.0}
    assert channels("i will hurt you") == zero | {"threat": 1.0}
    assert channels("it may hurt a bit") == zero
    assert channels("foolish scaffold, dolts") == zero | {"plain": 3.0}     # whole words, word beginnings
    assert channels("fool. fool. you dolt.") == zero | {"plain": 4.0, "aimed": 3.0}
    assert channels("") == zero


def test_held_out_rows_are_never_learned(spark):
    labels = spark.createDataFrame([(i, 0, 1) for i in range(60)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in tx.learnable(labels).collect()}
    assert kept == {i for i in range(60) if zlib.crc32(str(i).encode()) % 3 != 1}
    # labels of held-out rows change nothing
    docs = documents(spark, [(i, f"some words {i} here" + (" awfulword" if i % 4 == 0 else "")) for i in range(240)])
    truth = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(240)], labels.schema)
    lies = spark.createDataFrame(
        [(i, 1, int(i % 4 == 0) if zlib.crc32(str(i).encode()) % 3 != 1 else 1) for i in range(240)], labels.schema)
    a = {r.doc_id: (r.score, r.predicted) for r in tx.score_documents(docs, truth).collect()}
    b = {r.doc_id: (r.score, r.predicted) for r in tx.score_documents(docs, lies).collect()}
    assert a == b
    assert all(p == int(i % 4 == 0) for i, (_, p) in a.items())


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = tx.score_documents(docs, labels)
    both = got.filter("held_out").join(labels, "doc_id").select("predicted", "toxic").collect()
    toxic = [r for r in both if r.toxic]
    clean = [r for r in both if not r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.8 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)


def test_edges(spark):
    docs = documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(None, 1, 1), (1, None, None), (2, 0, 1), (2, 0, 1), (3, 1, 0), (9, 1, 5)], none.schema)
    for labels in (none, odd):
        got = tx.score_documents(docs, labels).collect()
        assert len(got) == docs.count()
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
        assert {r.held_out for r in got if r.doc_id is None} == {zlib.crc32(b"") % 3 == 1}
    assert tx.score_documents(empty(spark), odd).count() == 0


def test_accident_bound():
    assert tx._rare(10, 10, 0.1) == pytest.approx(1e-10)
    assert tx._rare(10, 1, 0.1) == 1.0


def test_copies_count_once_in_learning(spark):
    # copies in many files: each has words of its own that nothing but the copies would make a pattern
    toxic_copy = "harmlessword anotherword you awfulone"
    rows = [(i, toxic_copy if i % 3 == 0 else f"plain text number{i} goes here") for i in range(600)]
    docs = documents(spark, rows).repartition(24)
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i, _ in rows], "doc_id long, quality int, toxic int")
    sample = tx.training_rows(docs, labels)
    assert sample.filter(sample.text == toxic_copy).count() == 1
    assert sample.filter("toxic = 0").count() == len([1 for i, _ in rows if i % 3 and zlib.crc32(str(i).encode()) % 3 != 1])
    assert tx.learn_patterns(sample) == ({}, {})
    # texts that only share their beginning are no copies
    near = documents(spark, [(i, f"one two three four five {i}") for i in range(60)])
    truth = spark.createDataFrame([(i, 1, i % 2) for i in range(60)], labels.schema)
    assert tx.training_rows(near, truth).count() == tx.learnable(truth).count()


def test_no_number_of_patterns_is_set(spark):
    """A rarer pattern is learned beside thousands of more frequent ones."""
    def word(i):
        return "".join(chr(97 + i // 26 ** k % 26) for k in range(5))
    many = " ".join(word(i * 1009) for i in range(7000))
    rows = [(f"{many} {'zyxrare' if i < 25 else ''} toxic text {i}", 1) for i in range(30)] + [(f"plain words {i}", 0) for i in range(30)]
    words, beginnings = tx.learn_patterns(spark.createDataFrame(rows, "text string, toxic int").repartition(4))
    assert len(words) + len(beginnings) > 20 and any("zyxrare".startswith(b) for b in [*words, *beginnings])
