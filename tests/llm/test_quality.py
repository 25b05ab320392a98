"""Quality by co-training: learning across views, held-out accuracy, edges."""

import numpy as np

from ledgerline.llm import quality as q
from tests.llm.cases import documents, empty


def test_views_teach_each_other():
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 3000).astype(float)
    strong = np.column_stack([y * 3 + rng.normal(size=3000), rng.normal(size=3000)])
    weak = np.column_stack([y + rng.normal(size=3000), rng.normal(size=3000)])
    few, pool, test = slice(0, 60), slice(60, 2000), slice(2000, 3000)
    held = np.arange(60) % 3 == 0

    def accuracy(rounds):
        model = q.co_train((strong[few], weak[few]), y[few], (strong[pool], weak[pool]), held, rounds)
        own = (model.views[1].logit(weak[test]) > 0) == (y[test] > 0)
        return own.mean(), ((model.score(strong[test], weak[test]) > 0.5) == (y[test] > 0)).mean()

    alone, _ = accuracy(0)
    taught, both = accuracy(3)
    assert taught >= alone - 0.01 and both > taught and both > 0.9


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    # learn from the even documents, judge the odd ones
    got = q.score_documents(docs, labels.filter("doc_id % 2 = 0")).join(labels.filter("doc_id % 2 = 1"), "doc_id")
    rows = got.select("accepted", "quality").collect()
    good, bad = ([r.accepted for r in rows if r.quality == k] for k in (1, 0))
    assert np.mean(good) >= 0.99 and np.mean(bad) <= 0.05


def test_filter_equals_scores(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    accepted = {r.doc_id for r in q.score_documents(docs, labels).filter("accepted").collect()}
    left = q.drop_low_quality(docs, labels)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == accepted
    assert 0 < len(accepted) < docs.count()


def test_edges(spark):
    docs = documents(spark)
    schema = "doc_id long, quality int, toxic int"
    none = spark.createDataFrame([], schema)
    odd = spark.createDataFrame([(None, 1, 0), (1, 1, 0), (1, 1, 0), (2, 0, 0), (5, 0, 0), (7, 1, 0), (8, None, 1),
                                 (9, 1, 0), (10, 0, 0), (3, 1, 1), (4, 0, 0), (11, 7, 0)], schema)
    for labels in (none, odd):
        got = q.score_documents(docs, labels).collect()
        assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    assert q.drop_low_quality(docs, none).count() == docs.count()
    assert q.drop_low_quality(docs, odd).columns == docs.columns
    bare = docs.select("doc_id", "text")
    assert q.score_documents(bare, odd).count() == docs.count()
    assert q.score_documents(empty(spark), odd).count() == 0
    assert q.drop_low_quality(empty(spark), odd).count() == 0


def test_every_unlabelled_document_is_in_the_pool(spark, monkeypatch):
    docs = documents(spark, [(i, f"Plain text number {i}." if i % 2 else f"BUY NOW!!! {i} $$$") for i in range(9_000)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    pools = []
    monkeypatch.setattr(q, "co_train", lambda views, y, pool, held: pools.append(pool))
    q.learn(docs, labels)
    assert pools[0].size == 9_000 - 60                   # more than the 8,000 of a bounded sample
    # counts and sums over the table are those over the same rows in memory
    views = q._compact_views(pools[0].table.toArrow())
    models = [q.Logistic.fit(v[:500], np.arange(500) % 2.0) for v in views]
    there, here = (p.counts([([], models[1]), ([], models[0])]) for p in (pools[0], q.ArrayPool(views)))
    assert sorted(map(tuple, there)) == sorted(map(tuple, here))
    choices = [[q.Choice(models[1 - k], ((0.0, 0.5), (100.0, 1.0)))] for k in (0, 1)]
    for what, more in ((q._moments, [v.mean(axis=0) for v in views]), (q._newton, models)):
        there, here = (p.sums(what, list(zip(choices, more))) for p in (pools[0], q.ArrayPool(views)))
        assert np.allclose(there, here)


def test_shares_are_exact():
    steps, n = np.array([3.0, 9.0, 5.0]), np.array([4, 2, 10])
    assert q._cut(steps, n, 7) == (5.0, 0.5) and q._cut(steps, n, 2) == (9.0, 1.0)
    assert q._cut(steps, n, 17) == (-np.inf, 1.0) and q._cut(steps[:0], n[:0], 1) == (-np.inf, 1.0)
