"""Cross-entropy difference against a plain version, and edge cases."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa

from ledgerline.llm import lm_scoring as lm
from tests.llm.cases import documents, empty

TEXTS = {1: "a b a c", 2: "a b b c d", 3: "x y z x y", 4: "A B x", 5: "", 6: None, 7: "q"}
TARGET = {1, 2}


def tokens(text):
    """Buckets (word, before, pair) of each token."""
    for _, _, _, words, before, pairs in lm._tokens(pa.array([text or ""])):
        return list(zip(words.tolist(), before.tolist(), pairs.tolist()))
    return []


def plain():
    models = []
    for ids in (TARGET, set(TEXTS)):
        counts = [Counter(), Counter(), Counter()]
        for i in ids:
            for token in tokens(TEXTS[i]):
                for c, b in zip(counts, token):
                    c[b] += 1
        models.append(counts)
    totals = [sum(m[0].values()) for m in models]
    out = {}
    for i, text in TEXTS.items():
        own = tokens(text)
        ce = []
        for k, (counts, total) in enumerate(zip(models, totals)):
            take = (i in TARGET) if k == 0 else True
            scale = 1.0 if k == 0 else totals[0] / totals[1]
            mine = [Counter(t[j] for t in own) if take else Counter() for j in range(3)]
            bits = 0.0
            for token in own:
                word, history, pair = ((counts[j][token[j]] - mine[j][token[j]]) * scale for j in range(3))
                n = (total - (len(own) if take else 0)) * scale
                p = (word + 0.5) / (n + 0.5 * lm.UNIGRAMS)
                bits -= math.log2((pair + lm.PAIR_MASS * p) / (history + lm.PAIR_MASS))
            ce.append(bits / len(own) if own else None)
        out[i] = (len(own), *ce)
    return out


def test_scores_equal_plain_version(spark):
    docs = documents(spark, list(TEXTS.items()))
    target = spark.createDataFrame([(i,) for i in TARGET], "target_id long")
    got = {r.doc_id: r for r in lm.score_documents(docs, target).collect()}
    for i, (n, ce_t, ce_b) in plain().items():
        r = got[i]
        assert r.n_tokens == n
        if n:
            assert np.allclose([r.ce_target, r.ce_background, r.score], [ce_t, ce_b, ce_b - ce_t])
        else:
            assert (r.ce_target, r.ce_background, r.score) == (None, None, None)


def test_counts_cover_all_documents(spark):
    docs = documents(spark)
    marked = lm._marked(docs, spark.createDataFrame([(1,)], "target_id long"))
    rows = lm.ngram_counts(marked).collect()
    words = sum(r.n for r in rows if r.bucket < lm.UNIGRAMS)
    assert words == sum(len(tokens(r.text)) for r in docs.collect())
    assert sum(r.n_target for r in rows if r.bucket < lm.UNIGRAMS) == 14


def test_good_documents_score_higher(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    # the target is half of the good documents; the others are judged
    scores = lm.score_documents(docs, lm.good_ids(labels.filter("doc_id % 2 = 0")))
    rows = scores.join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    good, bad = ([r.score for r in rows if r.quality == k] for k in (1, 0))
    assert np.mean(good) > np.mean(bad) + 1


def test_edges(spark):
    none = spark.createDataFrame([], "target_id long")
    assert lm.score_documents(documents(spark), none).count() == 14
    assert lm.score_documents(empty(spark), none).count() == 0
    odd = spark.createDataFrame([(None, 1, 0), (1, 1, None), (2, 1, 1), (3, 0, 0), (1, 1, 0)],
                                "doc_id long, quality int, toxic int")
    assert [r.target_id for r in lm.good_ids(odd).collect()] == [1]


def test_no_two_pairs_share_a_count(spark):
    # 60,000 words and pairs: in 2^20 and 2^21 buckets some 1,700 and 860 would fall together
    words = [f"w{i}" for i in range(60_000)]
    texts = [(k, " ".join(words[k * 6000:(k + 1) * 6000]) + f" tail{k}") for k in range(10)]
    rows = lm.ngram_counts(lm._marked(documents(spark, texts), spark.createDataFrame([(1,)], "target_id long")))
    by = {r.bucket: r for r in rows.groupBy("bucket").agg({"n": "max", "n_target": "sum", "*": "count"}).collect()}
    assert by[lm.WORD]["count(1)"] == 60_010 and by[lm.WORD]["max(n)"] == 1
    assert by[lm.PAIR]["count(1)"] == 60_010 and by[lm.PAIR]["max(n)"] == 1
    assert by[lm.HISTORY]["count(1)"] == 60_001 and by[lm.HISTORY]["max(n)"] == 10     # a start each
    # a pair has no more occurrences than its history, so p(w | v) is a probability
    seen = rows.filter(rows.bucket == lm.HISTORY).select("before", rows.n.alias("limit"))
    assert rows.filter(rows.bucket == lm.PAIR).join(seen, "before").filter("n > limit").count() == 0


def test_rows_with_the_same_id_are_scored_apart(spark):
    docs = documents(spark, [(1, "a b c"), (1, "x y"), (None, "a b"), (None, None)])
    got = lm.score_documents(docs, spark.createDataFrame([(1,)], "target_id long")).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 0), (0, 2), (1, 2), (1, 3)]


def test_many_chunks_and_slices_give_the_same_scores(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").limit(300)
    docs = docs.unionByName(documents(spark, [(None, ""), (1, "a b"), (2, None)]).select("doc_id", "text")).cache()
    target = docs.filter("doc_id % 3 = 0").select("doc_id").distinct().withColumnRenamed("doc_id", "target_id")

    def scores():
        rows = lm.score_documents(docs, target).collect()
        return sorted((r.doc_id or -1, r.n_tokens, *(round(x or 0, 9) for x in r[2:])) for r in rows)

    whole = scores()
    monkeypatch.setattr(lm, "CHUNK_TEXT", 1 << 10)
    monkeypatch.setattr(lm, "SLICE_TEXT", 1 << 14)
    monkeypatch.setattr(lm, "PART_TOKENS", 100)
    assert len(whole) == docs.count() and np.allclose(scores(), whole)


def test_what_moves_follows_distinct_pairs_of_chunks(spark):
    # 200 documents of the same 500 pairs: a pair is sent once a chunk, not once a document, and without the hashes of its words
    text = " ".join(f"w{i}" for i in range(500))
    marked = lm._marked(documents(spark, [(i, text) for i in range(200)]).coalesce(1),
                        spark.createDataFrame([(1,)], "target_id long"))
    chunks, sent = lm._sent_by_chunks(marked, named=False)
    assert chunks.count() == 1
    assert sum(len(r.pairs) + len(r.words) + len(r.names) for r in sent.collect()) < 1000 * 12
    pairs = np.concatenate([lm._unpack_keys(r.pairs, 2)[1][0] for r in sent.collect()])
    assert len(pairs) == 500 and set(pairs.tolist()) == {200}
