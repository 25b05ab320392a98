"""Exact de-duplication against brute force."""

import hashlib

from ledgerline.llm import exact_dedup as ed
from tests.llm.cases import documents, empty, lower_ascii


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(lower_ascii(t or ""), []).append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), sha) for i in ids]
    return sorted(out, key=repr)


def check(docs, counters):
    got = ed.exact_groups(docs, counters).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == brute(rows)
    kept = [r.text_sha256 for r in got if r.kept]
    assert len(kept) == len(set(kept)) == len({g[3] for g in brute(rows)})      # one of each group
    assert all(r.doc_id == r.keep_id for r in got if r.kept)
    left = ed.drop_exact_copies(docs, counters).collect()
    assert sorted((repr(r.doc_id), lower_ascii(r.text or "")) for r in left) == sorted(
        (repr(r.doc_id), lower_ascii(next(t or "" for i, t in rows if hashlib.sha256(
            lower_ascii(t or "").encode()).hexdigest() == r.text_sha256))) for r in got if r.kept)


def test_edges_with_and_without_heavy_groups(spark):
    docs = documents(spark)
    assert ed.drop_exact_copies(docs).columns == docs.columns
    check(docs, 1000)
    check(docs, 2)


def test_hot_group_of_a_third(spark):
    docs = documents(spark, [(i, "Hot text" if i % 3 == 0 else f"text {i // 2}") for i in range(600)]).repartition(6)
    check(docs, 10)
    heavy = ed.heavy_groups(ed.digest_rows(docs), 10).collect()
    assert len(heavy) == 1 and heavy[0].n == 200 and heavy[0].winner_id == 597


def test_misra_gries_bounds():
    values = ["a"] * 50 + ["b"] * 30 + [str(i) for i in range(100)]
    kept = ed.misra_gries(iter([values[i::7] for i in range(7)]), 5)
    assert len(kept) <= 5
    for v, n in (("a", 50), ("b", 30)):
        assert n - len(values) / 6 <= kept.get(v, 0) <= n


def test_empty_table(spark):
    assert ed.exact_groups(empty(spark)).count() == 0
    assert ed.drop_exact_copies(empty(spark)).count() == 0
