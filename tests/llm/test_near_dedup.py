"""MinHash near-dedup and its components against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import components, near_dedup, textscan
from tests.llm.cases import documents, empty, lower_ascii

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(lower_ascii(text or ""))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows, percent):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, shingles(t))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def family(rng, size, words, most):
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(size):
        w = list(base)
        for _ in range(rng.randrange(most)):
            w[rng.randrange(words)] = f"v{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("percent", [80, 85])
def test_families_against_brute_force(spark, percent):
    rng = random.Random(percent)
    texts = [t for n, most in ((60, 6), (40, 12), (8, 3), (5, 2)) for t in family(rng, n, 120, most)]
    texts += [texts[0]] * 30 + [texts[3].upper(), "a b", "A  B", "", None, "solo"]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = near_dedup.near_groups(documents(spark, rows), percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute(rows, percent)


@pytest.mark.parametrize("block, chunk", [(8, 16), (1, 5), (512, 2048)])
def test_blocks_cover_large_buckets(spark, monkeypatch, block, chunk):
    """A hot group whose members are alike just below and above the threshold,
    of different lengths, cut into blocks, chunks and size classes."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "CHUNK", chunk)
    rng = random.Random(5)
    texts = family(rng, 60, 100, 8)
    texts += [t + " " + " ".join(f"u{rng.randrange(10 ** 6)}" for _ in range(rng.randrange(1, 40))) for t in family(rng, 1, 100, 1) * 40]
    rows = list(enumerate(texts))
    got = near_dedup.near_groups(documents(spark, rows), 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute(rows, 85)


def test_rows_of_the_block_step_grow_with_the_members(spark):
    """A bucket whose rest fits a block and whose members fit a chunk has each
    member in the work once, whatever its components; same members count once."""
    plan = near_dedup.Bands.of(85)
    def dealt(n):
        rows = [(b, b, i, 1 if i % 2 else i, 100) for b in range(3) for i in range(n)]
        return near_dedup._dealt(spark.createDataFrame(rows, "bucket long, band int, rep long, component long, n_shingles long"), plan)
    assert dealt(400).count() == 400 and dealt(800).count() == 800
    assert {r.band for r in dealt(400).collect()} == {0}
    rows = dealt(40)
    assert rows.filter("own").count() == 20 and rows.filter("other").count() == 40


def test_clashing_column_names(spark):
    docs = documents(spark)
    for name in ("__id", "id", "a", "b", "rep", "key", "row"):
        docs = docs.withColumn(name, F.lit("z"))
    left = near_dedup.drop_near_copies(docs, 80)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == [1, 4, 5, 6, 7, 8, 9, 11]


def test_edges(spark):
    docs = documents(spark)
    got = near_dedup.near_groups(docs, 80).collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert [by_id[i].component_id for i in (1, 2, 3, 9, 10)] == [1, 1, 1, 9, 9]
    assert all(by_id[i].component_id == i and by_id[i].kept and by_id[i].n_shingles == 0 for i in (4, 5, 6))
    assert sorted((r.component_id or 0, r.kept) for r in got if r.doc_id is None) == [(0, True), (1, False)]
    left = near_dedup.drop_near_copies(docs, 80)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == [1, 4, 5, 6, 7, 8, 9, 11]
    assert near_dedup.near_groups(empty(spark)).count() == 0
    assert near_dedup.drop_near_copies(empty(spark)).count() == 0


def test_scan_equals_regular_expression():
    rng = random.Random(1)
    texts = ["", " ", "a", "a b  c\td\x0be f\n", None, "é ü", "x" * 3000]
    texts += ["".join(rng.choice("ab \n\x0c\xa0") for _ in range(rng.randrange(80))) for _ in range(200)]
    n = 0
    for lo, hi, data, offsets in textscan.text_chunks(pa.array(texts), chunk_bytes=64):
        starts, ends, doc_words = textscan.word_spans(data, offsets)
        for k in range(lo, hi):
            own = [data[a:b].tobytes().decode() for a, b in zip(starts, ends)][doc_words[k - lo]:doc_words[k - lo + 1]]
            assert own == WORD.findall(texts[k] or "")
            n += 1
        found, bounds = textscan.shingle_hashes(textscan.word_hashes(data, starts, ends), doc_words)
        for k in range(lo, hi):
            assert len(np.unique(found[bounds[k - lo]:bounds[k - lo + 1]])) == len(shingles(texts[k]))
    assert n == len(texts)


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (5, 5), (None, 1), (4, 3), (20, 19), (20, 18)]
    edges += [(i, i + 1) for i in range(100, 160)] + [(200, i) for i in range(201, 260)]
    got = {r.node: r.component for r in components.connected_components(
        spark.createDataFrame(edges, "u long, v long")).collect()}
    assert {i: got[i] for i in (2, 3, 4, 8, 9, 19, 20)} == {2: 1, 3: 1, 4: 1, 8: 7, 9: 7, 19: 18, 20: 18}
    assert all(got[i] == 100 for i in range(101, 161)) and all(got[i] == 200 for i in range(201, 260))
    assert 5 not in got and 1 not in got
    assert components.connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_bands_miss_bound():
    for percent in (70, 80, 85, 95):
        plan = near_dedup.Bands.of(percent)
        assert (1 - (percent / 100) ** plan.rows) ** plan.bands <= near_dedup.MISS
        assert plan.rows * plan.bands <= near_dedup.HASHES


def test_pairs_get_few_files(spark, monkeypatch):
    written = {}

    def noted(df, name, write=near_dedup.materialise):
        out = write(df, name)
        written.setdefault(name, []).append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(near_dedup, "materialise", noted)
    rows = [(2 * i + j, " ".join(f"w{i}x{k}" for k in range(60)) + " end" * j) for i in range(200) for j in (0, 1)]
    conf = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "8k", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        _, _, links = near_dedup.near_classes(documents(spark, rows), 85)
        assert links.count() == 200
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert min(written["fingerprints"] + written["shingle-sets"]) >= 1
    assert written["alike-pairs"][0] == written["links"][0] == 1
    assert "signatures-and-sets" not in written
