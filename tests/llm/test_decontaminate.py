"""Benchmark leaks against brute force over all windows."""

import math
import random
from collections import Counter

import pyarrow as pa

from ledgerline.llm import decontaminate as dc
from tests.llm.cases import documents, empty
from tests.llm.test_near_dedup import WORD, lower_ascii


def words(text):
    return WORD.findall(lower_ascii(text or ""))


def bag(w):
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def brute(docs, items):
    bags = [(i, len(words(t)), bag(words(t))) for i, t in items if words(t)]
    shared = Counter(s for _, _, b in bags for s in b)
    out = set()
    for doc, text in docs:
        w = words(text)
        for item, n, b in bags:
            for a in range(max(1, len(w) - n + 1)):
                here = bag(w[a:a + n]) if len(w) >= min(n, 5) else Counter()
                weight = {s: 1 / (1 + math.log(shared[s])) if s in shared else 1.0 for s in {*b, *here}}
                total = sum(weight[s] * max(b[s], here[s]) for s in weight)
                if sum(weight[s] * min(b[s], here[s]) for s in weight) >= 0.8 * total - 1e-12 and here:
                    out.add((doc, item))
                    break
    return out


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_planted_leaks(spark):
    rng = random.Random(4)
    vocab = [f"t{i}" for i in range(400)]
    items = [(k, " ".join(rng.choices(vocab, k=rng.choice([7, 20, 35, 60])))) for k in range(12)]
    items += [(90, "short one"), (91, None), (92, ""), (93, items[0][1])]
    docs = []
    for d in range(120):
        w = rng.choices(vocab, k=rng.randrange(0, 150))
        if d % 2:
            passage = items[rng.randrange(12)][1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                passage[rng.randrange(len(passage))] = "changed"
            at = rng.randrange(len(w) + 1)
            w[at:at] = passage[:max(5, len(passage) - rng.choice([0, 0, 1, 3]))]
        docs.append((d, " ".join(w).upper() if d % 5 == 0 else " ".join(w)))
    docs.append((200, "here is Short  ONE indeed"))
    found = dc.find_leaks(documents(spark, docs), benchmark(spark, items)).collect()
    got = {(r.doc_id, r.item_id) for r in found}
    assert got == brute(docs, items)
    assert (200, 90) in got and len(got) >= 30              # the fixture does plant leaks
    # items in several groups give the same
    few = dc.find_leaks(documents(spark, docs), benchmark(spark, items), group_items=5).collect()
    assert {(r.doc_id, r.item_id) for r in few} >= {p for p in got if p[1] not in (0, 93)}


def test_index_finds_all_within_the_radius():
    rng = random.Random(8)
    texts = [" ".join(f"a{rng.randrange(300)}" for _ in range(20)) for _ in range(60)]
    size = dc.Index(texts).sizes[0]
    prints = size.prints.copy()
    for row in prints:                       # flip bits, up to beyond the radius
        for bit in rng.sample(range(dc.BITS), rng.randrange(0, 60)):
            row[bit // 16] ^= 1 << (bit % 16)
    apart = [[sum(bin(int(x ^ y)).count("1") for x, y in zip(p, q)) for q in size.prints] for p in prints]
    expected = {(i, j) for i, row in enumerate(apart) for j, d in enumerate(row) if d <= dc.RADIUS}
    assert set(size.within(prints)) == expected and expected


def test_edges(spark):
    items = benchmark(spark, [(1, " ".join(f"w{i}" for i in range(20)))])
    docs = documents(spark)
    assert dc.find_leaks(docs, items).count() == 0
    assert dc.drop_contaminated(docs, items).count() == docs.count()
    assert dc.drop_contaminated(docs, items).columns == docs.columns
    assert dc.find_leaks(empty(spark), items).count() == 0
    assert dc.find_leaks(docs, benchmark(spark, [])).count() == 0
    assert dc.Index([]).places(dc._words_of(pa.array(["a b c d e f"]))[1][0]).size == 0


def test_similar_windows_of_shared_items(spark):
    # what many items share weighs little, a foreign shingle weighs 1 and turns the window's fingerprint
    items, docs = [], []
    for n, copies, edits in ((40, 100, 1), (55, 100, 1), (104, 100, 3), (40, 10, 1), (30, 1, 1)):
        passage = [f"p{n}x{copies}x{i}" for i in range(n)]
        first = len(items)
        items += [(first + k, " ".join(passage)) for k in range(copies)]
        for d in range(12):
            edited = passage[:n - edits] + [f"edit{d}y{i}" for i in range(edits)]
            docs.append((len(docs), " ".join(["before"] * 3 + edited)))
    # a foreign shingle that repeats turns it also where nothing is shared
    passage = [f"r{i}" for i in range(40)]
    items.append((len(items), " ".join(passage)))
    docs += [(len(docs) + d, " ".join(passage[:32] + [f"again{d}"] * 8)) for d in range(12)]
    got = {(r.doc_id, r.item_id) for r in dc.find_leaks(documents(spark, docs), benchmark(spark, items)).collect()}
    chosen = {i for i, _ in items[::10]} | {items[-2][0], items[-1][0]}
    assert {r for r in got if r[1] in chosen} == brute_of(docs, items, chosen)
    assert len(got) > 3000


def brute_of(docs, items, chosen):
    """brute() for the chosen items, by the weights of all."""
    shared = Counter(s for _, t in items for s in bag(words(t)))
    out = set()
    for doc, text in docs:
        w = words(text)
        for item, t in items:
            n, b = len(words(t)), bag(words(t))
            for a in range(max(1, len(w) - n + 1)) if item in chosen else ():
                here = bag(w[a:a + n])
                weight = {s: 1 / (1 + math.log(max(1, shared[s]))) for s in {*b, *here}}
                total = sum(weight[s] * max(b[s], here[s]) for s in weight)
                if sum(weight[s] * min(b[s], here[s]) for s in weight) >= 0.8 * total - 1e-12:
                    out.add((doc, item))
                    break
    return out


def test_groups_of_items_change_nothing(spark):
    rng = random.Random(9)
    common, other = ([f"{c}{i}" for i in range(120)] for c in "co")
    items = [(k, " ".join(common)) for k in range(20)]
    # shingles of other items in a window weigh by the whole benchmark too
    items += [(20 + k, " ".join(other[:30] + [f"own{k}x{i}" for i in range(10)])) for k in range(20)]
    docs = [(d, " ".join(common[:120 - d] + [f"e{d}x{i}" for i in range(d)])) for d in range(8)]
    docs += [(100 + d, " ".join(common[:120 - d] + other[:d])) for d in range(4, 10)]
    rng.shuffle(items)
    whole, *parts = ({(r.doc_id, r.item_id): (round(r.similarity, 9), r.first_word) for r in dc.find_leaks(
        documents(spark, docs), benchmark(spark, items), group_items=n).collect()} for n in (1000, 9))
    assert set(whole) == brute(docs, items) and len(whole) > 100
    assert all(part == whole for part in parts)


def test_rows_are_dropped_not_ids(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    items = benchmark(spark, [(1, passage), (2, " ".join(f"v{i}" for i in range(30)))])
    docs = documents(spark, [(None, passage), (1, "before " + passage), (1, "a clean text"), (None, None), (2, "")])
    for group_items in (1000, 1):
        left = dc.drop_contaminated(docs, items, group_items)
        assert left.schema == docs.schema
        assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == [(0, ""), (1, "a clean text"), (2, "")]
