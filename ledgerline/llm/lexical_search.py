"""Ranked lexical search over a K2-treap of the term-document grid.

*Scores.* Terms are the maximal runs of ASCII letters, digits and characters beyond
ASCII, A-Z lower-cased. N counts the documents with a term, L all their terms, n a
document's terms, df the documents that hold a term, tf its occurrences in one. A
document's score for an item sums, over the item's distinct terms,

    w * ((1000000000 * tf) div (1000 * tf + 20 * m)),
    w = floor(1000 * ln((2 * N + 2) / (2 * df + 1))),  m = 50 + ((50 * n * N) div L)

The second factor is the *impact* of a term in a document; it does not depend on df.

*Index.* Documents are cut into blocks as their partitions are read. A block is a grid with a
row per term, most frequent first, and a column per document, by doc_id. The grid is
cut into square tiles as wide as the block, and each tile is a quadtree: a
cell that holds an impact is a node with the largest impact in it, a node's four
quarters are its children, and only non-empty ones are stored, by a four-bit
mask a node, level by level. A maximum is stored as its difference from the
parent's, which is 0 down to the place of the maximum, and the levels are compressed.
Blocks are rows of a written table; no posting is shuffled.

*Search.* An item starts at the whole document range of a block with one cell for each
of its terms. Halving the range takes every term's path one level down, to the quarter
with the term's row. The sum of w times the cells' maxima bounds every score in the
range from above, and is the score itself when the range is one document. Ranges
are taken best first (``AT_ONCE`` of them, so that numpy has work) until none can
change the item's ``k`` best; these are carried from block to block of a task, so
later blocks are cut off sooner. A range that can only tie is left out if all its
doc_ids are larger. Each task gives its ``k`` best of each item, and a window by item
joins them.

*Size.* Every document is in the index, and every item meets every block. Items are
searched in portions of about ``PORTION_TERMS`` terms, each sent to the tasks (some
16 MB at most, or one item's terms); a portion reads the index, not the documents. df
is summed over all blocks. A block has at most ``BLOCK_DOCS`` documents and, but for
one long text, ``BLOCK_POSTINGS`` postings, which bounds a task's memory. Terms are
known by 64-bit hashes: with 10^9 distinct terms in the corpus and 10^4 in the items
the chance of any confusion is below 10^-6.

Defined cases: null and empty texts have no terms and are never found; an item
without terms, or whose terms no document has, gives no rows; rows that share an
item_id are one item with all their terms; documents that share a doc_id are
documents each, a null doc_id comes last among equal scores; other columns are
not read; an empty table on either side gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.storage import materialise
from ledgerline.llm.textscan import text_chunks, word_hashes, word_spans

BLOCK_DOCS = 1 << 13
BLOCK_POSTINGS = 1 << 20
PORTION_TERMS = 1 << 18
AT_ONCE = 128
TOP = 50

# term bytes, lower-cased; every other byte becomes a space
_TERM_BYTE = np.full(256, 32, dtype=np.uint8)
for _lo, _hi in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _TERM_BYTE[_lo:_hi] = np.arange(_lo, _hi)
_TERM_BYTE[0x41:0x5B] += 32

INDEX = "block long, docs binary, nulls binary, terms binary, rows binary, df binary, tops binary, masks binary, falls binary, shape array<int>"

_ONES = np.array([bin(i).count("1") for i in range(16)], dtype=np.int64)
# place of a quarter among the children that a mask has, -1 if it has none there
_PLACE = np.array([[(bin(m & ((1 << q) - 1)).count("1") if m >> q & 1 else -1) for q in range(4)] for m in range(16)], dtype=np.int64)


def term_spans(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, bytes, starts, ends, first term of each row) by chunk."""
    for lo, _, data, offsets in text_chunks(texts):
        data = _TERM_BYTE[data]
        starts, ends, doc_terms = word_spans(data, offsets)
        yield lo, data, starts, ends, doc_terms


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    docs = terms = 0
    for batch in batches:
        for _, _, _, _, doc_terms in term_spans(batch.column(0)):
            counts = np.diff(doc_terms)
            docs += int((counts > 0).sum())
            terms += int(counts.sum())
    yield pa.RecordBatch.from_arrays([pa.array([docs], pa.int64()), pa.array([terms], pa.int64())], ["docs", "terms"])


def corpus_lengths(docs: DataFrame) -> tuple[int, int]:
    """N and L."""
    row = docs.select("text").mapInArrow(_lengths, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    return row[0] or 0, row[1] or 0


# ---------------------------------------------------------------- the index

def _spread_bits(x: np.ndarray) -> np.ndarray:
    """Bit i of x to bit 2 i."""
    x = x.astype(np.uint64)
    for shift, keep in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | x << np.uint64(shift)) & np.uint64(keep)
    return x


def build_tree(rows: np.ndarray, cols: np.ndarray, impacts: np.ndarray, width: int) -> tuple[list, list, np.ndarray]:
    """Masks and maxima of each level, root level first, of the tiles of side
    2^width, and the tiles' numbers. Impacts are positive, cells distinct."""
    code = _spread_bits(rows) << np.uint64(1) | _spread_bits(cols)
    order = np.argsort(code, kind="stable")
    code, best = code[order], impacts[order].astype(np.int64)
    masks, maxima = [], [best]
    for _ in range(width):
        parent = code >> np.uint64(2)
        first = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]])) if len(code) else np.empty(0, np.int64)
        quarter = (np.uint8(1) << (code & np.uint64(3)).astype(np.uint8)).astype(np.uint8)
        masks.append(np.bitwise_or.reduceat(quarter, first) if len(first) else quarter)
        best = np.maximum.reduceat(best, first) if len(first) else best
        maxima.append(best)
        code = parent[first]
    return masks[::-1], maxima[::-1], np.unique(rows >> width)


def _pack(values: np.ndarray) -> bytes:
    raw = values.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(packed: bytes, dtype) -> np.ndarray:
    size = int.from_bytes(packed[:8], "little")
    return np.frombuffer(pa.decompress(packed[8:], decompressed_size=size, codec="zstd"), dtype=dtype)


def _block_row(number: int, ids: list, doc: np.ndarray, term: np.ndarray, impact: np.ndarray) -> pa.RecordBatch:
    """One block: postings (doc, term, impact), ``ids`` by doc."""
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
    column = np.empty(len(ids), dtype=np.int64)
    column[order] = np.arange(len(ids))
    terms, at, df = np.unique(term, return_inverse=True, return_counts=True)
    row = np.empty(len(terms), dtype=np.int64)
    row[np.argsort(-df, kind="stable")] = np.arange(len(terms))
    width = max(1, (len(ids) - 1).bit_length())
    found = impact > 0
    masks, maxima, tops = build_tree(row[at][found], column[doc][found], impact[found], width)
    falls = [maxima[0]]
    for mask, above, own in zip(masks, maxima, maxima[1:]):
        falls.append(np.repeat(above, _ONES[mask]) - own)
    sorted_ids = [ids[i] for i in order]
    values = [
        [number], [_pack(np.array([i or 0 for i in sorted_ids], dtype=np.int64))],
        [_pack(np.array([i is None for i in sorted_ids], dtype=np.uint8))], [_pack(terms)], [_pack(row.astype(np.uint32))],
        [_pack(df.astype(np.uint32))], [_pack(tops)], [_pack(np.concatenate(masks))],
        [_pack(np.concatenate(falls).astype(np.uint32))], [[len(m) for m in maxima]]]
    types = [pa.int64(), *[pa.binary()] * 8, pa.list_(pa.int32())]
    names = [c.split()[0] for c in INDEX.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names)


def _postings(texts: pa.Array, n_docs: int, n_terms: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, rows, row of each posting, term, impact) by chunk."""
    for lo, data, starts, ends, doc_terms in term_spans(texts):
        counts = np.diff(doc_terms)
        hashes = word_hashes(data, starts, ends, lower=False)
        doc_of = np.repeat(np.arange(len(counts)), counts)
        order = np.lexsort((hashes, doc_of))
        hashes, doc_of = hashes[order], doc_of[order]
        new = np.ones(len(hashes), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (doc_of[1:] != doc_of[:-1])
        first = np.flatnonzero(new)
        tf = np.diff(np.append(first, len(hashes)))
        # in Python's integers: 50 n N may pass 64 bits
        m = np.array([50 + 50 * n * n_docs // n_terms for n in counts.tolist()], dtype=np.int64)
        doc, term = doc_of[first], hashes[first]
        yield lo, len(counts), doc, term, 1_000_000_000 * tf // (1000 * tf + 20 * m[doc])


def _blocks(n_docs: int, n_terms: int, block_docs: int, block_postings: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        parts: list = []
        size = number = 0

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal ids, parts, size, number
            if size:
                yield _block_row(number, ids, *(np.concatenate(x) for x in zip(*parts)))
                number += 1
            ids, parts, size = [], [], 0

        for batch in batches:
            names = batch.column(0)
            for lo, rows, doc, term, impact in _postings(batch.column(1), n_docs, n_terms):
                cuts = np.searchsorted(doc, np.arange(rows + 1))
                a = 0
                while a < rows:                       # as many documents as still fit
                    if ids and (len(ids) >= block_docs or size + cuts[a + 1] - cuts[a] > block_postings):
                        yield from close()
                    b = int(np.searchsorted(cuts, cuts[a] + block_postings - size, side="right")) - 1
                    b = min(rows, max(a + 1, b), a + block_docs - len(ids))
                    keep = slice(cuts[a], cuts[b])
                    parts.append((doc[keep] - a + len(ids), term[keep], impact[keep]))
                    ids += names.slice(lo + a, b - a).to_pylist()
                    size += int(cuts[b] - cuts[a])
                    a = b
        yield from close()
    return run


def build_index(docs: DataFrame, lengths: tuple[int, int], block_docs: int = BLOCK_DOCS,
                block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """The written index of all rows of ``docs`` (doc_id, text): a row a block."""
    return materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _blocks(*lengths, block_docs, block_postings), INDEX), "lexical-index")


class Block:
    """A block read back; node 0 is the empty cell."""

    def __init__(self, row: dict):
        self.docs, self.null = _unpack(row["docs"], np.int64), _unpack(row["nulls"], np.uint8).astype(bool)
        self.terms, self.rows = _unpack(row["terms"], np.uint64), _unpack(row["rows"], np.uint32).astype(np.int64)
        self.tops = _unpack(row["tops"], np.int64)
        self.width = len(row["shape"]) - 1
        masks, falls = _unpack(row["masks"], np.uint8), _unpack(row["falls"], np.uint32)
        shape = row["shape"]
        nodes = sum(shape)
        self.mask = np.zeros(nodes + 1, dtype=np.uint8)
        self.mask[1:len(masks) + 1] = masks
        self.best = np.zeros(nodes + 1, dtype=np.int32)
        self.best[1:] = falls
        a = 1
        for size, below in zip(shape, shape[1:]):
            own = self.best[a:a + size]
            b = a + size
            self.best[b:b + below] = np.repeat(own, _ONES[self.mask[a:b]]) - self.best[b:b + below]
            a = b
        # children follow the root level in the order of their parents
        self.first = np.zeros(nodes + 1, dtype=np.int32)
        inner = len(masks)
        if inner:
            self.first[1:inner + 1] = 1 + shape[0] + np.concatenate([[0], np.cumsum(_ONES[masks])[:-1]])

    def find(self, terms: np.ndarray) -> np.ndarray:
        """The row of each term, -1 where the block has none."""
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, self.rows[at], -1)

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, best: list) -> list:
        """The ``k`` best (-score, null, doc_id) of ``best`` and this block, best
        first."""
        rows = self.find(terms)
        used = (rows >= 0) & (weights > 0)
        rows, weights = rows[used], weights[used]
        if len(rows) == 0:
            return best
        if len(self.tops) == 0:
            return best
        tile = np.minimum(np.searchsorted(self.tops, rows >> self.width), len(self.tops) - 1)
        nodes = np.where(self.tops[tile] == rows >> self.width, tile + 1, 0)[None, :]
        # pending ranges: bound, side (in bits), first document, nodes
        bound = (self.best[nodes] * weights).sum(axis=1)
        side, start = np.array([self.width]), np.array([0])
        while len(bound):
            if len(best) == k:
                least, null, last = -best[-1][0], best[-1][1], best[-1][2]
                tie = (self.null[start] > null) | ((self.null[start] == null) & (self.docs[start] >= last))
                live = (bound > least) | ((bound == least) & ~tie)
                bound, side, start, nodes = bound[live], side[live], start[live], nodes[live]
                if len(bound) == 0:
                    break
            if len(bound) > AT_ONCE:
                order = np.argpartition(-bound, AT_ONCE)
                now, later = order[:AT_ONCE], order[AT_ONCE:]
            else:
                now, later = np.arange(len(bound)), np.empty(0, np.int64)
            half = side[now] - 1
            row_bit = (rows[None, :] >> half[:, None] & 1) << 1
            mask, first = self.mask[nodes[now]], self.first[nodes[now]]
            found = []
            for col_bit in (0, 1):
                place = _PLACE[mask, row_bit | col_bit]
                below = np.where(place >= 0, first + place, 0)
                found.append(((self.best[below] * weights).sum(axis=1), half, start[now] + (col_bit << half), below))
            new = [np.concatenate(x) for x in zip(*found)]
            new = [x[(new[0] > 0)] for x in new]
            single = new[1] == 0
            if single.any():
                docs = new[2][single]
                best = sorted(best + list(zip((-new[0][single]).tolist(), self.null[docs].tolist(), self.docs[docs].tolist())))[:k]
            bound, side, start, nodes = (np.concatenate([old[later], x[~single]])
                                         for old, x in zip((bound, side, start, nodes), new))
        return best


# ---------------------------------------------------------------- the search

def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, data, starts, ends, item_terms in term_spans(batch.column(1)):
            hashes = word_hashes(data, starts, ends, lower=False)
            of = lo + np.repeat(np.arange(len(item_terms) - 1), np.diff(item_terms))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(of)), pa.array(hashes.view(np.int64))],
                                             ["item_id", "term"])


def _document_counts(wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, df in zip(batch.column(0), batch.column(1)):
                have, counts = _unpack(terms.as_py(), np.uint64), _unpack(df.as_py(), np.uint32)
                found = np.flatnonzero(np.isin(have, wanted.value, assume_unique=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(have[found].view(np.int64)), pa.array(counts[found].astype(np.int64))], ["term", "df"])
    return run


def _search_blocks(queries, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [[] for _ in queries.value]
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block({name: batch.column(c)[i].as_py() for c, name in enumerate(batch.schema.names)})
                for q, (_, terms, weights) in enumerate(queries.value):
                    best[q] = block.search(terms, weights, k, best[q])
        rows = [(item, None if null else doc, -minus) for (item, _, _), found in zip(queries.value, best)
                for minus, null, doc in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in rows], pa.int64()) for c in range(3)], ["item_id", "doc_id", "score"])
    return run


def _weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _portions(terms: DataFrame, size: int) -> tuple[DataFrame, int]:
    """``terms`` (item_id, term) with a portion number, and how many there are:
    so many that each has at most 4 times ``size`` rows, or a single item."""
    rows = terms.count()
    number = max(1, math.ceil(rows / size))
    while True:
        dealt = terms.withColumn("portion", F.pmod(F.xxhash64("item_id"), F.lit(number)))
        large = (dealt.groupBy("portion").agg(F.count(F.lit(1)).alias("n"), F.min("item_id").alias("a"), F.max("item_id").alias("b"))
                 .filter((F.col("n") > 4 * size) & (F.col("a") != F.col("b"))))
        if large.isEmpty():
            return dealt, number
        number *= 2


def search(index: DataFrame, lengths: tuple[int, int], items: DataFrame, k: int = TOP,
           portion_terms: int = PORTION_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score of each item's ``k`` best documents."""
    sc = index.sparkSession.sparkContext
    terms = materialise(items.select(F.col("item_id").cast("long").alias("item_id"), "text")
                        .mapInArrow(_item_terms, "item_id long, term long").distinct(), "item-terms")
    dealt, number = _portions(terms, portion_terms)
    found = []
    for portion in range(number):
        rows = dealt.filter(F.col("portion") == portion).select("item_id", "term").orderBy("item_id", "term").collect()
        wanted = np.unique(np.array([r.term for r in rows], dtype=np.int64).view(np.uint64))
        counts = dict(map(tuple, index.select("terms", "df").mapInArrow(_document_counts(sc.broadcast(wanted)), "term long, df long")
                          .groupBy("term").agg(F.sum("df")).collect()))
        queries, a = [], 0
        while a < len(rows):
            b = a
            while b < len(rows) and rows[b].item_id == rows[a].item_id:
                b += 1
            known = [r.term for r in rows[a:b] if r.term in counts]
            queries.append((rows[a].item_id, np.array(known, dtype=np.int64).view(np.uint64),
                            np.array([_weight(lengths[0], counts[t]) for t in known], dtype=np.int64)))
            a = b
        found.append(materialise(index.mapInArrow(_search_blocks(sc.broadcast(queries), k), "item_id long, doc_id long, score long"),
                                 "item-hits"))
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    best = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


def rank_documents(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """Index all of ``docs`` (doc_id, text) and search it for all ``items``
    (item_id, text)."""
    lengths = corpus_lengths(docs)
    return search(build_index(docs, lengths), lengths, items, k)
