"""Benchmark decontamination by SimHash windows of each item's size, multi-index
Hamming blocks, and exact weighted-shingle similarity.

A document is contaminated by an item if one of its windows, as many words long
as the item (or the whole document, if that is shorter), has a weighted-shingle
similarity of ``SIMILAR`` or more with it: the sum of smaller over the sum of
larger weights, over runs of five words with their numbers of occurrences. A
shingle weighs 1 / (1 + ln k), k being the number of items that have it, so what
many items share counts less; shingles of no item weigh 1. Items of fewer
than five words are one shingle of all their words.

1. Only windows with a shingle of an item of their size can be similar to one
   at all. A bit table of the items' shingles finds these places, so most of a text
   costs one look-up per word; no similar window is lost.
2. Each such window's ``BITS``-bit SimHash is made from sums over its shingles'
   weighted bits, sliding along the text.
3. The items' SimHashes are indexed by their blocks of 16 bits: a block value
   leads to all items whose block is within ``BLOCK_RADIUS`` bits of it. With b
   blocks, two fingerprints within b * (BLOCK_RADIUS + 1) - 1 bits
   agree so on at least one block, so every item within that radius is found. A
   similar window's weights differ from the item's by at most a quarter of the item's
   sum, which bounds their angle by the item's own weights; this index decides for
   the items whose expected distance at that angle is ``SURE`` standard deviations
   or more below the radius. These are short ones only: a shingle of no item
   weighs 1, and a few of them can turn the fingerprint of a long or much
   shared item's window.
4. For all other items every window of step 1 is a candidate if what it has of
   the item's shingles could make it similar: a bound that loses nothing.
5. Candidates are verified exactly.

Items are taken in groups of ``GROUP_ITEMS``, whose index has a bounded size and
is broadcast; each group is one pass over the documents without a shuffle, and
a document's matches are found in the task that reads it. k is counted over the
whole benchmark, and the shingles that several of its items have are broadcast
with their counts (16 bytes each), so groups don't change a weight.

Defined cases: null and empty texts and items match nothing; repeated documents
each get their rows; items that repeat an id each count as an item of that id;
empty tables give an empty result; other columns are not read by
:func:`find_leaks` and returned unchanged by :func:`drop_contaminated`.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.textscan import SHINGLE_WORDS, mix, shingle_hashes, text_chunks, word_hashes, word_spans

SIMILAR = 0.8
BITS = 128
BLOCKS = BITS // 16
BLOCK_RADIUS = 4
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
GROUP_ITEMS = 1_000
_TABLE_BITS = 22
SURE = 4.5
_ROUNDING = 1e-9

_NEAR = np.array([x for x in range(1 << 16) if bin(x).count("1") <= BLOCK_RADIUS], dtype=np.uint16)


def _bits(shingles: np.ndarray) -> np.ndarray:
    """+1 or -1 per shingle and fingerprint bit."""
    both = np.column_stack([shingles, mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5))]).astype("<u8")
    return np.unpackbits(both.view(np.uint8).reshape(len(shingles), BITS // 8), axis=1).astype(np.float32) * 2 - 1


def _blocks(sums: np.ndarray) -> np.ndarray:
    """Fingerprints as rows of 16-bit blocks, from sums of weighted bits."""
    return np.packbits(sums > 0, axis=1).view(np.uint16)


def _words_of(texts) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Word hashes and shingle hashes of each text."""
    words, shingles = [], []
    for _, _, data, offsets in text_chunks(texts):
        starts, ends, doc_words = word_spans(data, offsets)
        hashes = word_hashes(data, starts, ends)
        found, bounds = shingle_hashes(hashes, doc_words)
        words += [hashes[a:b] for a, b in zip(doc_words[:-1], doc_words[1:])]
        shingles += [found[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    return words, shingles


def _reach(weights: np.ndarray) -> float:
    """The distance that a similar window's fingerprint is sure to be within,
    for an item with these weights."""
    sine = (1 / SIMILAR - 1) * weights.sum() / np.sqrt((weights ** 2).sum())
    if sine >= 1:
        return math.inf
    p = math.asin(sine) / math.pi
    return BITS * p + SURE * math.sqrt(BITS * p * (1 - p))


class SizeIndex:
    """The items of one size: fingerprints in multi-index blocks, and weights."""

    def __init__(self, size: int, numbers: list[int], bags: list[Counter], weight: dict[int, float]):
        self.size, self.numbers, self.bags = size, numbers, bags
        self.width = max(1, size - SHINGLE_WORDS + 1)       # shingles of a full window
        self.shingles = np.unique(np.array([s for bag in bags for s in bag], dtype=np.uint64))
        weights = [np.array([weight[s] * n for s, n in bag.items()]) for bag in bags]
        self.totals = np.array([w.sum() for w in weights])
        self.by_print = np.array([_reach(w) <= RADIUS for w in weights])
        # the items of each shingle, for those that fingerprints don't decide
        owned = [(s, i) for i, bag in enumerate(bags) if not self.by_print[i] for s in bag]
        at = np.searchsorted(self.shingles, np.array([s for s, _ in owned], dtype=np.uint64))
        order = np.argsort(at, kind="stable")
        self.owners = np.array([i for _, i in owned], dtype=np.int64)[order]
        self.owner_bounds = np.searchsorted(at[order], np.arange(len(self.shingles) + 1))
        sums = [(_bits(np.array(list(bag), dtype=np.uint64))
                 * np.array([weight[s] * n for s, n in bag.items()])[:, None]).sum(axis=0) for bag in bags]
        self.prints = _blocks(np.array(sums))
        # block, value -> items, as a sorted list of keys
        self.keys, self.items = [], []
        for b in range(BLOCKS):
            keys = (self.prints[:, b][:, None] ^ _NEAR[None, :]).ravel()
            items = np.repeat(np.arange(len(numbers)), len(_NEAR))
            order = np.argsort(keys, kind="stable")
            self.keys.append(keys[order])
            self.items.append(items[order].astype(np.int32))

    def within(self, prints: np.ndarray) -> Iterator[tuple[int, int]]:
        """(window, item) for all items within the radius of a window."""
        rows, items = [], []
        for b in range(BLOCKS):
            lo = np.searchsorted(self.keys[b], prints[:, b], side="left")
            n = np.searchsorted(self.keys[b], prints[:, b], side="right") - lo
            at = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            rows.append(np.repeat(np.arange(len(prints)), n))
            items.append(self.items[b][at])
        pairs = np.unique(np.concatenate(rows) * len(self.numbers) + np.concatenate(items))
        rows, items = pairs // len(self.numbers), pairs % len(self.numbers)
        apart = np.bitwise_count(prints[rows] ^ self.prints[items]).sum(axis=1)
        near = apart <= RADIUS
        return zip(rows[near].tolist(), items[near].tolist())


    def possible(self, part: np.ndarray, weights: np.ndarray, starts: np.ndarray,
                 ends: np.ndarray) -> Iterator[tuple[int, int]]:
        """(window, item) for the items that fingerprints don't decide, where
        the weights of the item's shingles in the window don't rule it out."""
        if len(self.owners) == 0:
            return
        at = np.minimum(np.searchsorted(self.shingles, part), len(self.shingles) - 1)
        places = np.flatnonzero(self.shingles[at] == part)
        lo = self.owner_bounds[at[places]]
        n = self.owner_bounds[at[places] + 1] - lo
        items = self.owners[np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        places = np.repeat(places, n)
        inside = np.bincount(items, weights[places], minlength=len(self.numbers))
        order = np.argsort(items, kind="stable")
        bounds = np.searchsorted(items[order], np.arange(len(self.numbers) + 1))
        sums = np.concatenate([[0.0], np.cumsum(weights)])
        total = sums[ends] - sums[starts]
        for item in np.flatnonzero((inside >= SIMILAR * self.totals - _ROUNDING) & (np.diff(bounds) > 0)).tolist():
            own = np.zeros(len(part) + 1)
            mine = places[order[bounds[item]:bounds[item + 1]]]
            own[mine + 1] = weights[mine]
            np.cumsum(own, out=own)
            common = own[ends] - own[starts]
            for window in np.flatnonzero(common >= SIMILAR * np.maximum(total, self.totals[item]) - _ROUNDING).tolist():
                yield window, item


class Index:
    """A group of items, by size. ``item_counts``: hashes, sorted, and numbers
    of items of the shingles that several items of the whole benchmark have."""

    def __init__(self, texts: list[str], item_counts: tuple[np.ndarray, np.ndarray] | None = None):
        words, shingles = _words_of(pa.array(texts, pa.string()))
        bags = [Counter(s.tolist()) for s in shingles]
        if item_counts is None:
            found, times = np.unique(np.array([s for bag in bags for s in bag], dtype=np.uint64), return_counts=True)
            item_counts = found[times > 1], times[times > 1]
        self.shared, self.shared_weights = item_counts[0], 1 / (1 + np.log(item_counts[1]))
        own = np.unique(np.concatenate([np.empty(0, np.uint64), *shingles]))
        self.weight = dict(zip(own.tolist(), self.weights(own).tolist()))
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if len(w):
                by_size.setdefault(len(w), []).append(i)
        self.sizes = [SizeIndex(n, rows, [bags[i] for i in rows], self.weight) for n, rows in sorted(by_size.items())]
        self.short = sorted({s.size for s in self.sizes if s.size < SHINGLE_WORDS})
        self.known = np.unique(np.concatenate([s.shingles for s in self.sizes])) if self.sizes else np.empty(0, np.uint64)
        self.table = np.zeros(1 << _TABLE_BITS, dtype=bool)
        self.table[self.known & np.uint64((1 << _TABLE_BITS) - 1)] = True

    def places(self, shingles: np.ndarray) -> np.ndarray:
        """Indices of shingles that items have."""
        maybe = np.flatnonzero(self.table[shingles & np.uint64((1 << _TABLE_BITS) - 1)])
        if len(maybe) == 0 or len(self.known) == 0:
            return np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.known, shingles[maybe]), len(self.known) - 1)
        return maybe[self.known[at] == shingles[maybe]]

    def weights(self, shingles: np.ndarray) -> np.ndarray:
        """Weights by the whole benchmark; a shingle of one or no item weighs 1."""
        out = np.ones(len(shingles))
        if len(self.shared):
            at = np.minimum(np.searchsorted(self.shared, shingles), len(self.shared) - 1)
            known = self.shared[at] == shingles
            out[known] = self.shared_weights[at[known]]
        return out

    def similarity(self, bag: Counter, window: list[int], weight: dict[int, float]) -> float:
        """``weight``: weights of the window's shingles."""
        here = Counter(window)
        weight = weight | {s: self.weight[s] for s in bag}
        common = math.fsum(weight[s] * min(n, here[s]) for s, n in bag.items())
        total = math.fsum(weight[s] * max(bag[s], here[s]) for s in {*bag, *here})
        return common / total if total else 0.0

    def matches(self, shingles: np.ndarray) -> dict[int, tuple[float, int]]:
        """item -> (best similarity, first window with it) of one document's
        shingles, one per starting word."""
        best: dict[int, tuple[float, int]] = {}
        places = self.places(shingles)
        for size in self.sizes if len(places) else ():
            own = places[np.isin(shingles[places], size.shingles)]
            if len(own) == 0:
                continue
            width, last = size.width, max(0, len(shingles) - size.width)
            near = np.unique((own[:, None] - np.arange(width)[None, :]).ravel())
            starts = np.unique(np.clip(near, 0, last))
            for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1):
                a, b = int(run[0]), int(run[-1]) + width
                part = shingles[a:b]
                weights = self.weights(part)
                ends = np.minimum(np.arange(len(run)) + width, len(part))
                pairs = list(size.possible(part, weights, np.arange(len(run)), ends))
                if size.by_print.any():
                    sums = np.zeros((len(part) + 1, BITS))
                    np.cumsum(_bits(part) * weights[:, None], axis=0, out=sums[1:])
                    pairs += [(window, item) for window, item in size.within(_blocks(sums[ends] - sums[:len(run)]))
                              if size.by_print[item]]
                for window, item in sorted(pairs):
                    here = slice(window, window + width)
                    found = self.similarity(size.bags[item], part[here].tolist(),
                                            dict(zip(part[here].tolist(), weights[here].tolist())))
                    number = size.numbers[item]
                    if found >= SIMILAR - _ROUNDING and found > best.get(number, (0.0, 0))[0]:
                        best[number] = (found, a + window)
        return best

    def short_matches(self, words: np.ndarray) -> dict[int, tuple[float, int]]:
        """Items of fewer than five words: windows of all their words."""
        best: dict[int, tuple[float, int]] = {}
        for size in self.sizes:
            if size.size >= SHINGLE_WORDS or len(words) < size.size:
                continue
            n = len(words) - size.size + 1
            windows = np.repeat(words, 1)[np.arange(n)[:, None] + np.arange(size.size)[None, :]].ravel()
            shingles, _ = shingle_hashes(windows, np.arange(0, len(windows) + 1, size.size))
            hits = np.flatnonzero(np.isin(shingles, size.shingles))
            for window, item in size.within(_blocks(_bits(shingles[hits]))) if len(hits) else ():
                if int(shingles[hits[window]]) in size.bags[item]:
                    best.setdefault(size.numbers[item], (1.0, int(hits[window])))
        return best


def _found(index: Index, texts) -> Iterator[tuple[int, dict[int, tuple[float, int]]]]:
    """Rows with a match, and their items' best windows."""
    for lo, hi, data, offsets in text_chunks(texts):
        starts, ends, doc_words = word_spans(data, offsets)
        words = word_hashes(data, starts, ends)
        shingles, bounds = shingle_hashes(words, doc_words)
        hit = np.zeros(hi - lo, dtype=bool)
        hit[np.searchsorted(bounds, index.places(shingles), side="right") - 1] = True
        for k in (range(hi - lo) if index.short else np.flatnonzero(hit).tolist()):
            found = index.matches(shingles[bounds[k]:bounds[k + 1]]) if hit[k] else {}
            if index.short:
                found |= index.short_matches(words[doc_words[k]:doc_words[k + 1]])
            if found:
                yield lo + k, found


def _match_batches(texts: list[str], ids: list, counts, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(texts, counts.value)
        for batch in batches:
            rows, items, similar, at = [], [], [], []
            for row, found in _found(index, batch.column(1)):
                for item, (similarity, start) in sorted(found.items()):
                    rows.append(row)
                    items.append(ids[item])
                    similar.append(similarity)
                    at.append(start)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(items, id_type),
                 pa.array(similar, pa.float64()), pa.array(at, pa.int64())],
                ["doc_id", "item_id", "similarity", "first_word"])
    return run


def _item_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each item's distinct shingles."""
    for batch in batches:
        shingles = [np.empty(0, np.uint64), *(np.unique(s) for s in _words_of(batch.column(0))[1])]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(shingles).view(np.int64))], ["shingle"])


def shared_shingles(items: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that several items of the whole benchmark have, sorted, and
    their numbers of items. All others weigh 1 and needn't be known."""
    rows = (items.select("text").mapInArrow(_item_shingles, "shingle long").groupBy("shingle").agg(F.count("*").alias("n"))
            .filter(F.col("n") > 1).toArrow())
    shingles = rows["shingle"].to_numpy().view(np.uint64)
    order = np.argsort(shingles)
    return shingles[order], rows["n"].to_numpy()[order]


def _parts(items: DataFrame, group_items: int) -> Iterator[tuple[list[str], list]]:
    """Texts and ids of each group of items."""
    groups = _groups(items, group_items)
    numbered = items.filter(F.length(F.trim("text")) > 0).select(
        "item_id", "text", F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)).alias("part"))
    for part in range(groups):
        rows = numbered.filter(F.col("part") == part).orderBy("item_id", "text").select("item_id", "text").collect()
        if rows:
            yield [r.text for r in rows], [r.item_id for r in rows]


def find_leaks(docs: DataFrame, items: DataFrame, group_items: int = GROUP_ITEMS) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, similarity
    of the best window, first_word (its place, in words)."""
    from pyspark.sql.pandas.types import to_arrow_type
    item_type = items.schema["item_id"]
    schema = T.StructType([docs.schema["doc_id"], T.StructField("item_id", item_type.dataType),
                           *T.StructType.fromDDL("similarity double, first_word long").fields])
    out = docs.sparkSession.createDataFrame([], schema)
    counts = docs.sparkSession.sparkContext.broadcast(shared_shingles(items))
    for texts, ids in _parts(items, group_items):
        found = docs.select("doc_id", "text").mapInArrow(
            _match_batches(texts, ids, counts, to_arrow_type(item_type.dataType)), schema)
        out = out.unionByName(found)
    return out


def _groups(items: DataFrame, group_items: int) -> int:
    return max(1, math.ceil(items.count() / group_items))


def _clean_batches(texts: list[str], counts):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(texts, counts.value)
        for batch in batches:
            leaked = np.zeros(batch.num_rows, dtype=bool)
            for row, _ in _found(index, batch.column(1)):
                leaked[row] = True
            yield batch.filter(pa.array(~leaked))
    return run


def drop_contaminated(docs: DataFrame, items: DataFrame, group_items: int = GROUP_ITEMS) -> DataFrame:
    """``docs`` without the rows that have a leaked item, decided row by row in
    the pass that matches: a null or repeated doc_id changes nothing."""
    counts = docs.sparkSession.sparkContext.broadcast(shared_shingles(items))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    for texts, _ in _parts(items, group_items):
        rows = rows.mapInArrow(_clean_batches(texts, counts), rows.schema)
    return rows.select("row.*")
