"""Phrase collocations, by the stream layout of external language-model
estimation: counts are kept as one stream sorted in prefix order, then in suffix
order, and what a phrase needs from shorter and longer ones is met on the way.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?]`` and line ends, and pieces
into words at spaces and tabs. Everything is per language. A phrase has two or three words,
lies in one piece and occurs at least ``LEAST`` times (overlaps included). Cutting it
after its first words gives the counts l and r of its parts and the score
floor(1000000 a a / (l r)); the lowest-scoring cut counts, ties go to the shorter
first part. A phrase that lies inside a longer one with at least
``ABSORB`` percent of its count is dropped.

1. *Counts*, a scan for each length. A task counts runs of words by sorting
   numbers that stand for them in windows of ``WINDOW_BYTES`` of text, and gives
   out (language, phrase, count); Spark adds these, map-side first. A run can only
   occur ``LEAST`` times if its parts do, so longer runs are counted where
   the filter of the frequent shorter ones says so: a Bloom filter sent to the tasks, of
   12 bits a key and at most ``FILTER_BITS`` (16 MB). What passes it by
   mistake is counted and then falls to ``LEAST``; with more keys than fit it
   lets more pass, and nothing is ever lost. Counts are of the words themselves,
   not of hashes.
2. *Prefix order.* The counts of one, two and three words are one stream, range
   partitioned and sorted by language, first, second and third word: a phrase comes
   right after its first words, its extensions right after it. One pass over the sorted
   stream puts the counts of the first word and the first two beside each phrase, and the largest
   count of a right extension beside each pair. Partitions may be cut anywhere,
   within a word's phrases too, so a frequent first word is no hot key:
   each partition tells the driver its last counts and what it has of the pair
   open at its start (one row a partition), and starts from those before it.
3. *Suffix order.* The same pass over the stream sorted from the last word backwards
   gives the counts of the last word and the last two, and left extensions.
4. Scores are exact (38-digit decimals); each language's best ``TOP`` are cut map-side first.

The sorted streams are checkpointed, so a lost task meets the same partitions.

Defined cases: a null text is empty, a null language is ``und`` (and one with that
language); a language without phrases has no rows; rows repeated in the table count
each time; ids are not read; a text of any length is one window at least; other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.storage import materialise
from ledgerline.llm.textscan import mix, text_chunks, word_hashes, word_spans
from ledgerline.session import ensure_checkpoint_dir

LEAST = 10
ABSORB = 50
TOP = 2000
WORDS = 3
WINDOW_BYTES = 1 << 21
OUT_ROWS = 1 << 16
SCAN_ROWS = 1024                        # rows of a batch that are unpacked at a time
FILTER_BITS = 1 << 27
BITS_PER_KEY = 12
PROBES = 4

_SPACE, _LOWER = np.uint8(32), np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_BREAK = np.zeros(256, dtype=bool)
_IS_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
# breaks and white space become spaces, the rest is lower-cased
_FOLD = np.where(_IS_BREAK, _SPACE, _LOWER)
_FOLD[9] = _SPACE

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


# ---------------------------------------------------------------- counts

class Words:
    """The words of one window of texts, as numbers: ``ids`` by occurrence,
    equal for equal (language, word); ``run`` is the number of the occurrence's
    piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray):
        folded = _FOLD[data]
        starts, ends, doc_words = word_spans(folded, offsets)
        lengths = ends - starts
        place = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_string(), len(starts), [
            None, pa.py_buffer(place), pa.py_buffer(folded[folded != _SPACE])])
        coded = words.dictionary_encode()
        lang_of = np.repeat(langs, np.diff(doc_words))
        size = max(1, len(coded.dictionary))
        known, self.ids = np.unique(lang_of * size + coded.indices.to_numpy(), return_inverse=True)
        self.lang, word = known // size, known % size
        self.words = coded.dictionary.take(pa.array(word))
        piece = np.cumsum(_IS_BREAK[data])
        self.run = piece[starts] + np.repeat(np.arange(len(langs)), np.diff(doc_words)) if len(starts) else starts

    def runs(self, length: int) -> np.ndarray:
        """First occurrences of the runs of ``length`` words within a piece."""
        if len(self.ids) < length:
            return np.empty(0, np.int64)
        last = len(self.ids) - length + 1
        return np.flatnonzero(self.run[:last] == self.run[length - 1:])


def _hashes(strings: pa.Array) -> np.ndarray:
    """64-bit hashes of whole strings."""
    strings = strings.cast(pa.large_binary())
    offsets = np.frombuffer(strings.buffers()[1], dtype=np.int64)[strings.offset:strings.offset + len(strings) + 1]
    data = strings.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return word_hashes(data, offsets[:-1], offsets[1:], lower=False) if len(strings) else np.empty(0, np.uint64)


def _key(lang: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """A hash of (language, words), from the hashes of each."""
    key = lang
    for word in words:
        key = mix(key * _A + word * _B)
    return key


def _probes(keys: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    step = mix(keys + _A) | np.uint64(1)
    for j in range(PROBES):
        yield (keys + np.uint64(j) * step) & np.uint64(bits - 1)


def _filter_slots(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [np.concatenate(x) for x in zip(*(
                (word_hashes(d, s, e, lower=False), np.repeat(np.arange(lo, lo + len(w) - 1), np.diff(w)))
                for lo, d, s, e, w in ((lo, d, *word_spans(d, o)) for lo, _, d, o in text_chunks(batch.column(1)))))]
            if not data:
                continue
            hashes, row = data
            first = np.searchsorted(row, np.arange(batch.num_rows))
            length = int((row == 0).sum())
            keys = _key(_hashes(batch.column(0)), [hashes[first + i] for i in range(length)])
            at = np.unique(np.concatenate(list(_probes(keys, bits))))
            slot, bit = at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63))
            starts = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1]]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot[starts].astype(np.int64)), pa.array(np.bitwise_or.reduceat(bit, starts).view(np.int64))],
                ["slot", "bits"])
    return run


def phrase_filter(frequent: DataFrame, most_bits: int = FILTER_BITS) -> np.ndarray:
    """Bloom filter of the phrases (lang, phrase), all of the same number of
    words, as 64-bit words; at most ``most_bits`` in size."""
    wanted = max(64, frequent.count() * BITS_PER_KEY)
    bits = min(most_bits, 1 << (wanted - 1).bit_length())
    slots = (frequent.select("lang", "phrase").mapInArrow(_filter_slots(bits), "slot long, bits long")
             .groupBy("slot").agg(F.bit_or("bits").alias("bits")).toArrow())
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[slots["slot"].to_numpy()] = slots["bits"].to_numpy().view(np.uint64)
    return out


def _passes(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    ok = np.ones(len(keys), dtype=bool)
    for at in _probes(keys, len(table) * 64):
        ok &= table[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1) == 1
    return ok


def _windows(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, last row + 1, bytes and offsets of each window of a batch."""
    for first in range(0, len(texts), SCAN_ROWS):
        for lo, hi, data, offsets in text_chunks(texts.slice(first, SCAN_ROWS), WINDOW_BYTES):
            yield first + lo, first + hi, data, offsets
        pa.default_memory_pool().release_unused()


def _count(length: int, shorter):
    """Counts of the runs of ``length`` words whose runs of one word less pass
    the filter ``shorter`` (none for single words). Single words
    also give the number of all words of a language, under a null phrase."""
    def window(w: Words, langs: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
        """Numbers of the words of each distinct run, and its count."""
        if length == 1:
            return [np.arange(len(w.words))], np.bincount(w.ids, minlength=len(w.words))
        word = _hashes(w.words)
        lang = _hashes(langs)[w.lang]
        n = np.uint64(max(1, len(w.words)))
        ids = w.ids.astype(np.uint64)
        at = w.runs(length)
        if length == 2:
            fine = _passes(_key(lang, [word]), shorter.value)
            at = at[fine[w.ids[at]] & fine[w.ids[at + 1]]]
            keys, counts = np.unique(ids[at] * n + ids[at + 1], return_counts=True)
            return [(keys // n).astype(np.int64), (keys % n).astype(np.int64)], counts
        pairs, of = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)
        a, b = (pairs // n).astype(np.int64), (pairs % n).astype(np.int64)
        fine = _passes(_key(lang[a], [word[a], word[b]]), shorter.value)
        at = at[fine[of[at]] & fine[of[at + 1]]]
        keys, counts = np.unique(of[at].astype(np.uint64) * n + ids[at + 2], return_counts=True)
        pair, third = (keys // n).astype(np.int64), (keys % n).astype(np.int64)
        return [a[pair], b[pair], third], counts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = pc.fill_null(batch.column(0), "und").dictionary_encode()
            langs, codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
            texts = batch.column(1)
            del batch
            for lo, hi, data, offsets in _windows(texts):
                w = Words(data, offsets, codes[lo:hi])
                if len(w.ids) < length:
                    continue
                numbers, counts = window(w, langs)
                lang = w.lang[numbers[0]]
                phrase = pc.binary_join_element_wise(*(w.words.take(pa.array(i)) for i in numbers), pa.scalar(" ", pa.large_string()))
                phrase = phrase.cast(pa.string())
                if length == 1:
                    sums = np.bincount(lang, weights=counts, minlength=len(langs)).astype(np.int64)
                    lang = np.concatenate([lang, np.arange(len(langs))])
                    phrase = pa.concat_arrays([phrase, pa.nulls(len(langs), pa.string())])
                    counts = np.concatenate([counts, sums])
                del w, numbers
                for a in range(0, len(phrase), OUT_ROWS):       # small batches: the JVM holds one at a time
                    b = a + OUT_ROWS
                    yield pa.RecordBatch.from_arrays(
                        [langs.take(pa.array(lang[a:b])), phrase.slice(a, OUT_ROWS), pa.array(counts[a:b].astype(np.int64))],
                        ["lang", "phrase", "f"])
    return run


def phrase_counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """Written counts (lang, phrase, f) of all runs of one to ``WORDS`` words with
    f at least ``least``, and (lang, n) of all words."""
    texts = docs.select("lang", "text")
    sc = docs.sparkSession.sparkContext
    shorter, kept, totals = None, [], None
    for length in range(1, WORDS + 1):
        summed = (texts.mapInArrow(_count(length, shorter), "lang string, phrase string, f long")
                  .groupBy("lang", "phrase").agg(F.sum("f").alias("f")))
        found = materialise(summed.filter((F.col("f") >= least) | F.col("phrase").isNull()), f"phrases-{length}")
        if length == 1:
            totals = found.filter(F.col("phrase").isNull()).select("lang", F.col("f").alias("n"))
            found = found.filter(F.col("phrase").isNotNull())
        kept.append(found)
        if length < WORDS:
            shorter = sc.broadcast(phrase_filter(found))
    return kept[0].unionByName(kept[1]).unionByName(kept[2]), totals


# ---------------------------------------------------------------- streams

def _lengths(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Number of words and count of each row."""
    n = 1 + batch.column("k2").is_valid().to_numpy(False).astype(int) + batch.column("k3").is_valid().to_numpy(False)
    return n, batch.column("f").to_numpy()


def _partition_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row: the last counts of one and two words, and the largest
    count of three before the first pair."""
    one = two = None
    lead = 0
    for batch in batches:
        n, f = _lengths(batch)
        if two is None:
            pairs = np.flatnonzero(n == 2)
            before = n[:pairs[0]] if len(pairs) else n
            lead = max(lead, int(f[:len(before)][before == 3].max(initial=0)))
        for length in (1, 2):
            at = np.flatnonzero(n == length)
            if len(at):
                one, two = (int(f[at[-1]]), two) if length == 1 else (one, int(f[at[-1]]))
    yield pa.RecordBatch.from_arrays(
        [pa.array([v], pa.int64()) for v in (TaskContext.get().partitionId(), one, two, lead)], ["part", "one", "two", "lead"])


def _beside(starts: dict[int, tuple[int, int, int]]):
    """Adds the counts of the first word (``one``) and of the first two (``two``)
    and the largest count of an extension (``longer``) to each row of a
    sorted stream."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two, later = starts[TaskContext.get().partitionId()]
        held, longest = None, 0                 # the open pair's row, its longest extension so far

        def out(batch: pa.RecordBatch, *added: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(np.asarray(a, dtype=np.int64)) for a in added)],
                                              [*batch.schema.names, "one", "two", "longer"])

        for batch in batches:
            if batch.num_rows == 0:
                continue
            n, f = _lengths(batch)
            place = np.arange(len(n))
            single = np.maximum.accumulate(np.where(n == 1, place, -1))
            pair = np.maximum.accumulate(np.where(n == 2, place, -1))
            ones = np.where(single >= 0, f[single], one)
            twos = np.where(pair >= 0, f[pair], two)
            triple = n == 3
            longer = np.zeros(len(n), dtype=np.int64)
            inside = triple & (pair >= 0)
            np.maximum.at(longer, pair[inside], f[inside])
            longest = max(longest, int(f[triple & (pair < 0)].max(initial=0)))
            last = int(pair[-1])
            given = np.ones(len(n), dtype=bool)
            if last >= 0:
                if held is not None:
                    yield out(held[0], held[1], held[2], [longest])
                held, longest = (batch.slice(last, 1), ones[last:last + 1], twos[last:last + 1]), int(longer[last])
                given[last] = False
            keep = pa.array(given)
            yield out(batch.filter(keep), ones[given], twos[given], longer[given])
            one, two = int(ones[-1]), int(twos[-1])
        if held is not None:
            yield out(held[0], held[1], held[2], [max(longest, later)])
    return run


def _merged(stream: DataFrame) -> DataFrame:
    """``stream`` (lang, k1, k2, k3, f, ...) with one, two and longer, met in
    the order of the keys."""
    keys = [F.col("lang"), *(F.col(k).asc_nulls_first() for k in ("k1", "k2", "k3"))]
    ordered = stream.repartitionByRange(*keys).sortWithinPartitions(*keys).checkpoint()
    ends = ordered.select("k2", "k3", "f").mapInArrow(_partition_ends, "part long, one long, two long, lead long").collect()
    ends.sort(key=lambda r: r.part)
    starts, one, two = {}, 0, 0
    for r in ends:
        starts[r.part] = one, two
        one, two = (one if r.one is None else r.one), (two if r.two is None else r.two)
    later = 0
    for r in reversed(ends):
        starts[r.part] += (later,)
        later = r.lead if r.two is not None else max(later, r.lead)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema.fields)
    return ordered.mapInArrow(_beside(starts), f"{schema}, one long, two long, longer long")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, absorb: int = ABSORB) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases in
    ``docs`` (lang, text)."""
    ensure_checkpoint_dir(docs.sparkSession)
    counts, totals = phrase_counts(docs, least)
    words = F.split("phrase", " ")
    prefix = _merged(counts.select("lang", "phrase", *(F.get(words, i).alias(f"k{i + 1}") for i in range(WORDS)), "f"))
    size = F.size(words)
    backwards = [F.get(words, size - 1 - i).alias(f"k{i + 1}") for i in range(WORDS)]
    suffix = _merged(prefix.select(
        "lang", "phrase", *backwards, "f", F.col("one").alias("first"), F.col("two").alias("first_two"),
        F.col("longer").alias("right")))
    a, first, first_two, last, last_two = (F.col(c).cast("decimal(20,0)") for c in ("f", "first", "first_two", "one", "two"))

    def score(left, right):
        return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (a * a).cast("decimal(31,0)"),
                               (left * right).cast("decimal(38,0)"))

    pair = F.col("k3").isNull()
    early = F.when(pair, score(first, last)).otherwise(score(first, last_two))
    late = F.when(~pair, score(first_two, last))
    scored = (suffix.filter(F.col("k2").isNotNull())
              .filter(~pair | (100 * F.greatest("right", "longer") < absorb * F.col("f")))
              .withColumns({"early": early, "late": late})
              .withColumn("cut_late", F.coalesce(F.col("late") < F.col("early"), F.lit(False)))
              .select("lang", "phrase", F.col("f").alias("a"),
                      F.when(F.col("cut_late"), F.col("first_two")).otherwise(F.col("first")).alias("l"),
                      F.when(F.col("cut_late") | pair, F.col("one")).otherwise(F.col("two")).alias("r"),
                      F.when(F.col("cut_late"), F.col("late")).otherwise(F.col("early")).alias("score")))
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(best).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
