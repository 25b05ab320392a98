"""Cross-entropy difference of a target and a background language model.

Both models are interpolated bigram models over words (A-Z lower-cased) and
share one vocabulary. Words, histories and word pairs are counted under their
own 64-bit hashes, so no two of them share a count, and every word of every
document counts. The background is all documents; the target is the documents
of ``target_ids`` (here those labelled as good and not toxic).

Documents are written in *chunks* of about ``CHUNK_TEXT`` bytes. A task counts
its chunk's distinct keys and sends them, sorted and packed, to *slices* of the hash
space; a slice sums what all chunks sent and sends each chunk, for its own keys in
their order, what the other chunks counted. So each key moves once per chunk that has it
(however common, a key has one entry per chunk), no document's pairs are joined, a
slice holds about ``SLICE_TEXT`` bytes' keys at any size, and nothing reaches the
driver but one sum. A chunk is then scored with its counts. The models
are *matched*: background counts are scaled to the target's number of tokens,
so both are smoothed alike, and a document's own counts are taken off both
models before it is scored, so neither has seen it:

    p(w | v) = (c(v w) + PAIR_MASS * p(w)) / (c(v) + PAIR_MASS)
    p(w)     = (c(w) + 1 / 2) / (N + V / 2)

V is the number of distinct words of the corpus and ``UNIGRAMS`` unseen ones,
so p(w) sums to no more than 1. A document's score is the mean over its tokens
of log2 p_target - log2 p_background (the cross-entropy difference: higher is
more like the target). A document starts in a state of its own.

Defined cases: null and empty texts have no tokens and null scores; an empty
target gives the uniform target model; repeated rows count as often as they
occur; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.near_dedup import BROADCAST_IDS
from ledgerline.llm.storage import materialise
from ledgerline.llm.textscan import mix, text_chunks, word_hashes, word_spans

UNIGRAMS = 1 << 20                      # words that the corpus doesn't have
PAIR_MASS = 64.0
WORD, HISTORY, PAIR = 0, UNIGRAMS, 2 * UNIGRAMS     # kinds of counts
CHUNK_TEXT = 8 << 20                    # bytes of text that are counted together
PART_TOKENS = 1 << 18                   # tokens that are scored at a time
SLICE_TEXT = 16 << 20                   # bytes of text whose keys are a slice's share

_START = np.uint64(0x5DEECE66D)         # the state before a document's first word


def _tokens(texts) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By chunk: first row, last row + 1, index of each document's first word,
    and per word the hashes of the word, of the one before, and of the pair."""
    for lo, hi, data, offsets in text_chunks(texts):
        starts, ends, doc_words = word_spans(data, offsets)
        words = word_hashes(data, starts, ends)
        before = np.empty_like(words)
        before[1:] = words[:-1]
        before[doc_words[:-1][doc_words[:-1] < doc_words[1:]]] = _START
        pairs = mix(before * np.uint64(0x9E3779B97F4A7C15) + words)
        yield lo, hi, doc_words, words.view(np.int64), before.view(np.int64), pairs.view(np.int64)


def _chunks(limit: int):
    """Documents in runs of about ``limit`` bytes of text, a row each: its number,
    bytes and documents (doc_id, text, of_target) as a compressed Arrow stream."""
    def packed(number: int, size: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(table)
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([size], pa.int64()), pa.array([sink.getvalue().to_pybytes()])],
            ["chunk", "n_bytes", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size, held = TaskContext.get().partitionId() << 32, 0, []
        for batch in batches:
            for lo, hi, data, _ in text_chunks(batch.column(1)):
                held.append(batch.slice(lo, hi - lo))
                size += len(data) + 8 * (hi - lo)       # rows without text count too
                if size >= limit:
                    yield packed(number, size, held)
                    number, size, held = number + 1, 0, []
        if held:
            yield packed(number, size, held)
    return run


def _indexed(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, index = np.unique(keys, return_inverse=True)
    return distinct, index.astype(np.int32)


@dataclass(frozen=True)
class _Chunk:
    """Documents by token: ``pair``, ``word`` and ``before`` index the sorted
    distinct ``pairs`` and ``words`` (the start is one of these)."""
    doc_ids: pa.Array
    of_target: np.ndarray
    n_tokens: np.ndarray
    pairs: np.ndarray
    words: np.ndarray
    pair: np.ndarray
    word: np.ndarray
    before: np.ndarray

    @classmethod
    def of(cls, packed: bytes) -> _Chunk:
        docs = pa.ipc.open_stream(packed).read_all().combine_chunks()
        parts = list(_tokens(docs["text"]))
        n_tokens = np.concatenate([np.diff(p[2]) for p in parts])
        words, pairs = (np.concatenate([p[k] for p in parts]).view(np.uint64) for k in (3, 5))
        del parts
        pairs, pair = _indexed(pairs)
        words, word = _indexed(words)
        before = np.empty_like(word)
        if len(word):
            start = int(np.searchsorted(words, _START))
            if start == len(words) or words[start] != _START:
                words = np.insert(words, start, _START)
                word += word >= start
            before[1:] = word[:-1]
            before[(np.cumsum(n_tokens) - n_tokens)[n_tokens > 0]] = start
        return cls(docs["doc_id"].combine_chunks(), docs["of_target"].to_numpy().astype(bool), n_tokens,
                   pairs, words, pair, word, before)

    def parts(self) -> Iterator[tuple[slice, slice]]:
        """Runs of documents of some ``PART_TOKENS`` tokens, and their tokens."""
        ends = np.concatenate([[0], np.cumsum(self.n_tokens)])
        lo = 0
        while lo < len(self.n_tokens):
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + PART_TOKENS, side="right")) - 1)
            yield slice(lo, hi), slice(ends[lo], ends[hi])
            lo = hi

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """(n, n_target) of the pairs; (n, n_target, and both as history) of the words."""
        wanted = np.repeat(self.of_target, self.n_tokens)

        def both(index: np.ndarray, keys: np.ndarray) -> list[np.ndarray]:
            return [np.bincount(i, minlength=len(keys)) for i in (index, index[wanted])]

        return (np.array(both(self.pair, self.pairs), np.int64),
                np.array(both(self.word, self.words) + both(self.before, self.words), np.int64))


def _pack(columns: np.ndarray) -> bytes:
    """Columns of 64-bit numbers, compressed by planes of their bytes."""
    planes = np.ascontiguousarray(columns).view(np.uint8).reshape(*columns.shape, 8).transpose(0, 2, 1)
    return columns.shape[1].to_bytes(8, "little") + pa.Codec("zstd").compress(planes.tobytes(), asbytes=True)


def _unpack(packed: bytes, columns: int) -> np.ndarray:
    n = int.from_bytes(packed[:8], "little")
    planes = pa.Codec("zstd").decompress(packed[8:], decompressed_size=columns * n * 8, asbytes=True) if n else b""
    planes = np.frombuffer(planes, np.uint8).reshape(columns, 8, n)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.int64).reshape(columns, n)


def _pack_keys(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted distinct keys, as differences, and their counts."""
    steps = np.diff(keys, prepend=np.uint64(0)).view(np.int64)
    return _pack(np.concatenate([steps[None], counts]))


def _unpack_keys(packed: bytes, counts: int) -> tuple[np.ndarray, np.ndarray]:
    columns = _unpack(packed, counts + 1)
    return np.cumsum(columns[0].view(np.uint64), dtype=np.uint64), columns[1:]


_SENT = "slice int, chunk long, pairs binary, words binary, names binary"


def _sent(slices: int, named: bool):
    """Each chunk's keys and counts, a row for every slice; ``named``: with the
    word and history of each pair."""
    cuts = np.array([(i << 64) // slices for i in range(1, slices)], dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                chunk = _Chunk.of(packed.as_py())
                of_pairs, of_words = chunk.counts()
                names = np.empty((2, len(chunk.pairs)), np.int64)
                if named:
                    names[0, chunk.pair] = chunk.words[chunk.word].view(np.int64)
                    names[1, chunk.pair] = chunk.words[chunk.before].view(np.int64)
                p, w = ([0, *np.searchsorted(keys, cuts).tolist(), len(keys)] for keys in (chunk.pairs, chunk.words))
                columns = [
                    list(range(slices)), [number] * slices,
                    [_pack_keys(chunk.pairs[a:b], of_pairs[:, a:b]) for a, b in zip(p, p[1:])],
                    [_pack_keys(chunk.words[a:b], of_words[:, a:b]) for a, b in zip(w, w[1:])],
                    [_pack(names[:, a:b]) if named else b"" for a, b in zip(p, p[1:])]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int64(), *[pa.binary()] * 3))],
                    [f.split()[0] for f in _SENT.split(", ")])
    return run


def _summed(sent: pa.ChunkedArray, counts: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """Distinct keys of a slice, their counts over all chunks, and by chunk the places of its
    keys among them and its own counts."""
    parts = [_unpack_keys(x.as_py(), counts) for x in sent]
    keys, places = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    places = np.split(places, np.cumsum([len(k) for k, _ in parts])[:-1])
    totals = np.zeros((counts, len(keys)), np.int64)
    for at, (_, own) in zip(places, parts):
        totals[:, at] += own                # a chunk has a key once
    return keys, totals, places, [own for _, own in parts]


def _counts_of_slice(table: pa.Table) -> pa.Table:
    pairs, of_pairs, places, _ = _summed(table["pairs"], 2)
    words, of_words, _, _ = _summed(table["words"], 4)
    names = np.empty((2, len(pairs)), np.int64)
    for at, packed in zip(places, table["names"]):
        names[:, at] = _unpack(packed.as_py(), 2)
    words = words.view(np.int64)

    def rows(bucket: int, n: np.ndarray, n_target: np.ndarray, **keys: np.ndarray) -> pa.Table:
        seen = n > 0
        none = pa.nulls(int(seen.sum()), pa.int64())
        return pa.table({"bucket": pa.array(np.full(len(none), bucket, np.int32)),
                         **{k: pa.array(keys[k][seen]) if k in keys else none for k in ("pair", "word", "before")},
                         "n": pa.array(n[seen]), "n_target": pa.array(n_target[seen])})

    return pa.concat_tables([rows(WORD, of_words[0], of_words[1], word=words),
                             rows(HISTORY, of_words[2], of_words[3], before=words),
                             rows(PAIR, of_pairs[0], of_pairs[1], pair=pairs.view(np.int64), word=names[0], before=names[1])])


_ANSWER = "chunk long, slice int, pairs binary, words binary, vocabulary long, n long, n_target long"


def _answers_of_slice(table: pa.Table) -> pa.Table:
    """For each chunk the counts of its keys in the other chunks, and the slice's
    number of words and of their occurrences."""
    answers = {}
    for kind, counts in (("pairs", 2), ("words", 4)):
        _, totals, places, own = _summed(table[kind], counts)
        answers[kind] = pa.array([_pack(totals[:, at] - mine) for at, mine in zip(places, own)], pa.binary())
    rows = len(table)
    sums = {"vocabulary": (totals[0] > 0).sum(), "n": totals[0].sum(), "n_target": totals[1].sum()}
    return pa.table({"chunk": table["chunk"], "slice": table["slice"], **answers,
                     **{k: pa.array([int(v)] * rows, pa.int64()) for k, v in sums.items()}})


def _own(doc_of: np.ndarray, index: np.ndarray, keys: int) -> np.ndarray:
    """How often each token's key occurs in the token's own document."""
    _, place, n = np.unique(doc_of * keys + index, return_inverse=True, return_counts=True)
    return n[place]


def _scored(chunks: pa.Table, answers: pa.Table) -> pa.Table:
    """The scores of a chunk's documents. Every slice sent one answer, so
    their sums are those of the corpus."""
    chunk = _Chunk.of(chunks["docs"][0].as_py())
    answers = answers.sort_by("slice")
    of_pairs, of_words = (own + np.concatenate([_unpack(x.as_py(), len(own)) for x in answers[kind]], axis=1)
                          for kind, own in zip(("pairs", "words"), chunk.counts()))
    words, n_all, n_target = (sum(answers[c].to_pylist()) for c in ("vocabulary", "n", "n_target"))
    vocabulary = words + UNIGRAMS

    def bits(docs: slice, tokens: slice) -> list[np.ndarray]:
        """-log2 p by document, summed over its tokens, by the target and by the background model."""
        n_tokens = chunk.n_tokens[docs]
        doc_of = np.repeat(np.arange(len(n_tokens)), n_tokens)
        _, at, m = np.unique(doc_of * len(chunk.pairs) + chunk.pair[tokens], return_index=True, return_counts=True)
        doc, pair, word, before = (x[at] for x in (doc_of, chunk.pair[tokens], chunk.word[tokens], chunk.before[tokens]))
        own_word, own_before = (_own(doc_of, i[tokens], len(chunk.words))[at] for i in (chunk.word, chunk.before))

        def by(model: int, mine: np.ndarray, total: int, scale: float) -> np.ndarray:
            # counts less ``mine`` times the document's own, scaled
            def left(counts: np.ndarray, of_doc: np.ndarray) -> np.ndarray:
                return np.maximum(counts - of_doc * mine, 0) * scale

            p = ((left(of_words[model, word], own_word) + 0.5)
                 / (np.maximum(total - n_tokens[doc] * mine, 0) * scale + 0.5 * vocabulary))
            each = -m * np.log2((left(of_pairs[model, pair], m) + PAIR_MASS * p)
                                / (left(of_words[2 + model, before], own_before) + PAIR_MASS))
            return np.bincount(doc, each, len(n_tokens))

        return [by(1, chunk.of_target[docs][doc].astype(np.int64), n_target, 1.0),
                by(0, np.ones(len(doc), np.int64), n_all, n_target / n_all if n_target else 1.0)]

    target, background = np.concatenate([bits(*part) for part in chunk.parts()], axis=1) / np.maximum(chunk.n_tokens, 1)
    none = chunk.n_tokens == 0
    return pa.table({"doc_id": chunk.doc_ids, "n_tokens": pa.array(chunk.n_tokens.astype(np.int64)),
                     **{k: pa.array(v, mask=none) for k, v in (("ce_target", target), ("ce_background", background),
                                                               ("score", background - target))}})


def good_ids(labels: DataFrame) -> DataFrame:
    """Ids of documents labelled as good and not toxic."""
    return (labels.filter((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0))
            .select(F.col("doc_id").alias("target_id")).filter(F.col("target_id").isNotNull()).distinct())


def _marked(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """(doc_id, text, of_target); up to BROADCAST_IDS ids are broadcast, more
    are joined by a shuffle."""
    few = target_ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return (docs.select("doc_id", "text")
            .join(F.broadcast(target_ids) if few else target_ids, F.col("doc_id") == F.col("target_id"), "left")
            .select("doc_id", "text", F.col("target_id").isNotNull().alias("of_target")))


def _sent_by_chunks(marked: DataFrame, named: bool) -> tuple[DataFrame, DataFrame]:
    """The written chunks of (doc_id, text, of_target), and what they send to the slices."""
    chunks = materialise(marked.select("doc_id", "text", "of_target").mapInArrow(
        _chunks(CHUNK_TEXT), "chunk long, n_bytes long, docs binary"), "chunks")
    slices = -(-(chunks.agg(F.sum("n_bytes")).first()[0] or 0) // SLICE_TEXT) or 1
    return chunks, chunks.select("chunk", "docs").mapInArrow(_sent(slices, named), _SENT)


def ngram_counts(marked: DataFrame) -> DataFrame:
    """(bucket, pair, word, before, n, n_target) over all rows of (doc_id, text,
    of_target): the written counts of pairs, and those of words and histories,
    told apart by ``bucket`` (WORD, HISTORY or PAIR)."""
    _, sent = _sent_by_chunks(marked, named=True)
    return materialise(sent.groupBy("slice").applyInArrow(
        _counts_of_slice, "bucket int, pair long, word long, before long, n long, n_target long"), "ngram-counts")


def score_documents(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ce_target, ce_background
    (bits per token) and score = ce_background - ce_target. ``target_ids``:
    distinct (target_id)."""
    chunks, sent = _sent_by_chunks(_marked(docs, materialise(target_ids, "target-ids")), named=False)
    answers = sent.groupBy("slice").applyInArrow(_answers_of_slice, _ANSWER)
    schema = T.StructType([docs.schema["doc_id"], *T.StructType.fromDDL(
        "n_tokens long, ce_target double, ce_background double, score double").fields])
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_scored, schema)
