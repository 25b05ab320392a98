"""Word and shingle scans over Arrow batches of texts, in numpy.

A *word* is a maximal run of bytes other than space and 0x09-0x0D, after
lower-casing A-Z. White space of that kind is ASCII, so scanning UTF-8 bytes
gives the same words as scanning characters. Whole texts are scanned; a batch
is cut into runs of documents of about ``CHUNK_BYTES``, so the memory of a
scan follows the largest of that size and the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20
SHINGLE_WORDS = 5

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False

_ODD = np.uint64(0x9E3779B97F4A7C15)          # multiplier of the rolling hash
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser: spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# one pseudo-random 64-bit value per byte
_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n, base, dtype=np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


_POW = _powers(_ODD, CHUNK_BYTES + 1)
_POW_INVERSE = _powers(_ODD_INVERSE, CHUNK_BYTES + 1)


def text_chunks(texts: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row + 1, bytes, offsets)`` for runs of rows of about
    ``chunk_bytes``; null texts are empty. Offsets start at 0."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    n = len(texts)
    if n == 0:
        return
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[texts.offset:texts.offset + n + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + chunk_bytes, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        lo = hi


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the words, and the index of the first word of
    each document (one more entry than documents)."""
    is_word = _IS_WORD[data]
    size = len(data)
    if size == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    opens = is_word.copy()
    opens[1:] &= ~is_word[:-1]
    closes = is_word.copy()
    closes[:-1] &= ~is_word[1:]
    # a document boundary parts words as white space does
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    opens[first] = is_word[first]
    closes[last] = is_word[last]
    starts = np.flatnonzero(opens)
    ends = np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _polynomial(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rolling-hash values (mod 2^64) of the given spans of one block."""
    size = len(values)
    pw = _POW if size < len(_POW) else _powers(_ODD, size + 1)
    inv = _POW_INVERSE if size < len(_POW_INVERSE) else _powers(_ODD_INVERSE, size + 1)
    total = np.empty(size + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(values * pw[:size], out=total[1:])
    return (total[ends] - total[starts]) * inv[starts]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hashes of the words, A-Z lower-cased first unless told not to."""
    out = np.empty(len(starts), dtype=np.uint64)
    table = _BYTE_VALUE[_LOWER] if lower else _BYTE_VALUE
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + CHUNK_BYTES, side="right")))
        s, e = int(starts[a]), int(ends[b - 1])
        out[a:b] = _polynomial(table[data[s:e]], starts[a:b] - s, ends[a:b] - s)
        a = b
    return mix(out + (ends - starts).astype(np.uint64) * _ODD)


def shingle_hashes(words: np.ndarray, doc_words: np.ndarray, k: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of every run of ``k`` words of each document, and the
    index of each document's first one. A document of 1 to k-1 words has one:
    its whole sequence. A document without words has none."""
    counts = np.diff(doc_words)
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64), np.zeros(len(doc_words), np.int64)
    doc_of = np.repeat(np.arange(len(counts)), counts)
    left = doc_words[1:][doc_of] - np.arange(n)             # words up to the document's end
    length = np.minimum(np.minimum(left, k), counts[doc_of])
    is_first = np.zeros(n, dtype=bool)
    is_first[doc_words[:-1][counts > 0]] = True
    keep = (left >= k) | (is_first & (counts[doc_of] < k))
    acc = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        here = np.zeros(n, dtype=np.uint64)
        here[:max(0, n - j)] = words[j:] * _POW[j + 1]
        here[length <= j] = 0
        acc += here
    acc = mix(acc + length.astype(np.uint64))
    per_doc = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    return acc[keep], np.concatenate([[0], np.cumsum(per_doc)])
