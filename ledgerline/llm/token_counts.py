"""Token counts through a cache keyed by content and tokenizer digests.

The *content digest* is the SHA-256 of the normalised text: null counts as
empty, and the file's own normaliser applies (the byte-level files have none).
The *tokenizer digest* is the SHA-256 of the vocabulary file, so a new file
never meets counts of an old one. The cache is a Parquet table
(tokenizer_digest, content_digest, n_tokens) in shared storage.

Per call: digests are joined to the stored counts, each distinct text without a
count is encoded once, the new counts are appended, and all rows take their
count by an equi-join on the digest. A hot text (a third of the rows) is cut
to one row per map task before the shuffle, and its rows' join is one that
Spark can split, as both sides are plain tables.

Encoding uses the rank form of the same vocabulary, which is several times
faster than the library of the ``.json`` form and gives the same ids; special
tokens' own strings in a text are those tokens, and texts with characters
unknown to Python's Unicode tables go to the library itself.

Defined cases: null and empty texts have 0 bytes and 0 tokens; repeated rows
each get a result row; an empty table gives an empty result; other columns are
not read. Calls at the same time, or one that is run again, may append a count
twice: it is read once; different counts of one digest are an error.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.bpe import _AFTER_LATIN, _BYTE_LEVEL_PATTERN, byte_alphabet
from ledgerline.llm.storage import materialise

TOKEN_LIMIT = 1024
PART_CHARS = 1 << 16

_CACHE_SCHEMA = "tokenizer_digest string, content_digest string, n_tokens long"
# a space before a word and after another one always starts a new piece
_WORD_GAP = re.compile(r"(?<=[A-Za-z]) (?=[A-Za-z])")


class TokenCounter:
    """Counts of a byte-level BPE file, as the ``tokenizers`` library gives them."""

    def __init__(self, path: str):
        import tiktoken
        import tokenizers
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["normalizer"] is not None or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("token counts need a byte-level file without a normaliser")
        byte_of = {c: b for b, c in enumerate(byte_alphabet())}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in spec["model"]["vocab"].items()}
        # ranks must order the merges: ids follow the merge list in such files
        merged = [spec["model"]["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)]
                  for m in spec["model"]["merges"]]
        self._ordered = merged == sorted(merged)
        self._library = tokenizers.Tokenizer.from_file(path)
        self._fast = tiktoken.Encoding("counts", pat_str=_BYTE_LEVEL_PATTERN, mergeable_ranks=ranks,
                                       special_tokens={})
        self._specials = [t["content"] for t in spec["added_tokens"]]
        self._special = re.compile("|".join(map(re.escape, self._specials))) if self._specials else None

    def _parts(self, text: str) -> Iterator[str]:
        at = 0
        while len(text) - at > PART_CHARS:
            gap = _WORD_GAP.search(text, at + PART_CHARS)
            if gap is None:
                break
            yield text[at:gap.start()]
            at = gap.start()
        yield text[at:]

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self._ordered or (max(text) >= _AFTER_LATIN
                                 and any(unicodedata.category(c) == "Cn" for c in set(text))):
            return len(self._library.encode(text, add_special_tokens=False).ids)
        specials = 0
        pieces = [text]
        if self._special and any(s in text for s in self._specials):
            pieces = self._special.split(text)
            specials = len(pieces) - 1
        return specials + sum(len(self._fast.encode_ordinary(part)) for piece in pieces for part in self._parts(piece))


@functools.lru_cache(maxsize=2)
def load_counter(path: str) -> TokenCounter:
    """One per Python worker and file."""
    return TokenCounter(path)


def tokenizer_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _count_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = load_counter(path)
        for batch in batches:
            counts = [counter.count(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())],
                                             ["content_digest", "n_tokens"])
    return run


def count_tokens(docs: DataFrame, path: str, cache: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_tokens, over_limit.
    ``cache`` is the folder of the stored counts; it is made if missing."""
    spark = docs.sparkSession
    version = tokenizer_digest(path)
    spark.createDataFrame([], _CACHE_SCHEMA).write.mode("append").parquet(cache)

    def stored() -> DataFrame:
        return (spark.read.schema(_CACHE_SCHEMA).parquet(cache)
                .filter(F.col("tokenizer_digest") == version)
                # two writers, or a call that was run again, may have stored a count twice
                .groupBy("content_digest").agg(F.min("n_tokens").alias("least"), F.max("n_tokens").alias("most"))
                .select("content_digest", F.when(F.col("least") == F.col("most"), F.col("most")).otherwise(
                    F.raise_error(F.concat(F.lit("different counts are stored for "), "content_digest")).cast("long"))
                        .alias("stored_tokens")))

    content = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", content.alias("content"), F.sha2(content, 256).alias("content_digest"))
    rows = materialise(keyed.select("doc_id", F.octet_length("content").cast("long").alias("n_bytes"),
                                    "content_digest"), "content-digests")
    same = Window.partitionBy("content_digest").orderBy("content_digest")
    misses = (keyed.select("content_digest", "content")
              .withColumn("place", F.row_number().over(same)).filter(F.col("place") == 1)
              .join(stored(), "content_digest", "left_anti")
              .select("content_digest", "content"))
    (misses.mapInArrow(_count_batches(path), "content_digest string, n_tokens long")
     .select(F.lit(version).alias("tokenizer_digest"), "content_digest", "n_tokens")
     .write.mode("append").parquet(cache))
    return (rows.join(stored(), "content_digest", "left")
            .select("doc_id", "n_bytes", F.col("stored_tokens").alias("n_tokens"),
                    (F.col("stored_tokens") > limit).alias("over_limit")))
