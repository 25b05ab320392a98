"""Token counts: the library's counts, and what the cache saves."""

import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

from ledgerline.llm import token_counts as tc
from ledgerline.session import scratch_path
from tests.llm.cases import LONG, documents, empty

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = tokenizers.Tokenizer.from_file(PATH)


def test_counter_equals_library():
    counter = tc.load_counter(PATH)
    for text in ("", " ", "Hello  world\n\n\nit's", "<|endoftext|>x<|endoftext|>", "é́日本🙂", "Ᲊ new", "\x00\x1c\x85",
                 "a" * 5000, " " * 5000, LONG, LONG.replace(" ", ""), "x y" * 60_000):
        assert counter.count(text) == len(LIBRARY.encode(text, add_special_tokens=False).ids), text[:40]


def test_cache(spark, monkeypatch):
    cache = scratch_path(spark, "test-counts")
    docs = documents(spark)
    got = tc.count_tokens(docs, PATH, cache).collect()
    expected = [(r.doc_id, len((r.text or "").encode()), n := len(LIBRARY.encode(r.text or "", add_special_tokens=False).ids),
                 n > 1024) for r in docs.collect()]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    stored = spark.read.parquet(cache)
    texts = {r.text or "" for r in docs.collect()}
    assert stored.count() == len(texts)                     # each distinct text once
    # a second call encodes only what is new
    more = documents(spark, [(1, "a new text"), (2, "a new text"), (3, LONG), (4, None)])
    again = {r.doc_id: r.n_tokens for r in tc.count_tokens(more, PATH, cache).collect()}
    assert again[1] == again[2] == 3 and again[4] == 0
    assert spark.read.parquet(cache).count() == len(texts) + 1
    # counts are taken from the cache, not made anew
    wrong = scratch_path(spark, "test-wrong")
    stored.withColumn("n_tokens", F.lit(77).cast("long")).write.parquet(wrong)
    assert {r.n_tokens for r in tc.count_tokens(docs, PATH, wrong).collect()} == {77}
    # another tokenizer's counts are not used
    other = scratch_path(spark, "test-other")
    stored.withColumn("tokenizer_digest", F.lit("other")).withColumn("n_tokens", F.lit(77).cast("long")).write.parquet(other)
    assert 77 not in {r.n_tokens for r in tc.count_tokens(docs, PATH, other).collect()}


def test_counts_stored_twice(spark):
    """Two writers: rows stay one each; counts that differ are an error."""
    cache = scratch_path(spark, "test-twice")
    docs = documents(spark)
    first = sorted(map(repr, tc.count_tokens(docs, PATH, cache).collect()))
    doubled = scratch_path(spark, "test-doubled")
    stored = spark.read.parquet(cache)
    stored.unionByName(stored).write.parquet(doubled)
    assert sorted(map(repr, tc.count_tokens(docs, PATH, doubled).collect())) == first
    assert spark.read.parquet(doubled).count() == 2 * stored.count()         # nothing is encoded again
    stored.withColumn("n_tokens", F.col("n_tokens") + 1).write.mode("append").parquet(doubled)
    with pytest.raises(Exception, match="different counts"):
        tc.count_tokens(docs, PATH, doubled).collect()


def test_empty_table(spark):
    assert tc.count_tokens(empty(spark), PATH, scratch_path(spark, "test-none")).count() == 0
