"""The pipeline: stages work on what the one before kept, against the plain
versions of their operators; and the subpackage's queries and SQL."""

import hashlib

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
import pytest
import tokenizers

import __spark_entry__ as entry
from ledgerline.llm import queries
from ledgerline.llm.storage import materialise
from scripts.oracle_check import compare_all
from tests.llm.cases import documents, lower_ascii
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_near_dedup import brute as near

SF = "/root/testdata/sf0.001"


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF), f"test-{name}")
        kept.append({r.doc_id: r for r in docs.collect()})
    quality, exact, near_kept, clean, encoded = kept
    by_text = {}
    for i, r in quality.items():
        by_text.setdefault(lower_ascii(r.text), []).append(i)
    assert set(exact) == {max(ids) for ids in by_text.values()}
    groups = near([(i, r.text) for i, r in exact.items()], 80)
    assert set(near_kept) == {i for i, (_, _, keep) in groups.items() if keep}
    found = {d for d, _ in leaks([(i, r.text) for i, r in near_kept.items()], items)}
    assert set(clean) == set(near_kept) - found
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert set(encoded) == set(clean)
    for i, r in encoded.items():
        ids = library.encode(clean[i].text, add_special_tokens=False).ids
        assert r.token_ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == set(encoded)


def test_stages_keep_columns_and_take_odd_rows(spark):
    docs = documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert out.count() <= docs.count()
        assert stage(spark, docs.limit(0), SF).count() == 0
    name, last = corpus_pipeline.STAGES[-1]
    assert last(spark, docs, SF).count() == docs.count()


def test_registered_queries():
    names = set(entry.queries())
    assert {"pipeline", *queries.QUERIES} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    assert set(queries.ORACLE) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_match_their_sql(spark, name):
    assert duckdb.__name__
    result = compare_all(spark, SF, [name], log=lambda *a: None)[name]
    assert result["status"] == "ok", result
