"""BPE against the tokenizers library: ids, counts and decoded texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.llm import bpe
from tests.llm.cases import LONG, documents, empty

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module", params=[WORDS, BYTES])
def pair(request):
    return bpe.load_tokenizer(request.param), tokenizers.Tokenizer.from_file(request.param)


def ids_of(own, text):
    return np.frombuffer(b"".join(own.encode(text)), "<u4").tolist()


def agree(pair, text):
    own, library = pair
    ids = library.encode(text, add_special_tokens=False).ids
    assert ids_of(own, text) == ids, text[:80]
    decoder = bpe.Decoder(own)
    data = np.array(ids, "<u4").tobytes()
    whole = "".join(decoder.feed(data[i:i + 4]) for i in range(0, len(data), 4)) + decoder.flush()
    assert whole == library.decode(ids, skip_special_tokens=False)


def test_same_as_library_on_written_cases(pair):
    for text in ("", " ", "Hello  World\n\n it's 12,345 déjà-vu", "<|endoftext|>", "a<|startoftext|>b <|endoftext|>",
                 "ΣΑΣ ΟΔΟΣ İı ﬁ", "é è̖", "日本語テキスト 🙂🙂", "\x00\x1c\x85 x", "Ᲊ new letters", "'s't're",
                 "a" * 3000, "ab" * 2000, "1" * 500, "!?" * 400, LONG[:20_000]):
        agree(pair, text)


@settings(max_examples=150, deadline=None, derandomize=True)
@given(st.text(max_size=60))
def test_same_as_library_on_any_text(text):
    for path in (WORDS, BYTES):
        agree((bpe.load_tokenizer(path), tokenizers.Tokenizer.from_file(path)), text)


def test_long_words_are_streamed_in_constant_memory(pair):
    own, library = pair
    rng = random.Random(3)
    word = "".join(rng.choice("abehinorst") for _ in range(30_000))
    symbols = word if own.words else word
    portions = list(own.model.stream(symbols))
    assert len(portions) > 3                                    # emitted on the way
    assert max(map(len, portions)) <= 2 * own.model.lookahead   # not kept until the end
    assert [i for p in portions for i in p] == library.encode(word, add_special_tokens=False).ids


def test_lookahead_is_computed_from_the_merges():
    vocab = {c: i for i, c in enumerate("abc")} | {"bc": 3, "abc": 4}
    assert bpe.BpeModel(vocab, [("b", "c"), ("a", "bc")]).lookahead == 2
    assert bpe.BpeModel(vocab, [("b", "c")]).lookahead == 1


def test_documents(spark):
    library = tokenizers.Tokenizer.from_file(WORDS)
    docs = documents(spark)
    got = bpe.encode_documents(docs, WORDS, with_ids=True).collect()
    expected = []
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        expected.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                         hashlib.sha256(text.encode()).hexdigest(), ids))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    texts = {r.doc_id: r.text for r in bpe.decode_documents(
        bpe.encode_documents(docs, WORDS, with_ids=True), WORDS).collect()}
    assert texts[9] == "one</w> two</w>" and texts[4] == ""
    assert bpe.encode_documents(empty(spark), WORDS).count() == 0
