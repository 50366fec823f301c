import hashlib

import public_tokenizers
import pytest
from fixture import documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from veracast.llm import bpe, token_counts
from veracast.llm.tokenizer import Merges

WORDS, BYTES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
LISTS = {path: Merges(path) for path in (WORDS, BYTES)}
TEXTS = [
    None, "", " ", "\n\n  ", "a" * 3000, "they'll've 's" * 90, "x <|endoftext|> y <|startoftext|>z <|endoftext|>", "İstanbul ΑΣ ΑΣΑ é́É",
    "  lead trail  ", "the" * 1500 + " " + "qz" * 900, "中文字 日本語 กขค العربية 👍🏽 \x1c\x85​﻿", "12 345 ٣ ½", "á ́b",
]


@pytest.fixture(scope="module")
def libraries():
    return Tokenizer.from_file(WORDS), Tokenizer.from_file(BYTES)


def test_encode_decode_like_the_library(spark, libraries):
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)] + [(None, "null id", "s"), (0, "again", "s"), (0, "again", "s")]
    found = sorted((str(r.doc_id), r.ids, r.decoded) for r in bpe.encode_decode(documents(spark, rows), WORDS).collect())
    expected = []
    for i, t, _ in rows:
        ids = libraries[0].encode(t or "", add_special_tokens=False).ids
        expected.append((str(i), ids, libraries[0].decode(ids, skip_special_tokens=False)))
    assert found == sorted(expected)


def test_counts_like_the_library(spark, libraries):
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)] + [(None, "null id", "s"), (0, "again", "s")]
    found = sorted((r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(documents(spark, rows), BYTES, limit=5).collect())
    counts = [(len((t or "").encode()), len(libraries[1].encode(t or "", add_special_tokens=False).ids)) for _, t, _ in rows]
    assert found == sorted((b, n, n > 5) for b, n in counts)


def test_empty_tables(spark):
    empty = documents(spark, [(1, "x", "s")]).limit(0)
    assert bpe.encode_decode(empty, WORDS).collect() == []
    assert token_counts.count_tokens(empty, BYTES).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aetonsr' .,!é1\n<|>", max_size=300), st.integers(1, 60))
def test_chunk_maps_compose(libraries, text, size):
    own = token_counts.transducer(BYTES)
    assert own.count(text, size) == len(libraries[1].encode(text, add_special_tokens=False).ids)


@settings(max_examples=25, deadline=None)
@given(st.text(alphabet="etaoinsrhth", min_size=400, max_size=1500))
def test_streamed_tokens_are_stable(text):
    for path in (WORDS, BYTES):
        own = LISTS[path]
        piece = text.encode()
        streamed = [i for part in own.stream(piece) for i in part]
        assert streamed == own.merged(own.letters(piece))


def test_decoder_holds_back_cut_characters():
    ids = Tokenizer.from_file(BYTES).encode("日本 é👍 <|endoftext|> x", add_special_tokens=False).ids
    own = bpe.Decoder(LISTS[BYTES])
    assert own.decode(ids) == "日本 é👍 <|endoftext|> x"
    assert hashlib.sha256("".join(own.text(ids * 9000)).encode()).digest() == hashlib.sha256(("日本 é👍 <|endoftext|> x" * 9000).encode()).digest()
