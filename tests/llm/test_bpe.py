"""Matrix BPE against the public library."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from lakemart.llm import bpe

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.vocabulary(PATH).ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.vocabulary(PATH), P.PATTERN)


def ids(encoder, text):
    return np.frombuffer(encoder.encode([text])[0], "<i4").tolist()


PIECES = st.sampled_from([" ", "  ", "\n", " \n", "\t", "\x1c", "\x85", "　", "'s", "'ll", "the", "Étion", "ñ", "漢字", "🙂", "123", "!!", "<|endoftext|>", "a" * 40, "ab" * 30, "x"])


@settings(max_examples=500, deadline=None)
@given(st.lists(PIECES, max_size=20).map("".join) | st.text(max_size=60))
def test_equals_the_library(library, encoder, text):
    assert ids(encoder, text) == library.encode_ordinary(text)


@pytest.mark.parametrize("size", [257, 3000])
@pytest.mark.parametrize("alphabet", ["a", "ab", "abcdefghijklmnopqrstuvwxyz", "éñü", "!?"])
def test_long_words(library, encoder, size, alphabet):
    rng = np.random.default_rng(size)
    word = "".join(rng.choice(list(alphabet), size))
    assert ids(encoder, word) == library.encode_ordinary(word)


def test_matrix_and_long_way_agree():
    vocab = bpe.vocabulary(PATH)
    rng = np.random.default_rng(1)
    words = [bytes(rng.choice(list(b"aehinorst"), int(n)).tolist()) for n in rng.integers(1, 64, 500)]
    for word, row in zip(words, bpe.encode_matrix(vocab, words, 64)):
        assert row.tolist() == bpe.encode_long(vocab, word).tolist()


def test_frames(spark):
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, "the end", 0), (3, "the end", 0), (None, "x" * 5000, 0)], "doc_id long, text string, ids int")
    coded = bpe.encode(docs, PATH, P.PATTERN)
    rows = {(r.doc_id, bytes(r.decoded).decode()) for r in bpe.decode(coded, PATH).collect()}
    assert rows == {(1, ""), (2, ""), (3, "the end"), (None, "x" * 5000)}
    assert coded.count() == 5
    assert bpe.decode(bpe.encode(docs.limit(0), PATH, P.PATTERN), PATH).count() == 0


def test_query_equals_the_library(spark, sf_small, library):
    from lakemart.llm.queries import op1_bpe

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    got = {r.doc_id: r for r in op1_bpe(spark, sf_small).collect()}
    assert got.keys() == docs.keys()
    for k, text in docs.items():
        want = library.encode_ordinary(text)
        assert got[k].n_tokens == len(want)
        assert got[k].ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
