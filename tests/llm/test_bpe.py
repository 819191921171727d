import base64
import hashlib
import struct

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from docflow.llm import bpe, queries

DATA = "/root/testdata/sf0.001"
PATH = queries.RANKS


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(k): int(v) for k, v in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.vocabulary(PATH), most=500)


def packed(library, text):
    ids = library.encode_ordinary(text)
    return struct.pack(f"<{len(ids)}I", *ids)


def test_pattern_is_the_given_one():
    assert bpe.PATTERN == public_tokenizers.PATTERN


def test_hash_is_perfect_and_minimal():
    vocab = bpe.vocabulary(PATH)
    assert sorted(vocab.hash.key_at) == list(range(len(vocab.keys)))
    assert all(vocab.hash.index(k) == i for i, k in enumerate(vocab.keys))
    assert vocab.rank(b"\xff\xfe no token") == -1


@settings(max_examples=400, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t'sdtlrev \x1c\x85.,aZ9")), max_size=60))
def test_ids_are_the_library_s(library, encoder, text):
    assert encoder(text) == packed(library, text)


@pytest.mark.parametrize("text", ["", "a" * 3000, "ab" * 5000, " " * 999, "\n " * 300, "日" * 900, "ſ K x's X'S"])
def test_long_words_and_runs(library, encoder, text):
    assert encoder(text) == packed(library, text)


def test_another_pattern_isn_t_cut_at_spaces():
    vocab = bpe.vocabulary(PATH)
    assert bpe.Encoder(vocab, r"[\s\S]+")("a cat") == bpe.packed(vocab.encode(b"a cat"))


def test_query(spark, library):
    rows = queries.op1_bpe(spark, DATA).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert len(rows) == len(texts)
    for r in rows:
        ids = packed(library, texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_hard_cases(hard, empty, library):
    encoded = bpe.encode(hard, PATH, ["doc_id"])
    got = sorted((r.doc_id or -1, r.token_ids) for r in encoded.collect())
    want = sorted((r.doc_id or -1, packed(library, r.text or "")) for r in hard.collect())
    assert [(i, bytes(x)) for i, x in got] == want
    back = sorted(bytes(r.decoded) for r in bpe.decode(encoded, PATH, ["doc_id"]).collect())
    assert back == sorted((r.text or "").encode() for r in hard.collect())
    assert bpe.encode(empty, PATH, ["doc_id"]).count() == 0
