from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from chatlake.llm import bpe as B
from tests.llm.fixtures import TEXTS, documents

RANKS = B.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
ENCODER = B.Encoder(RANKS, public_tokenizers.PATTERN)
REFERENCE = tiktoken.Encoding(
    "reference", pat_str=public_tokenizers.PATTERN, mergeable_ranks=dict(RANKS), special_tokens={}
)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_any_text_like_the_library(text):
    ids = ENCODER.encode(text)
    assert ids.tolist() == REFERENCE.encode_ordinary(text)
    assert ENCODER.decode(ids) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abteinro ", max_size=60), st.integers(0, 60))
def test_join_is_the_encoding_of_the_whole(text, cut):
    raw = text.encode()
    left, right = raw[:cut], raw[cut:]
    assert ENCODER.join(ENCODER.merge(left), ENCODER.merge(right)) == ENCODER.merge(raw)
    assert ENCODER.encode_bytes(raw) == ENCODER.merge(raw)


@pytest.mark.parametrize("text", ["a" * 5000, "xyzab" * 3000, "ab " * 40_000, "日本語" * 3000, " \n\t" * 3000, "1" * 777])
def test_long_matches_and_long_texts(text):
    assert ENCODER.encode(text).tolist() == REFERENCE.encode_ordinary(text)


def test_parts_of_a_long_text_do_not_matter(monkeypatch):
    rng = random.Random(9)
    text = "".join(rng.choice(["Wort ", "don't", " 12", "\n\n ", "  ", "é", "!? ", "end. "]) for _ in range(3000))
    monkeypatch.setattr(B, "PART", 50)
    assert ENCODER.encode(text).tolist() == REFERENCE.encode_ordinary(text)


def test_awkward_rows_and_round_trip(spark):
    vocabulary = B.Vocabulary(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    docs = documents(spark)
    encoded = B.encode_documents(docs, vocabulary)
    out = [(r.doc_id, r.ids) for r in encoded.collect()]
    assert [ids for _, ids in out] == [REFERENCE.encode_ordinary(t or "") for _, t in TEXTS]
    raw = [bytes(r.raw) for r in B.decode_documents(encoded, vocabulary).collect()]
    assert raw == [(t or "").encode() for _, t in TEXTS]
    digests = docs.select(vocabulary.digests(F.col("text")).alias("d")).select("d.*").collect()
    for (_, t), r in zip(TEXTS, digests):
        ids = REFERENCE.encode_ordinary(t or "")
        assert r.n_tokens == len(ids) and r.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
    assert B.encode_documents(documents(spark, []), vocabulary).count() == 0
