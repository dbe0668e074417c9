from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from adlake.llm import bpe

RANKS = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
CODEC = bpe.BytePairCodec(RANKS, public_tokenizers.PATTERN)
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def ids(text):
    return np.frombuffer(CODEC.encode(text), bpe.IDS).tolist()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("aaabcdeth's lrevm\n\t\x1c\x85　é中🙂0½.,!"), max_size=120))
def test_as_the_library(text):
    assert ids(text) == LIBRARY.encode_ordinary(text)
    assert CODEC.decode(CODEC.encode(text)) == text.encode()


@pytest.mark.parametrize("text", ["a" * 50_000, "ab" * 20_000, " " * 9_001, "thonble" * 3_000])
def test_long_pieces(text):
    assert ids(text) == LIBRARY.encode_ordinary(text)


def test_the_queue_is_clean_after_a_piece():
    CODEC.encode_piece(b"mississippi rivers" * 7)
    assert not any(CODEC.low)


def test_a_vocabulary_without_all_bytes_is_refused():
    with pytest.raises(ValueError, match="lacks"):
        bpe.BytePairCodec({b"a": 0}, "a")


def test_documents(odd, empty):
    frame = odd.withColumn("n_tokens", F.lit("clash"))
    found = bpe.round_trip(frame, RANKS, public_tokenizers.PATTERN, texts=True).collect()
    assert len(found) == odd.count()
    for row in found:
        text = row["text"] or ""
        assert row["token_ids"] == LIBRARY.encode_ordinary(text) and row["n_tokens"] == len(row["token_ids"])
        assert row["decoded"] == text and row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert row["ids_sha256"] == hashlib.sha256(np.array(row["token_ids"], "<u4").tobytes()).hexdigest()
    assert bpe.round_trip(empty, RANKS, public_tokenizers.PATTERN).count() == 0
