from __future__ import annotations

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from samples import prose

from adlake.llm import token_counts
from adlake.llm.token_counts import count_tokens, load_counter, split_safely

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text or "", add_special_tokens=False))


def texts():
    """Texts of everything that stands next to a boundary."""
    draw = random.Random(5)
    atoms = ["word", "it's", "I'LL", " ", "  ", "\n", "\n\n ", "\t", "\x1c", "\x85", " ", "　", "é", "中文", "。", "🙂", "12", "3.5", "'", "'s", "!?", "<|endoftext|>", "<|endo", "ftext|>", "\r\n", "_", "-"]
    return ["".join(draw.choice(atoms) for _ in range(draw.randrange(1, 60))) for _ in range(400)]


def test_splits_change_no_count(library, monkeypatch):
    with open(PATH, "rb") as file:
        count, boundary = load_counter(PATH, file.read())
    monkeypatch.setattr(token_counts, "BATCH_BYTES", 50)
    for size in (1, 7, 40):
        monkeypatch.setattr(token_counts, "split_safely", lambda text, at, size=size: split_safely(text, at, size))
        assert token_counts.count_texts([None, "", *texts()], count, boundary) == [0, 0, *map(library, texts())]


def test_pieces_make_up_the_text():
    for text in [*texts(), "a" * 500, "a b" * 400]:
        assert "".join(split_safely(text, token_counts.SAFE_BOUNDARY, 10)) == text
    assert len(split_safely("a b" * 400, token_counts.SAFE_BOUNDARY, 10)) > 90
    assert split_safely("a b" * 400, None, 10) == ["a b" * 400]


def test_all_documents_and_odd_texts(spark, odd, empty, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(60)
    long = spark.createDataFrame([(10**6, "中" * 100_000), (10**6 + 1, "a b. " * 1_000_000), (10**6 + 2, "<|endoftext|> " * 20_000)], "doc_id long, text string")
    frame = docs.unionByName(odd.select("doc_id", "text")).unionByName(long).withColumns({"n_tokens": F.lit("clash"), "batch": F.lit(1)})
    found = count_tokens(frame, PATH)
    assert found.columns == ["doc_id", "text", "batch", "n_bytes", "n_tokens", "over_limit"]
    for row in found.collect():
        assert row["n_bytes"] == len((row["text"] or "").encode())
        assert row["n_tokens"] == library(row["text"])
        assert row["over_limit"] == (row["n_tokens"] > 1024)
    assert count_tokens(empty, PATH).collect() == []


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_vocabularies_are_not_split(spark, make, name):
    path = public_tokenizers.path(name)
    with open(path, "rb") as file:
        count, boundary = load_counter(path, file.read())
    assert boundary is None
    rows = [(1, prose(1, 300)), (2, "  two  blanks "), (3, None), (4, "é" * 70_000)]
    found = {row["doc_id"]: row["n_tokens"] for row in count_tokens(make(rows), path).collect()}
    assert found == {doc: count([text])[0] if text else 0 for doc, text in rows}
