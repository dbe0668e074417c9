from __future__ import annotations

import hashlib

from pyspark.sql import functions as F
from samples import prose

import corpus_pipeline

DIR = "/root/testdata/sf0.001"


def test_stages_on_the_table(spark):
    from test_jaccard_join import brute as near
    from test_line_dedup import brute as lines

    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], DIR).cache())
    told, cut, single, clean, encoded = frames[1:]
    assert told.count() == docs.where("text rlike '\\\\p{L}'").count()
    text = {row["doc_id"]: row["text"] for row in told.collect()}
    expected = {number: kept for number, (kept, gone) in lines(text.items()).items() if not gone or kept != "" or gone < text[number].count("\n") + 1}
    assert {row["doc_id"]: row["text"] for row in cut.collect()} == expected
    found = near(expected.items())
    assert {row["doc_id"] for row in single.collect()} == {number for number, (_, top) in found.items() if top == number}
    items = [row["text"] for row in spark.read.parquet(f"{DIR}/benchmark.parquet").collect()]
    kept = {row["doc_id"] for row in clean.collect()}
    for row in single.collect():
        assert not (row["doc_id"] in kept and any(item in row["text"] for item in items))
    assert single.count() - clean.count() <= 12
    assert encoded.count() == clean.count() and all(frame.columns == docs.columns for frame in frames[1:-1])


def test_odd_and_empty_tables(spark, odd, empty):
    """Which rows each stage keeps, extra columns and one very long text among them."""
    text = "long words here " * 340_000
    more = odd.unionByName(spark.createDataFrame([(20, text, "en", "src0", len(text))], odd.schema))
    docs, kept = more.withColumns({"_id": F.lit(1), "lang_pred": F.lit("x"), "n_tokens": F.lit("x")}), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DIR).cache()
        kept[name] = sorted(((row["doc_id"], len(row["text"])) for row in docs.collect()), key=str)
        if name != "bpe":
            assert docs.columns == corpus_pipeline.COLUMNS
    letters = [(None, 9), (4, 5), (4, 5), (5, len(prose(5, 60))), (6, len(prose(5, 60))), (6, len(prose(5, 60))), (7, 3000), (8, len(prose(8, 4000))), (9, 200), (20, len(text))]
    assert kept["language_id"] == sorted(letters, key=str)
    assert kept["line_dedup"] == sorted([row for row in letters if row[0] != 6], key=str)
    assert kept["jaccard_join"] == kept["decontamination"] == kept["bpe"] == kept["line_dedup"]
    long = docs.where("doc_id = 20").first()
    assert long["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    docs = empty
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DIR)
        assert docs.count() == 0
