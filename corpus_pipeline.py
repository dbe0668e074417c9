"""Cleans the documents table for training: five stages, each one operator.

language ID -> line dedup -> n-gram Jaccard join -> benchmark decontamination
-> BPE round trip. Every stage works on all rows its predecessor kept, of any
length. All but the last return the columns of ``documents`` and leave others out,
so an extra column, whatever its name, changes nothing. An empty table gives an
empty one. Rows with a null doc_id go through like others.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm import bpe, decontamination, jaccard_join, language_id, line_dedup
from adlake.llm.shared import of_hash, read_table, stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# The best language of any text scores at least what chance gives it; below this
# multiple of that, no language stands out.
LEAST_LIFT = 1.2


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter (or null), and those of no clear language.

    ``lang`` becomes the language found. With nothing to learn from, nothing
    but texts without a letter is rejected, and ``lang`` stays.
    """
    found = language_id.identify(docs, ~of_hash("doc_id", 4, 2))
    # Where one language alone is known, it is certain and no likelier than chance.
    clear = (F.col("lang_lift") >= LEAST_LIFT) | (F.col("score") == 1)
    named = (F.col("lang_pred") != language_id.UNDETERMINED) & clear
    # ``und`` with score 0 for a text with letters: there was no network.
    unlearnt = (F.col("lang_pred") == language_id.UNDETERMINED) & F.col("text").rlike(r"\p{L}")
    kept = found.where(named | unlearnt).withColumn("lang", F.when(named, F.col("lang_pred")).otherwise(F.col("lang")))
    return kept.select(*COLUMNS)


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated lines out of the texts; documents of nothing else go.

    A null or empty text and one of fewer than three lines stay as they are.
    Rows equal in doc_id and text are one document and stay or go together; an
    equal text under a later doc_id goes. ``n_chars`` follows the text.
    """
    found = line_dedup.dedup_lines(docs)
    kept = found.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    length = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", length).select(*COLUMNS)


def keep_one_near_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates the document of the smallest doc_id stays.

    Rows of one doc_id stay or go together, also where they are equal. Null and
    empty texts, and rows with a null doc_id, are near to nothing and stay.
    """
    return jaccard_join.keep_one(docs).select(*COLUMNS)


def drop_benchmark_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go.

    A null or empty text holds none; equal texts stay or go together. Null and
    very short items are not looked for (``decontamination.unsearched``).
    """
    found = decontamination.match_items(docs, read_table(spark, sf_dir, "benchmark"))
    return found.where(F.size("matched_items") == 0).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the number of tokens and digests of the ids and the decoded bytes.

    A null text counts as the empty one. Every row stays.
    """
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", cut_repeated_lines),
    ("jaccard_join", keep_one_near_copy),
    ("decontamination", drop_benchmark_documents),
    ("bpe", encode),
]

# A trained network and an edit distance have no SQL; tests compare with a
# brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
