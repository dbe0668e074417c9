"""Removes lines that repeat an earlier place of the corpus, by three-line windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.shared import quoted, row_key, stored

LINES = 3  # in a window


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_windows(docs: DataFrame) -> DataFrame:
    """Every window of three consecutive lines: document key, place, two hashes.

    Lines are compared without white space at their ends. Two hashes of 64 bits
    stand for a window; one of three blank lines is no window.
    """
    lines = F.transform(lines_of(F.col("text")), lambda line: F.btrim(line, F.lit(" \t\r")))
    at = F.col("at")
    three = [F.get(F.col("lines"), at + step) for step in range(LINES)]
    starts = F.when(F.size("lines") >= LINES, F.sequence(F.lit(0), F.size("lines") - LINES))
    return (
        docs.where(F.col("text").isNotNull())
        .select(*row_key(), lines.alias("lines"))
        .select("_id", "_hash", "lines", F.explode(starts).alias("at"))
        .where(F.concat(*three) != "")
        .select("_id", "_hash", "at", F.xxhash64(*three).alias("h1"), F.xxhash64(F.lit(1), *three).alias("h2"))
    )


def covered_lines(docs: DataFrame) -> DataFrame:
    """Per document with repeats: its lines inside a window that occurred before.

    Counting pre-aggregates in each task; a window that stands in a third of
    all documents is one row of the table of repeats, and the join with it is
    one whose large partitions Spark can split.
    """
    windows = line_windows(docs)
    place = F.struct("_id", "_hash", "at")
    repeats = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    repeats = stored(repeats.where("first != last").drop("last"), "repeats")
    later = windows.join(repeats, ["h1", "h2"]).where(place > F.col("first"))
    covered = F.array_distinct(F.flatten(F.transform(F.collect_set("at"), lambda at: F.sequence(at, at + LINES - 1))))
    return later.groupBy("_id", "_hash").agg(covered.alias("_covered"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """Documents with later occurrences of repeated windows cut out of ``text``.

    The first occurrence, by doc_id (null first), a hash of the text and place,
    stays. Every line covered by a later one goes; what is repeated is judged
    on the input. Adds ``n_lines`` (of the input) and ``n_removed``. Texts of
    fewer than three lines have no windows and stay; a null text stays null
    with no lines; a text whose lines all go is empty. Rows equal in doc_id and
    text are one document: a repeated row is no later occurrence. Other
    columns pass through, whatever their names.
    """
    own = docs.drop("n_lines", "n_removed")
    row = F.struct(*[F.col(quoted(name)).alias(name) for name in own.columns]).alias("_row")
    whole = F.col("_row.text")
    lines = lines_of(whole)
    count = F.when(whole.isNull(), 0).otherwise(F.size(lines))
    keep = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "_covered")
    text = F.array_join(F.transform(keep, lambda at: F.get(lines, at)), "\n")
    joined = own.select(row, *row_key()).join(covered_lines(docs.select("doc_id", "text")), ["_id", "_hash"], "left")
    made = {"text": F.when(F.col("_covered").isNull(), whole).otherwise(text)}
    columns = [made.get(name, F.col(f"_row.{quoted(name)}")).alias(name) for name in own.columns]
    removed = F.when(F.col("_covered").isNull(), 0).otherwise(F.size("_covered"))
    return joined.select(*columns, count.cast("long").alias("n_lines"), removed.cast("long").alias("n_removed"))
