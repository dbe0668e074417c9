"""The tab-separated source log as a numbered DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adlake.schemas import SOURCE_COLUMNS

HEADER = "\t".join(SOURCE_COLUMNS)

TASK_BITS = 33  # Fixed value: how Spark's rising ids hold the task above its rows

# Lines per range when looking for the n-th row.
LIMIT_RANGE = 1_000_000


def _located(lines: DataFrame) -> DataFrame:
    """Lines with their file split and an id that rises along it."""
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
    ).withColumn("_split", F.xxhash64("_file", "_start"))


def _split_offsets(located: DataFrame, good: Column) -> DataFrame:
    """Per file split: the number of its first line and of its first good row.

    One row per file split, a list the driver holds for scheduling anyway; the
    unpartitioned window runs over that.
    """
    splits = located.groupBy("_file", "_start", "_split").agg(
        F.count("*").alias("_lines"),
        F.count_if(good).alias("_good"),
        F.min("_id").alias("_first"),
        F.min(F.when(F.col("value") == HEADER, F.col("_id"))).alias("_header_id"),
    )
    headed = (F.col("_start") == 0) & F.coalesce(F.col("_header_id") == F.col("_first"), F.lit(False))
    same_hash = F.count("*").over(Window.partitionBy("_split"))
    earlier = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    # A task may hold several splits; its ids rise from the task's own start.
    task = F.shiftright("_first", TASK_BITS)
    in_task = Window.partitionBy(task).orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)

    def before(column: str, window) -> Column:
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    return (
        splits.withColumn("_skipped", headed.cast("int"))
        .withColumns({"_rows": F.col("_lines") - F.col("_skipped"), "_good_rows": F.col("_good") - F.col("_skipped")})
        .select(
            F.when(same_hash == 1, F.col("_split"))
            .otherwise(F.raise_error(F.lit("two file splits share a hash")).cast("bigint"))
            .alias("_split"),
            # The number of the split's first line; its header gets one less.
            (before("_rows", earlier) + 1 - F.col("_skipped")).alias("_number"),
            (F.col("_first") + F.col("_skipped")).alias("_first_row"),
            "_first",
            # The same over good rows, whose ids are counted apart; a header has
            # as many fields as a row.
            (before("_good_rows", earlier) + 1 - F.col("_skipped")).alias("_good_number"),
            (F.shiftleft(task, TASK_BITS) + before("_good", in_task)).alias("_first_good"),
        )
    )


def with_line_number(lines: DataFrame) -> DataFrame:
    """Numbers the lines of a text log from 1, not counting header rows.

    Ids rise along each file split, so a line's number is its place in its
    split plus the lines of earlier splits, in order of file name and start.
    Both passes scan the same splits; nothing is shuffled but one count per
    split. ``lines`` must be an untouched ``spark.read.text``.
    """
    located = _located(lines)
    # Some 60 bytes per file split, less than the driver keeps of a split itself.
    return (
        located.join(F.broadcast(_split_offsets(located, F.lit(False))), "_split")
        .where(F.col("_id") >= F.col("_first_row"))
        .select("value", (F.col("_id") - F.col("_first") + F.col("_number")).alias("line_number"))
    )


def with_row_number(lines: DataFrame, good: Column) -> DataFrame:
    """Lines that are ``good``, with ``line_number`` and their place among the
    good ones, ``row_number``: found as line numbers are, in the same two scans."""
    located = _located(lines)
    # These ids are given after the filter, so they count good lines alone.
    kept = located.where(good).withColumn("_good_id", F.monotonically_increasing_id())
    return (
        kept.join(F.broadcast(_split_offsets(located, good)), "_split")
        .where(F.col("_id") >= F.col("_first_row"))
        .select(
            "value",
            (F.col("_id") - F.col("_first") + F.col("_number")).alias("line_number"),
            (F.col("_good_id") - F.col("_first_good") + F.col("_good_number")).alias("row_number"),
        )
    )


def read_source_log(spark: SparkSession, path: str, start_line: int = 0, max_events: int = 0) -> DataFrame:
    """Source rows as text columns with ``line_number``, plain or ``.gz``.

    ``path`` is a file, or a folder whose files in name order make up the log.
    Lines with another field count are dropped after numbering, so they leave
    gaps. ``max_events`` keeps the first rows after ``start_line``; it costs no
    scan more, or with a start line one. Quotes have no meaning in the log. A
    ``.gz`` file is one split and is read by one task: store a large log as
    several files, uncompressed or in a splittable codec.
    """
    whole = F.size(F.split("value", "\t", -1)) == len(SOURCE_COLUMNS)
    if max_events:
        rows = with_row_number(spark.read.text(path), whole)
        last = F.lit(max_events)
        if start_line:
            passed = rows.where(F.col("line_number") <= start_line).agg(F.coalesce(F.max("row_number"), F.lit(0)))
            last = last + passed.scalar()
        rows = rows.where(F.col("row_number") <= last)
    else:
        rows = with_line_number(spark.read.text(path)).where(whole)
    fields = F.split("value", "\t", -1)
    return (
        rows.where(F.col("line_number") > start_line)
        .withColumn("_fields", fields)
        .select("line_number", *[F.col("_fields")[i].alias(c) for i, c in enumerate(SOURCE_COLUMNS)])
    )


def limit_events(df: DataFrame, n: int = 0) -> DataFrame:
    """The first ``n`` rows by line number; 0 means all.

    A top-n would send up to ``n`` rows of every task to one. Instead the line
    of the ``n``-th row is looked up, first by the running row count of ranges
    of lines, then by rank in the one range it falls in; rows up to it pass.
    """
    if not n:
        return df
    ranged = df.select("line_number", F.floor(F.col("line_number") / LIMIT_RANGE).alias("_range"))
    counts = ranged.groupBy("_range").agg(F.count("*").alias("_rows"))
    # One row per range, a millionth of the log, so one task does.
    before = F.sum("_rows").over(Window.orderBy("_range")) - F.col("_rows")
    bounds = counts.select("_range", "_rows", before.alias("_before"))
    bounds = bounds.where((F.col("_before") < n) & (F.col("_before") + F.col("_rows") >= n))
    rank = F.row_number().over(Window.partitionBy("_range").orderBy("line_number"))
    last = (
        ranged.join(F.broadcast(bounds), "_range")  # at most one row
        .withColumn("_rank", rank)
        .where(F.col("_rank") == n - F.col("_before"))
        .select("line_number")
    )
    return df.where(F.coalesce(F.col("line_number") <= last.scalar(), F.lit(True)))
