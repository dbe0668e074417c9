"""Compaction of the keyed tables, expiry of their change feeds, and clean-up."""

from __future__ import annotations

import math
from collections.abc import Iterable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.functions.exprs import as_utc
from adlake.sources.file_stats import file_stats
from adlake.tables import files
from adlake.tables.upsert_table import STAGING, UpsertTable

TARGET_BYTES = 128 * 1024 * 1024
GROUP_BYTES = 100 * 1024**3
RETENTION = timedelta(days=7)
RETAIN_LAST = 24
ORPHAN_AGE = timedelta(days=3)

ACTIONS = ("compact", "expire", "orphan", "all")


def data_folders(table: UpsertTable) -> list[str]:
    return [table.date_dir(day) for day in table.dates()]


def table_files(table: UpsertTable) -> DataFrame:
    """The data files of a table."""
    return file_stats(table.spark, data_folders(table))


def compaction_candidates(stats: DataFrame, date_column: str, target_bytes: int) -> DataFrame:
    """Dates whose files could be fewer, with their file count and bytes."""
    day = F.regexp_extract("path", rf"/{date_column}=(\d{{4}}-\d{{2}}-\d{{2}})/", 1)
    return (
        stats.groupBy(day.cast("date").alias(date_column))
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))
        .where(F.col("files") > F.greatest(F.lit(1), F.ceil(F.col("bytes") / target_bytes)))
    )


def compact_files(table: UpsertTable, target_bytes: int = TARGET_BYTES, group_bytes: int = GROUP_BYTES) -> list[list[date]]:
    """Rewrites dates with too many files, a group of dates at a time, and
    returns the groups. Rows stay as they are, so it may stop after any group."""
    # One row per date.
    pending = compaction_candidates(table_files(table), table.date_column, target_bytes).orderBy(table.date_column).collect()
    groups: list[dict[date, int]] = []
    size = group_bytes + 1
    for row in pending:
        if size + row["bytes"] > group_bytes:
            groups.append({})
            size = 0
        groups[-1][row[table.date_column]] = max(1, math.ceil(row["bytes"] / target_bytes))
        size += row["bytes"]
    for group in groups:
        table.rewrite_dates(group)
    return [sorted(group) for group in groups]


def expire_changes(table: UpsertTable, older_than: datetime | None = None, retain_last: int = RETAIN_LAST) -> int:
    """Drops batches of the change feed older than the limit, but for the newest
    ``retain_last``; returns how many."""
    cutoff = as_utc(older_than) if older_than else as_utc(None) - RETENTION
    batches = table.changes().groupBy("batch").agg(F.max("changed_at").alias("changed_at"))
    # One row per batch beyond those that stay, streamed rather than collected.
    newest = batches.orderBy(F.col("changed_at").desc(), "batch").limit(max(1, retain_last)).select("batch")
    old = batches.where(F.col("changed_at") < F.lit(cutoff)).join(newest, "batch", "left_anti").select("batch")
    dropped = 0
    for row in old.toLocalIterator():
        files.delete(table.spark, f"{table.changes_path}/batch={row['batch']}")
        dropped += 1
    return dropped


def orphan_files(listing: DataFrame, commits: DataFrame, older_than: datetime) -> DataFrame:
    """Files of a listing whose ``commit=<number>`` folder is not among ``commits``
    and that are older than the limit."""
    number = F.regexp_extract("path", r"commit=(\d+)/", 1).try_cast("bigint")
    return (
        listing.where(F.col("modificationTime") < F.lit(as_utc(older_than)))
        .withColumn("commit", number)
        .join(commits.select("commit"), "commit", "left_anti")
        .drop("commit")
    )


def abandoned_folders(table: UpsertTable, older_than: datetime | None = None, dry_run: bool = False) -> list[str]:
    """Staging folders that a job left behind when its driver died, older than
    the limit; unless ``dry_run``, they are deleted."""
    limit = as_utc(older_than) if older_than else as_utc(None) - ORPHAN_AGE
    found = []
    for status in files.matching(table.spark, f"{table.data_path}/{STAGING}*"):
        if status.getModificationTime() < limit.timestamp() * 1000:
            path = status.getPath().toString()
            found.append(path)
            if not dry_run:
                files.delete(table.spark, path)
    return found


def maintain(
    tables: Iterable[UpsertTable],
    action: str = "all",
    target_bytes: int = TARGET_BYTES,
    retention: timedelta = RETENTION,
    retain_last: int = RETAIN_LAST,
    orphan_age: timedelta = ORPHAN_AGE,
    dry_run: bool = False,
    as_of: datetime | None = None,
) -> list[tuple[str, str, object]]:
    """Runs one action, or all in order, on each table. Returns what each did:
    (table path, action, outcome)."""
    if action not in ACTIONS:
        raise ValueError(f"unknown action {action!r}")
    now = as_utc(as_of)
    steps = {
        "compact": lambda table: compact_files(table, target_bytes),
        "expire": lambda table: expire_changes(table, now - retention, retain_last),
        "orphan": lambda table: abandoned_folders(table, now - orphan_age, dry_run),
    }
    chosen = steps if action == "all" else {action: steps[action]}
    return [(table.path, name, step(table)) for table in tables for name, step in chosen.items()]
