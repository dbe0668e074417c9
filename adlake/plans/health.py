"""Health checks: one row per metric with its value, severity and details.

Each check takes frames, so it runs on any table with the same columns. The
moment it looks from, ``as_of``, is an argument: a repeated run gives the same row.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.functions.exprs import as_utc, timestamp_literal
from adlake.operators.dedup import duplicate_keys
from adlake.operators.filters import trailing
from adlake.operators.projections import tag_run
from adlake.sources.file_stats import file_stats
from adlake.tables.files import exists
from adlake.tables.append_table import append_rows
from adlake.tables.lake import Lake
from adlake.tables.maintenance import data_folders
from adlake.tables.upsert_table import UpsertTable

MIB = 1024 * 1024

# What each check looks back over and grades by. All limits are
# strict: a value on the limit does not exceed it.
SILVER_AGE_MINUTES = {"warn": 10, "critical": 30}
GOLD_AGE_MINUTES = {"warn": 90, "critical": 180}
AGE_OF_NOTHING = 999999.0
EVENT_WINDOW = timedelta(days=7)
LOW_DAY_SHARE = 0.3  # of the mean daily rows
LOW_AVG_FILE = 16 * MIB
SMALL_FILE = 32 * MIB
SMALL_FILE_SHARE = 0.7
SNAPSHOT_WINDOW = timedelta(hours=24)
MANY_SNAPSHOTS = 300
MANY_MANIFESTS = 1000
BATCH_WINDOW = timedelta(minutes=15)
BATCH_MS = {"warn": 60000, "critical": 120000}
MANY_DELTA_FILES = 1000
DELTA_FILE_SHARE = 0.5  # of the data files, at least one

# How file kinds are named, here and in common table formats.
DATA_CONTENT = ("0", "DATA")
DELTA_CONTENT = ("1", "2", "POSITION_DELETES", "EQUALITY_DELETES", "DELTA")


def _cell(name: str, value: Column, severity: Column, details: Column) -> Column:
    """One result, made of the columns of a one-row frame of statistics."""
    return F.struct(
        F.lit(name).alias("metric_name"),
        value.cast("double").alias("metric_value"),
        severity.alias("severity"),
        details.alias("details"),
    )


def _results(stats: DataFrame, *cells: Column) -> DataFrame:
    """A row per result; the statistics are planned once for all of them."""
    return stats.select(F.explode(F.array(*cells)).alias("result")).select("result.*")


def _graded(critical: Column | None, warn: Column | None) -> Column:
    """CRITICAL, else WARN, else OK; a condition that is NULL does not hold."""
    grade = None
    for condition, label in ((critical, "CRITICAL"), (warn, "WARN")):
        if condition is not None:
            grade = F.when(condition, label) if grade is None else grade.when(condition, label)
    return grade.otherwise("OK")


def _text(*parts: str | Column) -> Column:
    """Concatenation; NULL as soon as one part is."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _freshness(latest: str, column: str, name: str, limits: dict[str, int], as_of) -> Column:
    """The age of the newest time, which the statistics hold as ``latest``."""
    seconds = F.unix_timestamp(timestamp_literal(as_of)) - F.unix_timestamp(latest)
    minutes = F.round(seconds / 60, 6)
    return _cell(
        name,
        F.coalesce(minutes, F.lit(AGE_OF_NOTHING)),
        _graded(F.col(latest).isNull() | (minutes > limits["critical"]), minutes > limits["warn"]),
        _text(f"max_{column}=", F.col(latest)),
    )


def _silver_freshness(as_of) -> Column:
    return _freshness("latest", "event_time", "silver_freshness_minutes", SILVER_AGE_MINUTES, as_of)


def silver_freshness(silver: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return _results(silver.agg(F.max("event_time").alias("latest")), _silver_freshness(as_of))


def gold_freshness(hourly: DataFrame, as_of: datetime | None = None) -> DataFrame:
    stats = hourly.agg(F.max("gold_updated_at").alias("latest"))
    return _results(stats, _freshness("latest", "gold_updated_at", "gold_freshness_minutes", GOLD_AGE_MINUTES, as_of))


def daily_volume(silver: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Rows per event date of the last seven days."""
    return trailing(silver, "event_date", EVENT_WINDOW, as_of).groupBy("event_date").agg(F.count("*").alias("rows"))


def _volume_stats(rows: Column) -> list[Column]:
    """Over daily row counts; NULL counts play no part."""
    return [F.count(rows).alias("days"), F.min(rows).alias("low"), F.max(rows).alias("high"), F.avg(rows).alias("mean")]


def _daily_rows() -> Column:
    return _cell(
        "silver_daily_row_count_min_7d",
        F.coalesce("low", F.lit(0)),
        _graded(F.col("days") == 0, F.col("low") < F.col("mean") * LOW_DAY_SHARE),
        _text(
            "active_days=", F.col("days"), ", min_rows=", F.col("low"),
            ", avg_rows=", F.col("mean").cast("bigint"), ", max_rows=", F.col("high"),
        ),
    )


def daily_row_count(silver: DataFrame, as_of: datetime | None = None) -> DataFrame:
    return _results(daily_volume(silver, as_of).agg(*_volume_stats(F.col("rows"))), _daily_rows())


def _duplicates() -> Column:
    found = F.col("duplicates")
    return _cell("silver_duplicate_event_ids_7d", found, _graded(found > 0, None), _text("duplicate_event_ids=", found))


def duplicate_event_ids(silver: DataFrame, as_of: datetime | None = None) -> DataFrame:
    recent = trailing(silver, "event_date", EVENT_WINDOW, as_of)
    return _results(duplicate_keys(recent, "event_id").agg(F.count("*").alias("duplicates")), _duplicates())


def silver_checks(silver: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Freshness, daily rows and duplicates from one scan: counts per event and
    per date are two grouping sets of one aggregation."""
    start = as_utc(as_of).date() - EVENT_WINDOW
    recent = silver.select("event_id", "event_date", "event_time", (F.col("event_date") >= F.lit(start)).alias("recent"))
    groups = recent.groupingSets([["event_id"], ["event_date"]], "event_id", "event_date").agg(
        F.grouping("event_date").alias("by_event"), F.count_if("recent").alias("rows"), F.max("event_time").alias("latest")
    )
    by_event = F.col("by_event") == 1
    stats = groups.agg(
        F.max("latest").alias("latest"),
        *_volume_stats(F.when(~by_event & (F.col("rows") > 0), F.col("rows"))),
        F.count_if(by_event & (F.col("rows") > 1)).alias("duplicates"),
    )
    return _results(stats, _silver_freshness(as_of), _daily_rows(), _duplicates())


def _file_stats(only: Column | None = None) -> list[Column]:
    """All that the checks ask of a listing, or of ``only`` some of its files."""
    kind = F.col("content").cast("string")
    here = F.lit(True) if only is None else only
    is_data, is_delta = here & kind.isin(*DATA_CONTENT), here & kind.isin(*DELTA_CONTENT)
    length = F.when(is_data, F.col("length"))
    return [
        F.count(length).alias("files"),
        F.avg(length).alias("mean"),
        F.count_if(length < SMALL_FILE).alias("small"),
        F.count_if(is_delta).alias("deltas"),
        F.coalesce(F.sum(F.when(is_delta, F.col("length"))), F.lit(0)).alias("delta_bytes"),
    ]


# The cells below take the statistics by name, or from the struct named ``at``.


def _avg_file_size(at: str = "") -> Column:
    files, mean = F.col(f"{at}files"), F.col(f"{at}mean")
    megabytes = F.coalesce(mean / MIB, F.lit(0.0))
    return _cell(
        "silver_avg_file_size_mb",
        megabytes,
        _graded(files == 0, mean < LOW_AVG_FILE),
        _text("files=", files, ", avg_file_size_mb=", megabytes),
    )


def avg_file_size(files: DataFrame) -> DataFrame:
    return _results(files.agg(*_file_stats()), _avg_file_size())


def _small_file_ratio(at: str = "") -> Column:
    files, small = F.col(f"{at}files"), F.col(f"{at}small")
    ratio = small / F.nullif(files, F.lit(0))
    return _cell(
        "silver_small_file_ratio",
        F.coalesce(ratio, F.lit(0.0)),
        _graded(files == 0, ratio > SMALL_FILE_SHARE),
        _text("small_files=", F.when(files > 0, small), ", total_files=", files),
    )


def small_file_ratio(files: DataFrame) -> DataFrame:
    return _results(files.agg(*_file_stats()), _small_file_ratio())


def _metadata_files(at: str = "") -> Column:
    files = F.col(f"{at}files")
    return _cell(
        "silver_manifest_count",
        files,
        _graded(None, files > MANY_MANIFESTS),
        _text("manifests=", files, ", avg_manifest_length_mb=", F.coalesce(F.col(f"{at}mean") / MIB, F.lit(0.0))),
    )


def commit_record_count(records: DataFrame) -> DataFrame:
    """On a listing of metadata files: here those of the change feed."""
    return _results(records.agg(F.count("*").alias("files"), F.avg("length").alias("mean")), _metadata_files())


def _delta_files(name: str, at: str = "") -> Column:
    files, deltas = F.col(f"{at}files"), F.col(f"{at}deltas")
    return _cell(
        name,
        deltas,
        _graded(deltas > MANY_DELTA_FILES, deltas > F.greatest(files, F.lit(1)) * DELTA_FILE_SHARE),
        _text("delete_files=", deltas, ", data_files=", files, ", delete_file_mb=", F.col(f"{at}delta_bytes") / MIB),
    )


def delta_file_count(files: DataFrame, name: str = "silver_delete_file_count") -> DataFrame:
    """Files that take rows away from others, against data files."""
    return _results(files.agg(*_file_stats()), _delta_files(name))


def gold_delta_file_count(hourly_files: DataFrame, daily_files: DataFrame) -> DataFrame:
    return delta_file_count(hourly_files, "gold_hourly_delete_file_count").unionByName(
        delta_file_count(daily_files, "gold_daily_delete_file_count")
    )


def file_checks(silver: UpsertTable, hourly: UpsertTable, daily: UpsertTable) -> DataFrame:
    """Every check of files, from one listing of all the tables' folders."""
    feed = [silver.changes_path] if exists(silver.spark, silver.changes_path) else []
    folders = {"silver": data_folders(silver), "hourly": data_folders(hourly), "daily": data_folders(daily), "feed": feed}
    roots = {"silver": silver.data_path, "hourly": hourly.data_path, "daily": daily.data_path, "feed": silver.changes_path}
    listing = file_stats(silver.spark, [path for paths in folders.values() for path in paths])
    # A listing may leave out the scheme of a path.
    inside = {name: F.contains("path", F.lit(root.split("://", 1)[-1].removeprefix("file:") + "/")) for name, root in roots.items()}
    stats = listing.agg(*[F.struct(*_file_stats(where)).alias(name) for name, where in inside.items()])
    return _results(
        stats,
        _avg_file_size("silver."),
        _small_file_ratio("silver."),
        _delta_files("silver_delete_file_count", "silver."),
        _delta_files("gold_hourly_delete_file_count", "hourly."),
        _delta_files("gold_daily_delete_file_count", "daily."),
        _metadata_files("feed."),
    )


def snapshot_growth(commits: DataFrame, as_of: datetime | None = None) -> DataFrame:
    stats = trailing(commits, "committed_at", SNAPSHOT_WINDOW, as_of).agg(
        F.count("*").alias("recent"), F.max("commit").alias("latest")
    )
    return _results(
        stats,
        _cell(
            "silver_snapshots_last_24h",
            F.col("recent"),
            _graded(None, F.col("recent") > MANY_SNAPSHOTS),
            _text("latest_snapshot_id=", F.col("latest"), ", snapshots_24h=", F.col("recent")),
        ),
    )


def batch_duration(metrics: DataFrame, as_of: datetime | None = None) -> DataFrame:
    stats = trailing(metrics, "metric_ts", BATCH_WINDOW, as_of).agg(
        F.count("*").alias("batches"),
        F.max("batch_duration_ms").alias("longest"),
        F.sum(F.when(F.col("status") != "success", 1).otherwise(0)).alias("failed"),
    )
    return _results(
        stats,
        _cell(
            "streaming_max_batch_duration_ms_15m",
            F.coalesce("longest", F.lit(0)),
            _graded(F.col("longest") > BATCH_MS["critical"], F.col("longest") > BATCH_MS["warn"]),
            _text("recent_batches=", F.col("batches"), ", failed_batches=", F.col("failed")),
        ),
    )


# Which check each metric belongs to.
CHECK_OF = {
    "silver_freshness_minutes": "silver_freshness",
    "gold_freshness_minutes": "gold_freshness",
    "silver_daily_row_count_min_7d": "silver_daily_row_count",
    "silver_avg_file_size_mb": "silver_avg_file_size",
    "silver_small_file_ratio": "silver_small_file_ratio",
    "silver_snapshots_last_24h": "snapshot_growth_24h",
    "silver_manifest_count": "manifest_count",
    "silver_duplicate_event_ids_7d": "duplicate_event_id",
    "streaming_max_batch_duration_ms_15m": "streaming_batch_duration",
    "silver_delete_file_count": "silver_delete_file_count",
    "gold_hourly_delete_file_count": "gold_delete_file_count",
    "gold_daily_delete_file_count": "gold_delete_file_count",
}


def recent_silver(silver: UpsertTable, as_of: datetime) -> DataFrame:
    """Rows of the last seven days and of the newest date, whenever that was:
    event dates follow event times, so the newest event is among them."""
    days = silver.dates()
    start = as_of.date() - EVENT_WINDOW
    return silver.read_dates({day for day in days if day >= start} | set(days[-1:]))


def batches_of(table: UpsertTable) -> DataFrame:
    """A table's batches as commits: their name and time."""
    return table.changes().groupBy(F.col("batch").alias("commit")).agg(F.max("changed_at").alias("committed_at"))


def health_checks(lake: Lake, as_of: datetime) -> list[DataFrame]:
    """Every check on the lake's tables; Silver's rows are scanned once, and the
    tables' folders listed once."""
    silver = lake.silver
    return [
        silver_checks(recent_silver(silver, as_of), as_of),
        gold_freshness(lake.hourly.read(), as_of),
        file_checks(silver, lake.hourly, lake.daily),
        snapshot_growth(batches_of(silver), as_of),
        batch_duration(lake.batch_metrics.since(as_of - BATCH_WINDOW), as_of),
    ]


def run_health(lake: Lake, as_of: datetime | None = None) -> DataFrame:
    """Runs all checks as one job and appends their rows; returns them."""
    moment = as_utc(as_of)
    check = F.create_map(*[F.lit(text) for pair in CHECK_OF.items() for text in pair])[F.col("metric_name")]
    # One row per metric, so one file a run.
    rows = tag_run(reduce(DataFrame.unionByName, health_checks(lake, moment)), check, moment).coalesce(1)
    append_rows(rows, lake.health_results)
    return lake.health_results.since(moment).where(F.col("run_ts") == F.lit(moment))
