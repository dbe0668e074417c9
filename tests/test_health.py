from datetime import datetime, timedelta

import pytest

from adlake.plans import health
from adlake.plans.health import MIB, run_health
from adlake.tables.lake import bootstrap

AS_OF = datetime(2024, 1, 31)


def verdict(frame):
    row = frame.first()
    return row["metric_value"], row["severity"]


@pytest.mark.parametrize(
    "seconds, expected", [(600, (10.0, "OK")), (601, (10.016667, "WARN")), (1800, (30.0, "WARN")), (1801, (30.016667, "CRITICAL"))]
)
def test_silver_freshness(spark, seconds, expected):
    frame = spark.createDataFrame([(AS_OF - timedelta(seconds=seconds),)], "event_time timestamp")
    assert verdict(health.silver_freshness(frame, AS_OF)) == expected


@pytest.mark.parametrize("minutes, severity", [(90, "OK"), (91, "WARN"), (180, "WARN"), (181, "CRITICAL")])
def test_gold_freshness(spark, minutes, severity):
    frame = spark.createDataFrame([(AS_OF - timedelta(minutes=minutes),)], "gold_updated_at timestamp")
    assert verdict(health.gold_freshness(frame, AS_OF)) == (float(minutes), severity)


def test_freshness_of_nothing(spark):
    row = health.silver_freshness(spark.createDataFrame([], "event_time timestamp"), AS_OF).first()
    assert tuple(row) == ("silver_freshness_minutes", 999999.0, "CRITICAL", None)


def days(spark, counts):
    rows = [((AS_OF - timedelta(days=n)).date(), f"{n}-{i}") for n, count in counts.items() for i in range(count)]
    return spark.createDataFrame(rows, "event_date date, event_id string")


@pytest.mark.parametrize(
    "counts, expected",
    [
        ({}, (0.0, "CRITICAL")),
        ({8: 5}, (0.0, "CRITICAL")),  # older than the window
        ({7: 5}, (5.0, "OK")),
        ({1: 3, 2: 17}, (3.0, "OK")),  # exactly 0.3 of the mean
        ({1: 2, 2: 17}, (2.0, "WARN")),
    ],
)
def test_daily_rows(spark, counts, expected):
    assert verdict(health.daily_row_count(days(spark, counts), AS_OF)) == expected


def test_daily_rows_details(spark):
    row = health.daily_row_count(days(spark, {1: 3, 2: 18}), AS_OF).first()
    assert row["details"] == "active_days=2, min_rows=3, avg_rows=10, max_rows=18"


def test_duplicates(spark):
    frame = days(spark, {1: 2})
    assert verdict(health.duplicate_event_ids(frame, AS_OF)) == (0.0, "OK")
    assert verdict(health.duplicate_event_ids(frame.unionAll(frame), AS_OF)) == (2.0, "CRITICAL")


def listing(spark, *entries):
    return spark.createDataFrame(
        [("p", int(length), AS_OF, kind) for length, kind in entries],
        "path string, length bigint, modificationTime timestamp, content string",
    )


@pytest.mark.parametrize(
    "length, expected", [(16 * MIB, (16.0, "OK")), (16 * MIB - 1, "WARN"), (None, (0.0, "CRITICAL"))]
)
def test_avg_file_size(spark, length, expected):
    frame = listing(spark, *([] if length is None else [(length, "DATA")]), (1, "DELTA"))
    got = verdict(health.avg_file_size(frame))
    assert got == expected or got[1] == expected


@pytest.mark.parametrize(
    "small, large, expected",
    [(7, 3, (0.7, "OK")), (8, 3, "WARN"), (0, 1, (0.0, "OK")), (0, 0, (0.0, "CRITICAL"))],
)
def test_small_file_ratio(spark, small, large, expected):
    frame = listing(spark, *[(32 * MIB - 1, "0")] * small, *[(32 * MIB, "DATA")] * large)
    got = verdict(health.small_file_ratio(frame))
    assert got == expected or got[1] == expected


@pytest.mark.parametrize("count, severity", [(300, "OK"), (301, "WARN")])
def test_snapshot_growth(spark, count, severity):
    frame = spark.range(count).selectExpr("id AS commit", "TIMESTAMP'2024-01-30 00:00:00' AS committed_at")
    older = spark.createDataFrame([(9999, AS_OF - timedelta(hours=24, seconds=1))], "commit bigint, committed_at timestamp")
    row = health.snapshot_growth(frame.unionAll(older), AS_OF).first()
    assert (row["metric_value"], row["severity"]) == (count, severity)
    assert row["details"] == f"latest_snapshot_id={count - 1}, snapshots_24h={count}"


def test_snapshot_growth_of_nothing_has_no_details(spark):
    frame = spark.createDataFrame([], "commit bigint, committed_at timestamp")
    assert tuple(health.snapshot_growth(frame, AS_OF).first())[1:] == (0.0, "OK", None)


@pytest.mark.parametrize("count, severity", [(1000, "OK"), (1001, "WARN")])
def test_commit_records(spark, count, severity):
    frame = spark.range(count).selectExpr("1048576L AS length")
    row = health.commit_record_count(frame).first()
    assert (row["metric_value"], row["severity"]) == (count, severity)
    assert row["details"] == f"manifests={count}, avg_manifest_length_mb=1.0"


METRIC = "metric_ts timestamp, query_name string, batch_id bigint, row_count bigint, batch_duration_ms bigint, status string, detail string"


@pytest.mark.parametrize(
    "ms, severity", [(60000, "OK"), (60001, "WARN"), (120000, "WARN"), (120001, "CRITICAL")]
)
def test_batch_duration(spark, ms, severity):
    at = AS_OF - timedelta(minutes=15)
    rows = [(at, "q", 1, 1, ms, "failed", ""), (at - timedelta(seconds=1), "q", 0, 1, 999999, "success", "")]
    row = health.batch_duration(spark.createDataFrame(rows, METRIC), AS_OF).first()
    assert (row["metric_value"], row["severity"]) == (ms, severity)
    assert row["details"] == "recent_batches=1, failed_batches=1"


def test_batch_duration_of_nothing(spark):
    row = health.batch_duration(spark.createDataFrame([], METRIC), AS_OF).first()
    assert tuple(row)[1:] == (0.0, "OK", None)


@pytest.mark.parametrize(
    "deltas, data, severity",
    [(1, 2, "OK"), (2, 2, "WARN"), (0, 0, "OK"), (1, 0, "WARN"), (1000, 5000, "OK"), (1001, 5000, "CRITICAL")],
)
def test_delta_files(spark, deltas, data, severity):
    frame = listing(spark, *[(MIB, "DELTA")] * deltas, *[(5, "DATA")] * data)
    row = health.delta_file_count(frame).first()
    assert (row["metric_value"], row["severity"]) == (deltas, severity)
    assert row["details"] == f"delete_files={deltas}, data_files={data}, delete_file_mb={float(deltas)}"


def test_gold_delta_files_are_two_rows(spark):
    frame = health.gold_delta_file_count(listing(spark, (1, "1")), listing(spark))
    assert {(r["metric_name"], r["metric_value"]) for r in frame.collect()} == {
        ("gold_hourly_delete_file_count", 1.0),
        ("gold_daily_delete_file_count", 0.0),
    }


def test_run_on_an_empty_lake(spark, folder):
    lake = bootstrap(spark, folder)
    got = {r["metric_name"]: r for r in run_health(lake, AS_OF).collect()}
    assert len(got) == 12
    assert got["silver_freshness_minutes"]["severity"] == "CRITICAL"
    assert all(r["run_ts"] == AS_OF and r["query_file"] for r in got.values())
    run_health(lake, AS_OF + timedelta(minutes=15))
    assert lake.health_results.read().count() == 24
