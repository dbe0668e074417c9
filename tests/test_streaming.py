import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from adlake.operators.projections import project_bronze
from adlake.queries import ONCE, message_feed
from adlake.schemas import BATCH_METRIC_SCHEMA, BRONZE_SCHEMA, RAW_SCHEMA
from adlake.plans.landing import rejected_rows
from adlake.sources.bronze import bronze_stream, read_bronze, register_bronze, write_bronze
from adlake.sources.messages import publish, raw_stream
from adlake.streaming.metrics import OffsetListener, batch_metric, topic_offsets
from adlake.streaming.queries import bronze_batch, silver_batch, start_bronze, start_silver
from adlake.tables import files
from adlake.tables.lake import Lake, bootstrap

SMALL = "offset <= 300"


@pytest.fixture
def lake(spark, folder):
    return bootstrap(spark, folder)


def feed(lake, sf_dir, where):
    path = f"{lake.root}/feed"
    publish(message_feed(lake.spark, sf_dir).where(where), "parquet", {"path": path})
    return path


def bronze_rows(spark, sf_dir, where=SMALL):
    return project_bronze(message_feed(spark, sf_dir).where(where))


def wait_for(check, seconds=20):
    end = time.time() + seconds
    while time.time() < end:
        if check():
            return True
        time.sleep(0.3)
    return False


def statuses(lake):
    rows = lake.batch_metrics.read().collect()
    return {(r["query_name"], r["batch_id"], r["row_count"], r["status"]) for r in rows}


def start(lake, path):
    start_bronze(lake, raw_stream(lake.spark, "parquet", {"path": path}), ONCE).awaitTermination()


def test_bronze_exactly_once_over_restarts(lake, spark, sf_dir):
    for where in ("offset <= 100", "offset > 100 AND offset <= 300"):
        path = feed(lake, sf_dir, where)
        for _ in range(2):  # a start with nothing new changes nothing
            start(lake, path)
    bronze = read_bronze(spark, lake.bronze_path)
    assert bronze.schema.names == BRONZE_SCHEMA.names
    assert bronze.count() == bronze.select("kafka_offset").distinct().count() == 300
    row = bronze.first()
    assert row["ingest_hour"] == row["bronze_ingest_ts"].strftime("%H")
    today = row["ingest_date"]
    assert read_bronze(spark, lake.bronze_path, today, today).count() == 300
    assert read_bronze(spark, lake.bronze_path, "2999-01-01").count() == 0
    assert not files.exists(spark, f"{lake.bronze_path}/_spark_metadata")
    assert len(files.child_names(spark, lake.bronze_path)) == 2
    recorded = [s for s in statuses(lake)]
    assert {(s[0], s[2], s[3]) for s in recorded} == {("kafka_to_bronze", 100, "success"), ("kafka_to_bronze", 200, "success")}
    assert lake.batch_metrics.read().first()["batch_duration_ms"] > 0


def raw(spark, sf_dir, where=SMALL):
    return message_feed(spark, sf_dir).where(where)


def test_replayed_bronze_batch_gives_the_same_rows(lake, spark, sf_dir):
    bronze_batch(lake, raw(spark, sf_dir), 0, "q")
    bronze_batch(lake, raw(spark, sf_dir), 0, "q")  # it was complete
    bronze_batch(lake, raw(spark, sf_dir, "offset > 300 AND offset <= 320"), 1, "q")
    # The second one died half-way: some files, no marker.
    folder = f"{lake.bronze_path}/batch=q-1"
    files.delete(spark, f"{folder}/_SUCCESS")
    bronze_batch(lake, raw(spark, sf_dir, "offset > 300 AND offset <= 320"), 1, "q")
    bronze = read_bronze(spark, lake.bronze_path)
    assert bronze.count() == bronze.select("kafka_offset").distinct().count() == 320
    details = sorted((r["batch_id"], r["row_count"], r["detail"]) for r in lake.batch_metrics.read().collect())
    assert details == [(0, 0, "already written"), (0, 300, ""), (1, 20, ""), (1, 20, "")]


def test_failed_bronze_batch_is_recorded_with_its_rows(lake, spark, sf_dir):
    failing = raw(spark, sf_dir).withColumn("value", F.raise_error(F.lit("boom " * 1000)).cast("binary"))
    with pytest.raises(Exception, match="boom"):
        bronze_batch(lake, failing, 4, "q")
    [row] = lake.batch_metrics.read().collect()
    assert (row["query_name"], row["status"], row["row_count"], len(row["detail"])) == ("kafka_to_bronze", "failed", 300, 1000)
    bronze_batch(lake, raw(spark, sf_dir), 4, "q")
    assert read_bronze(spark, lake.bronze_path).count() == 300


PROGRESS = {
    "timestamp": "2024-01-31T00:00:00.500Z", "batchId": 3,
    "sources": [
        {"endOffset": {"t": {"0": 4, "1": 7}}, "latestOffset": '{"t": {"0": 10, "1": 7, "2": 5}}'},
        {"endOffset": {"logOffset": 3}, "latestOffset": None},
    ],
}


def test_topic_offsets_are_recorded(lake, rows):
    assert topic_offsets(PROGRESS) == [("t", 0, 10, 4), ("t", 1, 7, 7), ("t", 2, 5, None)]
    assert topic_offsets({"sources": []}) == []
    listener = OffsetListener(lake.spark, lake.topic_offsets, "kafka_to_bronze")
    listener.record(PROGRESS)
    listener.record({**PROGRESS, "sources": PROGRESS["sources"][1:]})  # no topic: nothing to record
    found = lake.topic_offsets.read()
    assert rows(found, "query_name", "batch_id", "topic", "partition", "end_offset", "committed_offset") == [
        ("kafka_to_bronze", 3, "t", 0, 10, 4), ("kafka_to_bronze", 3, "t", 1, 7, 7), ("kafka_to_bronze", 3, "t", 2, 5, None),
    ]
    assert found.first()["metric_ts"] == datetime(2024, 1, 31, 0, 0, 0, 500000)


def test_listener_leaves_with_its_run(lake, spark, sf_dir):
    seen = []

    class Listening(OffsetListener):
        def record(self, progress):
            seen.append(progress["batchId"])

    listener = Listening(spark, lake.topic_offsets, "kafka_to_bronze")
    spark.streams.addListener(listener)
    path = feed(lake, sf_dir, SMALL)
    start(lake, path)
    assert wait_for(lambda: seen == [0])
    publish(message_feed(spark, sf_dir).where("offset > 300 AND offset < 310"), "parquet", {"path": path})
    start(lake, path)  # another run of the same name
    time.sleep(1)
    assert seen == [0]


def test_silver_stream_restarts_from_its_checkpoint(lake, spark, sf_dir):
    for where in ("offset <= 100", "offset > 50 AND offset <= 300"):
        write_bronze(bronze_rows(spark, sf_dir, where).coalesce(2), lake.bronze_path, where.split()[-1])
        start_silver(lake, bronze_stream(spark, lake.bronze_path, 1), ONCE).awaitTermination()
    silver = lake.silver.read()
    assert silver.count() == silver.select("event_id").distinct().count() == 300
    recorded = [s for s in statuses(lake) if s[0] == "bronze_to_silver"]
    assert len({s[1] for s in recorded}) == len(recorded) and {s[3] for s in recorded} == {"success"}


def test_fresh_checkpoint_is_not_taken_for_a_replay(lake, spark, sf_dir):
    bronze_rows(spark, sf_dir, "offset <= 10").write.parquet(lake.bronze_path + "-a")
    bronze_rows(spark, sf_dir, "offset > 10 AND offset <= 30").write.parquet(lake.bronze_path + "-b")
    start_silver(lake, bronze_stream(spark, lake.bronze_path + "-a"), ONCE).awaitTermination()
    lake.checkpoint = lambda query: f"{lake.root}/fresh/{query}"
    start_silver(lake, bronze_stream(spark, lake.bronze_path + "-b"), ONCE).awaitTermination()
    assert lake.silver.read().count() == 30


def test_replayed_batch_changes_nothing(lake, spark, sf_dir):
    batch = bronze_rows(spark, sf_dir)
    for _ in range(2):
        silver_batch(lake, batch, 0, "q")
    assert lake.silver.read().count() == 300
    assert {r["batch"] for r in lake.silver.changes().collect()} == {"q-0"}
    assert [r["row_count"] for r in lake.batch_metrics.read().collect()] == [300, 300]


def test_empty_batch_is_recorded_with_no_rows(lake, spark, sf_dir):
    silver_batch(lake, bronze_rows(spark, sf_dir, "false"), 0, "q")
    assert statuses(lake) == {("bronze_to_silver", 0, 0, "success")}
    assert lake.silver.changes().count() == 0


def test_failed_batch_is_recorded_and_raised(lake, spark, sf_dir):
    failing = bronze_rows(spark, sf_dir).withColumn("payload", F.raise_error(F.lit("bad " * 1000)).cast("string"))
    with pytest.raises(Exception, match="bad"):
        silver_batch(lake, failing, 3, "q")
    [row] = lake.batch_metrics.read().collect()
    assert (row["status"], row["row_count"], len(row["detail"])) == ("failed", 300, 1000)
    assert lake.silver.read().count() == 0


def test_failing_metrics_do_not_fail_the_batch(lake, spark, sf_dir):
    class Broken:
        def append(self, rows, writer):
            raise OSError("full")

    class Unmeasured(Lake):
        batch_metrics = batch_rejects = Broken()

    silver_batch(Unmeasured(spark, lake.root), bronze_rows(spark, sf_dir), 0, "q")
    assert lake.silver.read().count() == 300


def test_rejected_rows_are_counted_and_kept(lake, spark, sf_dir, rows):
    payload = F.when(F.col("kafka_offset") <= 20, F.lit("{")).when(F.col("kafka_offset") <= 30, F.lit(None)).otherwise(F.col("payload"))
    batch = bronze_rows(spark, sf_dir).withColumn("payload", payload)
    for _ in range(2):
        silver_batch(lake, batch, 7, "q")
    assert lake.silver.read().count() == 270
    assert rows(lake.batch_rejects.read(), "batch_id", "good", "rejected") == [(7, 270, 30), (7, 270, 30)]
    kept = rejected_rows(lake)
    assert kept.count() == 30 and kept.where("payload = '{'").count() == 20
    assert rows(kept.select("batch").distinct()) == [("q-7",)]
    # Only the dead letters stay in the landing folder.
    assert [n for n in files.child_names(spark, f"{lake.landing_path}/batch=q-7") if n.startswith("status")] == ["status=rejected"]


def test_a_batch_is_parsed_once(lake, spark, sf_dir):
    from adlake.operators.projections import project_landing

    text = project_landing(bronze_rows(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert text.count("from_json") == 1 and "Exchange" not in text.split("from_json")[0]


def test_batch_metric_row(spark):
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    frame = batch_metric(spark, "q", 4, 5, timedelta(seconds=1.5), "failed", "x" * 1500, at)
    assert frame.schema == BATCH_METRIC_SCHEMA
    row = frame.first()
    assert (row["batch_duration_ms"], len(row["detail"]), row["metric_ts"]) == (1500, 1000, datetime(2024, 1, 1))


def test_metrics_since_reads_recent_folders(lake, spark):
    now = datetime(2024, 1, 31, tzinfo=timezone.utc)
    for age in (0, 1, 2):
        row = batch_metric(spark, "q", age, 1, timedelta(), at=now - timedelta(days=age))
        lake.batch_metrics.append(row, writer="q")
    recent = lake.batch_metrics.since(now - timedelta(days=1))
    assert {r["batch_id"] for r in recent.collect()} == {0, 1}
    assert "metric_ts_date" in recent._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]


def test_raw_stream_contract(spark, folder):
    spark.createDataFrame([], RAW_SCHEMA).write.parquet(f"{folder}/feed")
    assert raw_stream(spark, "parquet", {"path": f"{folder}/feed"}).schema.names == RAW_SCHEMA.names
    with pytest.raises(AnalysisException, match="kafka"):
        raw_stream(spark, "kafka", {"kafka.bootstrap.servers": "localhost:9092", "subscribe": "t"})


def test_bronze_as_sql_table(lake, spark, sf_dir):
    write_bronze(bronze_rows(spark, sf_dir), lake.bronze_path, "a")
    register_bronze(spark, lake.bronze_path, "bronze_sql")
    assert spark.sql("SELECT count(*) AS n FROM bronze_sql WHERE ingest_hour >= '00' AND batch = 'a'").first()["n"] == 300
    assert set(spark.table("bronze_sql").schema.names) == {*BRONZE_SCHEMA.names, "batch"}


def test_tables_by_name_are_current(lake, spark, sf_dir):
    silver_batch(lake, bronze_rows(spark, sf_dir), 0, "q")
    assert spark.sql("SELECT count(*) AS n FROM ad_silver.events WHERE click = 1").first()["n"] > 0
    assert spark.sql("SELECT count(*) AS n FROM ad_silver.events").first()["n"] == 300
    assert spark.sql("SELECT count(*) AS n FROM ad_ops.streaming_batch_metrics").first()["n"] == 1
    silver_batch(lake, bronze_rows(spark, sf_dir, "offset > 300 AND offset <= 310"), 1, "q")
    assert spark.sql("SELECT count(*) AS n FROM ad_silver.events").first()["n"] == 310
    assert {r["tableName"] for r in spark.sql("SHOW TABLES IN ad_ops").collect()} >= {
        "streaming_batch_metrics", "health_check_results", "streaming_topic_offsets", "streaming_batch_rejects", "gold_rebuilds",
    }


def test_bootstrap_twice_keeps_data(lake, spark, sf_dir):
    silver_batch(lake, bronze_rows(spark, sf_dir), 0, "q")
    again = bootstrap(spark, lake.root)
    assert spark.table("ad_silver.events").count() == 300
    assert again.silver.read().count() == 300
    assert {"ad_silver", "ad_gold", "ad_ops"} <= {r["namespace"] for r in spark.sql("SHOW NAMESPACES").collect()}
    for table in again.upsert_tables().values():
        assert table.read().schema.names == table.schema.names
