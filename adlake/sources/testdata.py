"""The driver's ``events`` table seen as ad events, message feed and source log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.functions.exprs import flag_int, identity_hash
from adlake.schemas import SOURCE_SCHEMA

CAMPAIGNS = 20
PARTITIONS = 6
TOPIC = "ad-events"
BASE_EPOCH = 1704067200  # 2024-01-01 00:00:00 UTC, the first second of `events`


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # `events.ts` has no zone; it is read as UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ad_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver-shaped rows, one per ``events`` row; ``seq`` keeps its number."""
    events = read_table(spark, sf_dir, "events")
    purchase = F.col("event_type") == "purchase"
    return events.select(
        F.col("event_id").alias("seq"),
        identity_hash("event_id", "user_id").alias("event_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.to_date("ts").alias("event_date"),
        F.hour("ts").alias("event_hour"),
        "user_id",
        campaign().alias("campaign_id"),
        flag_int(F.col("event_type") == "click").alias("click"),
        flag_int(purchase).alias("conversion"),
        flag_int(purchase & (F.col("user_id") % 2 == 0)).alias("attribution"),
        (F.col("value") / 1000).alias("cost"),
    )


def campaign():
    return F.get_json_object("props", "$.k").cast("bigint") % CAMPAIGNS


def source_rows(spark: SparkSession, sf_dir: str, tasks: int | None = None) -> DataFrame:
    """Typed source-log rows with their line number, one per ``events`` row;
    with ``tasks``, spread over so many by that number."""
    events = read_table(spark, sf_dir, "events")
    if tasks:  # before the rows grow wider
        events = events.repartition(tasks, "event_id")
    events = events.withColumn("timestamp", F.unix_seconds(F.col("ts").cast("timestamp")) - BASE_EPOCH)
    row = F.col("event_id")
    click = F.col("event_type") == "click"
    purchase = F.col("event_type") == "purchase"

    def only(condition, value):
        return F.when(condition, value).otherwise(F.lit(-1)).cast("bigint")

    columns = {
        "timestamp": F.col("timestamp"),
        "uid": F.col("user_id"),
        "campaign": campaign(),
        "conversion": flag_int(purchase),
        "conversion_timestamp": only(purchase, F.col("timestamp") + row % 86400),
        "conversion_id": only(purchase, row),
        "attribution": flag_int(purchase & (F.col("user_id") % 2 == 0)),
        "click": flag_int(click),
        "click_pos": only(click, row % 10),
        "click_nb": only(click, row % 10 + 1),
        "cost": F.col("value") / 1000,
        "cpo": F.col("value") / 100,
        "time_since_last_click": only(click, row % 5000),
        **{f"cat{i}": row * i % 1000 for i in range(1, 10)},
    }
    return events.select(
        (row + 1).alias("line_number"),
        *[columns[field.name].cast(field.dataType).alias(field.name) for field in SOURCE_SCHEMA],
    )


def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A streaming-metric frame with one batch per ``events`` row."""
    return read_table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("metric_ts"),
        F.when(F.col("event_id") % 2 == 0, "kafka_to_bronze").otherwise("bronze_to_silver").alias("query_name"),
        F.col("event_id").alias("batch_id"),
        (F.col("user_id") * 10).alias("row_count"),
        F.floor(F.col("value") * 1000).cast("bigint").alias("batch_duration_ms"),
        F.when(F.col("event_type") == "error", "failed").otherwise("success").alias("status"),
        F.when(F.col("event_type") == "error", F.col("props")).otherwise("").alias("detail"),
    )


def topic_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six partitions of a topic; the last one has no committed offset."""
    events = read_table(spark, sf_dir, "events")
    partition = (F.col("user_id") % PARTITIONS).cast("int")
    return (
        events.groupBy(partition.alias("partition"))
        .agg(F.max("event_id").alias("end_offset"), F.min("event_id").alias("committed_offset"))
        .select(
            F.lit(TOPIC).alias("topic"),
            "partition",
            "end_offset",
            F.when(F.col("partition") != PARTITIONS - 1, F.col("committed_offset")).alias("committed_offset"),
        )
    )


def file_stats_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file listing with one file per ``orders`` row, a quarter of them deltas."""
    return read_table(spark, sf_dir, "orders").select(
        F.concat(
            F.lit("data/commit="), (F.col("o_orderkey") % 50).cast("string"),
            F.lit("/part-"), F.col("o_orderkey").cast("string"),
        ).alias("path"),
        F.floor(F.col("o_totalprice") * 1000).cast("bigint").alias("length"),
        F.col("o_orderdate").cast("timestamp").alias("modificationTime"),
        F.when(F.col("o_orderkey") % 4 == 0, "DELTA").otherwise("DATA").alias("content"),
    )
