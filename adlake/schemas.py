"""Declared schemas of every table and stream. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

BINARY, DATE, DOUBLE, INT, LONG, TEXT, TIME = BinaryType(), DateType(), DoubleType(), IntegerType(), LongType(), StringType(), TimestampType()


def some(name: str, kind: DataType) -> StructField:
    return StructField(name, kind, True)


def must(name: str, kind: DataType) -> StructField:
    return StructField(name, kind, False)


# The columns of the tables and messages below, their order and
# their types, are what other readers of the lake rely on.

# The source log's columns in file order.
SOURCE_SCHEMA = StructType(
    [
        some("timestamp", LONG),
        some("uid", LONG),
        some("campaign", LONG),
        some("conversion", LONG),
        some("conversion_timestamp", LONG),
        some("conversion_id", LONG),
        some("attribution", LONG),
        some("click", LONG),
        some("click_pos", LONG),
        some("click_nb", LONG),
        some("cost", DOUBLE),
        some("cpo", DOUBLE),
        some("time_since_last_click", LONG),
        some("cat1", LONG),
        some("cat2", LONG),
        some("cat3", LONG),
        some("cat4", LONG),
        some("cat5", LONG),
        some("cat6", LONG),
        some("cat7", LONG),
        some("cat8", LONG),
        some("cat9", LONG),
    ]
)
SOURCE_COLUMNS = SOURCE_SCHEMA.names

# The JSON payload: identity and times first, then the source columns but
# `timestamp`, which travels as `source_timestamp`.
PAYLOAD_SCHEMA = StructType(
    [
        some("event_id", TEXT),
        some("event_time", TIME),
        some("source_timestamp", LONG),
        *[field for field in SOURCE_SCHEMA.fields if field.name != "timestamp"],
        some("producer_ingest_ts", TIME),
    ]
)

# What the message source delivers, whether broker or files.
RAW_SCHEMA = StructType(
    [
        some("key", BINARY),
        some("value", BINARY),
        some("topic", TEXT),
        some("partition", INT),
        some("offset", LONG),
        some("timestamp", TIME),
    ]
)

BRONZE_SCHEMA = StructType(
    [
        must("topic", TEXT),
        must("kafka_partition", LONG),
        must("kafka_offset", LONG),
        some("kafka_timestamp", TIME),
        some("kafka_key", TEXT),
        must("payload", TEXT),
        must("payload_hash", TEXT),
        must("bronze_ingest_ts", TIME),
        must("ingest_date", TEXT),
        must("ingest_hour", TEXT),
    ]
)

SILVER_SCHEMA = StructType(
    [
        must("event_id", TEXT),
        must("event_time", TIME),
        must("event_date", DATE),
        must("event_hour", INT),
        some("source_timestamp", LONG),
        some("user_id", LONG),
        some("campaign_id", LONG),
        some("conversion", INT),
        some("conversion_timestamp", LONG),
        some("conversion_id", LONG),
        some("attribution", INT),
        some("click", INT),
        some("click_pos", INT),
        some("click_nb", INT),
        some("cost", DOUBLE),
        some("cpo", DOUBLE),
        some("time_since_last_click", LONG),
        some("cat1", LONG),
        some("cat2", LONG),
        some("cat3", LONG),
        some("cat4", LONG),
        some("cat5", LONG),
        some("cat6", LONG),
        some("cat7", LONG),
        some("cat8", LONG),
        some("cat9", LONG),
        some("producer_ingest_ts", TIME),
        some("bronze_ingest_ts", TIME),
        some("silver_ingest_ts", TIME),
        some("kafka_topic", TEXT),
        some("kafka_partition", LONG),
        some("kafka_offset", LONG),
        some("payload_hash", TEXT),
    ]
)
SILVER_COLUMNS = SILVER_SCHEMA.names

HOURLY_SCHEMA = StructType(
    [
        must("event_date", DATE),
        must("event_hour", INT),
        must("campaign_id", LONG),
        some("events", LONG),
        some("clicks", LONG),
        some("conversions", LONG),
        some("attributed_conversions", LONG),
        some("spend", DOUBLE),
        some("avg_event_cost", DOUBLE),
        some("unique_users", LONG),
        some("ctr_proxy", DOUBLE),
        some("conversion_rate", DOUBLE),
        some("cost_per_attributed_conversion", DOUBLE),
        some("gold_updated_at", TIME),
    ]
)

DAILY_SCHEMA = StructType(
    [
        must("event_date", DATE),
        must("campaign_id", LONG),
        some("events", LONG),
        some("clicks", LONG),
        some("conversions", LONG),
        some("attributed_conversions", LONG),
        some("spend", DOUBLE),
        some("unique_users_approx", LONG),
        some("ctr_proxy", DOUBLE),
        some("conversion_rate", DOUBLE),
        some("cost_per_attributed_conversion", DOUBLE),
        some("gold_updated_at", TIME),
    ]
)

BATCH_METRIC_SCHEMA = StructType(
    [
        must("metric_ts", TIME),
        must("query_name", TEXT),
        must("batch_id", LONG),
        some("row_count", LONG),
        some("batch_duration_ms", LONG),
        some("status", TEXT),
        some("detail", TEXT),
    ]
)

HEALTH_SCHEMA = StructType(
    [
        some("metric_name", TEXT),
        some("metric_value", DOUBLE),
        some("severity", TEXT),
        some("details", TEXT),
        some("run_ts", TIME),
        some("query_file", TEXT),
    ]
)

# The tables below are this library's own.

# A parsed batch: Silver's columns, all nullable, and what it came from.
LANDING_SCHEMA = StructType(
    [
        *[some(field.name, field.dataType) for field in SILVER_SCHEMA.fields],
        some("kafka_timestamp", TIME),
        some("payload", TEXT),
        some("status", TEXT),
        some("batch", TEXT),
    ]
)

BATCH_REJECT_SCHEMA = StructType(
    [
        must("metric_ts", TIME),
        must("query_name", TEXT),
        must("batch_id", LONG),
        some("good", LONG),
        some("rejected", LONG),
    ]
)

TOPIC_OFFSET_SCHEMA = StructType(
    [
        must("metric_ts", TIME),
        must("query_name", TEXT),
        must("batch_id", LONG),
        some("topic", TEXT),
        some("partition", INT),
        some("end_offset", LONG),
        some("committed_offset", LONG),
    ]
)

GOLD_REBUILD_SCHEMA = StructType([must("rebuilt_at", TIME), must("batch", TEXT)])

FILE_STATS_SCHEMA = StructType(
    [
        some("path", TEXT),
        some("length", LONG),
        some("modificationTime", TIME),
        some("content", TEXT),
    ]
)
