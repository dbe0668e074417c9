"""Message feed: broker or files behind one column contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.schemas import RAW_SCHEMA


def raw_stream(spark: SparkSession, fmt: str = "kafka", options: dict[str, str] | None = None) -> DataFrame:
    """A stream with the columns of ``RAW_SCHEMA``.

    ``kafka`` starts at the earliest offset, goes on after data loss and reads
    at most ``maxOffsetsPerTrigger`` messages a trigger; options override. Any
    other format is a file stream over ``options["path"]``.
    """
    options = dict(options or {})
    if fmt == "kafka":
        defaults = {
            "startingOffsets": "earliest",
            "failOnDataLoss": "false",
            "maxOffsetsPerTrigger": "50000",
        }
        stream = spark.readStream.format("kafka").options(**{**defaults, **options}).load()
    else:
        stream = spark.readStream.format(fmt).schema(RAW_SCHEMA).options(**options).load()
    return stream.select(*RAW_SCHEMA.names)


def publish(messages: DataFrame, fmt: str, options: dict[str, str]) -> None:
    """Writes ``(key, value)`` messages to a broker, or appends a feed of files."""
    messages.write.format(fmt).mode("append").options(**options).save()


def as_feed(messages: DataFrame, topic: str, partitions: int, offset: str, timestamp) -> DataFrame:
    """Messages with the position a broker would give them: partition by key
    hash, offset from a column of ``messages``."""
    return messages.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int").alias("partition"),
        F.col(offset).cast("bigint").alias("offset"),
        timestamp.cast("timestamp").alias("timestamp"),
    )
