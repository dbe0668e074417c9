"""The two streaming queries: raw messages to Bronze, Bronze to Silver."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from adlake.functions.exprs import utc_now
from adlake.operators.projections import GOOD, REJECTED, project_bronze
from adlake.plans.landing import upsert_events
from adlake.sources.bronze import write_bronze
from adlake.streaming.metrics import OffsetListener, batch_metric, batch_rejects, record_safely
from adlake.tables.lake import Lake

log = logging.getLogger(__name__)

BRONZE_QUERY = "kafka_to_bronze"
SILVER_QUERY = "bronze_to_silver"
DEFAULT_TRIGGER = {"processingTime": "30 seconds"}


def _query_id(spark: SparkSession) -> str | None:
    """Id of the streaming query this thread runs a batch of; it lives in the
    query's checkpoint, so a query started afresh has another one."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def _rows_of(batch: DataFrame) -> int:
    """Rows of a batch that failed; 0 where they cannot even be counted."""
    try:
        return batch.count()
    except Exception:
        log.exception("could not count a failed batch")
        return 0


def _measured(lake: Lake, query: str, batch: DataFrame, batch_id: int, work: Callable[[], int | None]) -> None:
    """Runs the work of one batch and records its rows and duration.

    A failed batch is recorded with the rows it would have had, and raised
    again; a failure to record is logged and fails nothing.
    """
    spark, started = lake.spark, utc_now()
    try:
        rows = work()
    except Exception as error:
        text, took = str(error), utc_now() - started
        record_safely(lake.batch_metrics, lambda: batch_metric(spark, query, batch_id, _rows_of(batch), took, "failed", text), query)
        raise
    took = utc_now() - started
    detail = "already written" if rows is None else None
    record_safely(lake.batch_metrics, lambda: batch_metric(spark, query, batch_id, rows or 0, took, detail=detail), query)


def bronze_batch(lake: Lake, batch: DataFrame, batch_id: int, query_id: str | None = None) -> None:
    """Writes one micro-batch of raw messages to the Bronze folder of its number.

    A batch replayed after a crash finds its folder complete and leaves it, or
    writes it anew; either way its messages are there once.
    """
    name = f"{query_id or _query_id(lake.spark) or BRONZE_QUERY}-{batch_id}"
    _measured(lake, BRONZE_QUERY, batch, batch_id, lambda: write_bronze(project_bronze(batch), lake.bronze_path, name))


def silver_batch(lake: Lake, batch: DataFrame, batch_id: int, query_id: str | None = None) -> None:
    """Upserts one micro-batch of Bronze rows and records its good and rejected
    rows. A replayed batch ends in the same rows."""
    name = f"{query_id or _query_id(lake.spark) or SILVER_QUERY}-{batch_id}"

    def work() -> int:
        change, counts = upsert_events(lake, batch, name)
        record_safely(lake.batch_rejects, lambda: batch_rejects(lake.spark, SILVER_QUERY, batch_id, counts[GOOD], counts[REJECTED]), SILVER_QUERY)
        return change.rows

    _measured(lake, SILVER_QUERY, batch, batch_id, work)


def _start(lake: Lake, stream: DataFrame, query: str, batch_work: Callable, trigger: dict | None) -> StreamingQuery:
    return (
        stream.writeStream.queryName(query)
        .foreachBatch(lambda batch, batch_id: batch_work(lake, batch, batch_id))
        .option("checkpointLocation", lake.checkpoint(query))
        .trigger(**(trigger or DEFAULT_TRIGGER))
        .start()
    )


def start_bronze(lake: Lake, stream: DataFrame, trigger: dict | None = None) -> StreamingQuery:
    """Raw messages to Bronze by ingest date and hour, with the topic offsets
    of every batch recorded."""
    lake.spark.streams.addListener(OffsetListener(lake.spark, lake.topic_offsets, BRONZE_QUERY))
    return _start(lake, stream, BRONZE_QUERY, bronze_batch, trigger)


def start_silver(lake: Lake, bronze: DataFrame, trigger: dict | None = None) -> StreamingQuery:
    """Parses, deduplicates and upserts Bronze into Silver, batch by batch."""
    return _start(lake, bronze, SILVER_QUERY, silver_batch, trigger)
