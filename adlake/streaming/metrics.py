"""One metric row per micro-batch."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from adlake.functions.exprs import utc_now
from adlake.functions.local import local_rows
from adlake.schemas import BATCH_METRIC_SCHEMA, BATCH_REJECT_SCHEMA, TOPIC_OFFSET_SCHEMA
from adlake.tables.append_table import AppendTable

log = logging.getLogger(__name__)

DETAIL_LENGTH = 1000


def batch_metric(
    spark: SparkSession,
    query_name: str,
    batch_id: int,
    row_count: int,
    duration: timedelta,
    status: str = "success",
    detail: str | None = None,
    at: datetime | None = None,
) -> DataFrame:
    duration_ms = int(duration.total_seconds() * 1000)
    row = (at or utc_now(), query_name, batch_id, row_count, duration_ms, status, (detail or "")[:DETAIL_LENGTH])
    return local_rows(spark, [row], BATCH_METRIC_SCHEMA)


def batch_rejects(spark: SparkSession, query_name: str, batch_id: int, good: int, rejected: int) -> DataFrame:
    return local_rows(spark, [(utc_now(), query_name, batch_id, good, rejected)], BATCH_REJECT_SCHEMA)


def record_safely(table: AppendTable, make_row: Callable[[], DataFrame], query_name: str) -> None:
    """Appends a metric row; a failure is logged and never reaches the batch."""
    try:
        table.append(make_row(), writer=query_name)
    except Exception:
        log.exception("could not record a metric of %s", query_name)


def topic_offsets(progress: dict) -> list[tuple[str, int, int | None, int | None]]:
    """``(topic, partition, end, read)`` of a query's progress report: where the
    sources' topics end and how far the query has read them. A source that does
    not count by topic and partition gives none."""
    rows: dict[tuple[str, int], list[int | None]] = {}
    for source in progress.get("sources") or []:
        for at, name in enumerate(("latestOffset", "endOffset")):
            value = source.get(name)
            offsets = json.loads(value) if isinstance(value, str) else value
            for topic, partitions in offsets.items() if isinstance(offsets, dict) else ():
                for partition, offset in partitions.items() if isinstance(partitions, dict) else ():
                    rows.setdefault((topic, int(partition)), [None, None])[at] = offset
    return [(topic, partition, *found) for (topic, partition), found in sorted(rows.items())]


def offset_rows(spark: SparkSession, query_name: str, progress: dict) -> DataFrame:
    """A progress report as rows of the topic-offset table."""
    at = datetime.fromisoformat(progress["timestamp"])
    rows = [(at, query_name, progress["batchId"], *found) for found in topic_offsets(progress)]
    return local_rows(spark, rows, TOPIC_OFFSET_SCHEMA)


class OffsetListener(StreamingQueryListener):
    """Records, batch by batch, the topic offsets of one run of a query.

    Add it right before starting the query: it follows the first run of that
    name it sees begin, and leaves when that run ends.
    """

    def __init__(self, spark: SparkSession, table: AppendTable, query_name: str):
        self.spark = spark
        self.table = table
        self.query_name = query_name
        self._run: str | None = None

    def onQueryStarted(self, event) -> None:
        if self._run is None and event.name == self.query_name:
            self._run = str(event.runId)

    def onQueryProgress(self, event) -> None:
        if str(event.progress.runId) == self._run:
            self.record(json.loads(event.progress.json))

    def record(self, progress: dict) -> None:
        if topic_offsets(progress):
            record_safely(self.table, lambda: offset_rows(self.spark, self.query_name, progress).coalesce(1), self.query_name)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self._run:
            self.spark.streams.removeListener(self)
