"""Executor scaling advice for the streaming jobs."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.operators.dedup import latest_per_key
from adlake.operators.filters import trailing

LAG_WINDOW = timedelta(minutes=15)
STREAMING_QUERIES = ("kafka_to_bronze", "bronze_to_silver")

# Default limits of the scaling rule.
LIMITS = {
    "min_executors": 1,
    "hard_max": 12,
    "scale_up_lag": 200000,
    "scale_down_lag": 20000,
    "scale_up_duration": 120000,
    "scale_down_duration": 30000,
}


def consumer_lag(offsets: DataFrame, *groups: str) -> DataFrame:
    """Messages not yet read, over all partitions, optionally per group; nothing
    committed counts as 0, and no partition at all leaves the lag unknown (NULL)."""
    behind = F.greatest(F.lit(0), F.col("end_offset") - F.coalesce("committed_offset", F.lit(0)))
    lag = F.sum(F.when(F.col("end_offset").isNotNull(), behind)).cast("bigint").alias("lag")
    return offsets.groupBy(*groups).agg(lag) if groups else offsets.agg(lag)


def recorded_lag(offsets: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """``lag`` per streaming query from the newest offsets of each topic partition
    recorded in 15 minutes. A query that recorded none has no row."""
    recent = trailing(offsets, "metric_ts", LAG_WINDOW, as_of)
    newest = latest_per_key(recent, ["query_name", "topic", "partition"], ["metric_ts", "batch_id"])
    return consumer_lag(newest, "query_name")


def max_duration(metrics: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Longest batch of the two streaming queries in 15 minutes, 0 without any."""
    recent = trailing(metrics, "metric_ts", timedelta(minutes=15), as_of)
    return recent.where(F.col("query_name").isin(*STREAMING_QUERIES)).agg(
        F.coalesce(F.max("batch_duration_ms"), F.lit(0)).cast("bigint").alias("duration_ms")
    )


def _with(apps: DataFrame, name: str, source: DataFrame | int | None) -> DataFrame:
    if source is None:
        return apps
    value = source.scalar() if isinstance(source, DataFrame) else F.lit(source).cast("bigint")
    return apps.withColumn(name, value)


def decide(apps: DataFrame, lag: DataFrame | int | None = None, duration: DataFrame | int | None = None, **limits: int) -> DataFrame:
    """Target executor limit per app.

    ``lag`` and ``duration`` are numbers or one-row frames; where they are not
    given, ``apps`` has its own ``lag`` and ``duration_ms``. A NULL lag is
    unknown: a long batch still scales up, nothing scales down.
    """
    rule = {**LIMITS, **limits}
    frame = _with(_with(apps, "lag", lag), "duration_ms", duration)
    long, short = F.col("duration_ms") >= rule["scale_up_duration"], F.col("duration_ms") <= rule["scale_down_duration"]
    up = F.coalesce(F.col("lag") >= rule["scale_up_lag"], F.lit(False)) | long
    down = (F.col("lag") <= rule["scale_down_lag"]) & short
    current, lowest = F.col("current_max"), F.lit(rule["min_executors"])
    raised = F.least(F.lit(rule["hard_max"]), F.greatest(current + 2, lowest + 1))
    target = F.when(up, raised).when(down, F.greatest(lowest, current - 1)).otherwise(current)
    reason = F.when(up, "scale_up").when(F.col("lag").isNull(), "unknown_lag").when(down, "scale_down").otherwise("hold")
    return frame.withColumns({"target_max_executors": target.cast("int"), "reason": reason})
