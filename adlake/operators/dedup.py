"""One row per key.

``row_number() <= 1`` lets Catalyst put a window group limit in front of the
shuffle: each task forwards at most one row per key, so a key with a third of
all rows reaches its reducer as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MESSAGE_POSITION = ["kafka_timestamp", "kafka_partition", "kafka_offset"]


def latest_per_key(
    df: DataFrame, key: str | list[str], order: str | Column | list[str | Column]
) -> DataFrame:
    """The row with the highest ``order`` per key. Columns given by name sort
    descending, nulls last; a ``Column`` is used as it is."""
    keys = [key] if isinstance(key, str) else list(key)
    order = list(order) if isinstance(order, (list, tuple)) else [order]
    ranking = [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in order]
    window = Window.partitionBy(*keys).orderBy(*ranking)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def latest_copy(df: DataFrame, key: str = "event_id", position: list[str] | None = None) -> DataFrame:
    """One copy per event: the one at the highest message position."""
    return latest_per_key(df, key, position or MESSAGE_POSITION)


def duplicate_keys(df: DataFrame, key: str | list[str]) -> DataFrame:
    """Keys held by more than one row, with their row count."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where("rows > 1")
