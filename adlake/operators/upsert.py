"""Keyed upserts as DataFrame operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_frames(target: DataFrame, source: DataFrame, keys: str | list[str]) -> DataFrame:
    """``target`` with the rows of ``source`` updated or inserted by key.

    ``source`` holds at most one row per key. Keys compare with ``=``, so a
    null key matches nothing and its row is inserted. The anti-join reads only
    the keys of ``source``, and filters on the result reach both inputs.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    kept = target.join(source.select(*keys), keys, "left_anti").select(*target.columns)
    return kept.unionByName(source.select(*target.columns))


def merge_into(source: DataFrame, table: str, keys: str | list[str]) -> None:
    """The same upsert on a catalog table whose format supports row-level
    operations. Formats without them make Spark raise
    UNSUPPORTED_FEATURE.TABLE_OPERATION."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    condition = F.lit(True)
    for key in keys:
        condition = condition & (F.col(f"{table}.{key}") == F.col(f"source.{key}"))
    (
        source.alias("source")
        .mergeInto(table, condition)
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )
