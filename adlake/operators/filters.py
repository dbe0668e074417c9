"""Row filters. Bounds are typed literals, so they reach the scan as partition
or pushed filters."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.functions.exprs import as_date, as_utc, utc_now


def resolve_dates(start: date | str | None = None, end: date | str | None = None) -> tuple[date, date]:
    """Inclusive bounds: yesterday (UTC) by default, and one day when ``end`` is absent."""
    first = as_date(start) if start else utc_now().date() - timedelta(days=1)
    return first, as_date(end) if end else first


def event_date_between(df: DataFrame, start: date | str, end: date | str) -> DataFrame:
    return df.where(F.col("event_date").between(F.lit(as_date(start)), F.lit(as_date(end))))


def date_range(df: DataFrame, start: date | str | None = None, end: date | str | None = None) -> DataFrame:
    return event_date_between(df, *resolve_dates(start, end))


def ingest_date_between(bronze: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Bounds on the string partition column, each optional."""
    if start:
        bronze = bronze.where(F.col("ingest_date") >= F.lit(str(start)))
    if end:
        bronze = bronze.where(F.col("ingest_date") <= F.lit(str(end)))
    return bronze


def trailing(df: DataFrame, column: str, interval: timedelta, as_of: datetime | None = None) -> DataFrame:
    """Rows at or after ``as_of - interval``; a date column compares by whole days."""
    bound = as_utc(as_of) - interval
    if df.schema[column].dataType.typeName() == "date":
        bound = as_utc(as_of).date() - interval
    return df.where(F.col(column) >= F.lit(bound))
