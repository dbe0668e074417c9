"""Building the Gold tables from Silver."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.functions.exprs import utc_now
from adlake.functions.local import local_rows
from adlake.operators.filters import resolve_dates
from adlake.operators.kpis import daily_kpis, hourly_kpis
from adlake.schemas import DAILY_SCHEMA, GOLD_REBUILD_SCHEMA, HOURLY_SCHEMA
from adlake.tables.lake import Lake
from adlake.tables.upsert_table import Change, UpsertTable


def gold_hourly(silver: DataFrame) -> DataFrame:
    rows = hourly_kpis(silver).withColumn("gold_updated_at", F.current_timestamp())
    return rows.select(*HOURLY_SCHEMA.names)


def gold_daily(hourly: DataFrame) -> DataFrame:
    rows = daily_kpis(hourly).withColumn("gold_updated_at", F.current_timestamp())
    return rows.select(*DAILY_SCHEMA.names)


def publish_hourly(lake: Lake, rows: DataFrame) -> Change:
    """Upserts hourly KPIs by date, hour and campaign, the groups they are made by."""
    return lake.hourly.upsert(rows, unique=True)


def publish_daily(lake: Lake, rows: DataFrame) -> Change:
    """Upserts daily KPIs by date and campaign, the groups they are made by."""
    return lake.daily.upsert(rows, unique=True)


def days_between(first: date, last: date) -> list[date]:
    return [first + timedelta(days=n) for n in range((last - first).days + 1)]


def build_gold(
    lake: Lake,
    start: date | str | None = None,
    end: date | str | None = None,
    mode: str = "merge",
    dates: set[date] | None = None,
) -> None:
    """Hourly KPIs from Silver, then daily KPIs from the stored hourly table.

    ``merge`` upserts: a group whose events have all moved away keeps its old
    row. ``replace`` makes the result the whole content of the dates. ``dates``
    picks single days within the bounds.
    """
    if dates:
        days = sorted(dates)
        first, last = days[0], days[-1]
    else:
        first, last = resolve_dates(start, end)
        days = days_between(first, last)
    if not days:
        return

    def of_days(table: UpsertTable) -> DataFrame:
        return table.read_dates(dates) if dates else table.read(first, last)

    hourly = gold_hourly(of_days(lake.silver))
    if mode == "merge":
        publish_hourly(lake, hourly)
    elif mode == "replace":
        lake.hourly.replace_dates(hourly, set(days))
    else:
        raise ValueError(f"unknown mode {mode!r}")

    daily = gold_daily(of_days(lake.hourly))
    if mode == "merge":
        publish_daily(lake, daily)
    else:
        lake.daily.replace_dates(daily, set(days))


def pending_changes(lake: Lake) -> DataFrame:
    """Rows of Silver's change feed that Gold has not taken in yet."""
    return lake.silver.changes().join(lake.gold_rebuilds.read().select("batch"), "batch", "left_anti")


def rebuild_changed(lake: Lake) -> set[date]:
    """Replaces Gold for every date that Silver's batches since the last call
    added to or took from, and returns these dates.

    Batches are marked as taken in after Gold is written; a run that stops in
    between is simply repeated.
    """
    # One row per batch and pair of dates; batches that wait are few.
    pending = pending_changes(lake).select("batch", "old_date", "new_date").collect()
    dates = {day for row in pending for day in (row["old_date"], row["new_date"]) if day is not None}
    if dates:
        build_gold(lake, mode="replace", dates=dates)
        moment = utc_now()
        done = [(moment, batch) for batch in sorted({row["batch"] for row in pending})]
        lake.gold_rebuilds.append(local_rows(lake.spark, done, GOLD_REBUILD_SCHEMA).coalesce(1))
    return dates
