"""Rebuilding past dates from Bronze."""

from __future__ import annotations

import uuid
from datetime import date

from adlake.functions.exprs import as_date
from adlake.plans.gold import build_gold, days_between
from adlake.plans.landing import upsert_events
from adlake.sources.bronze import read_bronze
from adlake.tables.lake import Lake
from adlake.tables.upsert_table import Change


def backfill_silver(
    lake: Lake,
    start: date | str,
    end: date | str,
    bronze_start: str | None = None,
    bronze_end: str | None = None,
) -> Change:
    """Upserts the events of inclusive event dates, optionally from part of Bronze."""
    bronze = read_bronze(lake.spark, lake.bronze_path, bronze_start, bronze_end)
    change, _ = upsert_events(lake, bronze, f"backfill-{uuid.uuid4().hex}", start, end)
    return change


def backfill_and_rebuild(
    lake: Lake,
    start: date | str,
    end: date | str,
    bronze_start: str | None = None,
    bronze_end: str | None = None,
) -> None:
    """Backfills Silver, then replaces Gold for the same dates and for those
    that Silver's change feed says events were moved away from."""
    change = backfill_silver(lake, start, end, bronze_start, bronze_end)
    dates = set(days_between(as_date(start), as_date(end))) | change.dates
    if dates:
        build_gold(lake, mode="replace", dates=dates)
