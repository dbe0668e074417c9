"""Column expressions used across layers. All are built-ins, so they stay in codegen."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def safe_ratio(numerator: str, denominator: str) -> Column:
    """``numerator / denominator`` as a double, NULL when the denominator is zero."""
    return F.col(numerator).cast("double") / F.nullif(F.col(denominator), F.lit(0))


def narrow_int(column: str) -> Column:
    """INT value of a BIGINT column, NULL where it does not fit."""
    return F.col(column).try_cast("int")


def flag_int(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def identity_hash(*columns: str | Column) -> Column:
    """SHA-256 of the values joined by ``|``; a missing value reads ``None``."""
    parts = [F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c, F.lit("None")) for c in columns]
    return F.sha2(F.concat_ws("|", *parts), 256)


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def as_utc(moment: datetime | None) -> datetime:
    """The moment as an aware UTC datetime; now when absent. Naive values are UTC."""
    if moment is None:
        return utc_now()
    if moment.tzinfo is None:
        return moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc)


def timestamp_literal(moment: datetime | None) -> Column:
    return F.lit(as_utc(moment))


def as_date(day: date | str) -> date:
    return date.fromisoformat(day) if isinstance(day, str) else day
