"""Row-wise projections from source log to messages, Bronze and Silver."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from adlake.functions.exprs import ISO_MICROS, as_date, identity_hash, narrow_int
from adlake.operators.dedup import latest_copy
from adlake.operators.filters import event_date_between
from adlake.schemas import PAYLOAD_SCHEMA, SILVER_COLUMNS, SOURCE_COLUMNS, SOURCE_SCHEMA

GOOD, REJECTED = "good", "rejected"

# Silver columns kept as INT; wider source values become NULL.
NARROWED = ["conversion", "attribution", "click", "click_pos", "click_nb"]


def coerce(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed rows whose every field is a number, and the other rows as text
    (``source_row``) with a ``reject_reason`` naming the unreadable columns."""
    # A cast takes ``1.5d`` and ``1f`` for numbers; a log has no such suffix.
    casts = {f.name: F.when(~F.col(f.name).rlike(r"[0-9.]\s*[dDfF]\s*$"), F.col(f.name).try_cast(f.dataType)) for f in SOURCE_SCHEMA}
    readable = reduce(and_, [cast.isNotNull() for cast in casts.values()])
    kept = [c for c in df.columns if c not in casts]
    good = df.where(readable).select(*kept, *[cast.alias(name) for name, cast in casts.items()])
    unreadable = F.concat_ws(", ", *[F.when(cast.isNull(), name) for name, cast in casts.items()])
    rejected = df.where(~readable).select(
        *kept,
        F.concat_ws("\t", *SOURCE_COLUMNS).alias("source_row"),
        F.concat(F.lit("not a number: "), unreadable).alias("reject_reason"),
    )
    return good, rejected


def rebase_time(df: DataFrame, base_epoch: float) -> DataFrame:
    """``event_time`` = ``base_epoch`` + ``timestamp`` seconds; the offset stays
    as ``source_timestamp``. Whole microseconds throughout, so it is exact; an
    offset beyond the clock's range gives NULL."""
    base_micros = F.lit(round(base_epoch * 1_000_000)).cast("bigint")
    micros = F.try_add(base_micros, F.try_multiply(F.col("timestamp"), F.lit(1_000_000).cast("bigint")))
    return df.withColumns({"source_timestamp": F.col("timestamp"), "event_time": F.timestamp_micros(micros)})


def event_identity() -> Column:
    return identity_hash("line_number", "timestamp", "uid", "campaign", "conversion_id", "click_pos")


def with_event_id(df: DataFrame) -> DataFrame:
    """Deterministic id over a row's line number and identifying fields."""
    return df.withColumn("event_id", event_identity())


def to_events(rows: DataFrame, base_epoch: float, ingest_ts: Column | None = None) -> DataFrame:
    """Typed source rows as event payload rows."""
    stamped = with_event_id(rebase_time(rows, base_epoch))
    return stamped.withColumn(
        "producer_ingest_ts", F.current_timestamp() if ingest_ts is None else ingest_ts
    )


def to_raw_messages(events: DataFrame, *carried: str) -> DataFrame:
    """``(key, value)``: the event id and the row as compact JSON, times with
    microseconds and offset. ``carried`` columns follow."""
    fields = ["timestamp", *PAYLOAD_SCHEMA.names]
    payload = F.to_json(F.struct(*fields), {"timestampFormat": ISO_MICROS, "ignoreNullFields": "false"})
    return events.select(F.col("event_id").alias("key"), payload.alias("value"), *carried)


def project_bronze(raw: DataFrame) -> DataFrame:
    """Raw messages as Bronze rows: text payload, its hash, one ingest stamp."""
    now = F.current_timestamp()
    return raw.select(
        "topic",
        F.col("partition").cast("bigint").alias("kafka_partition"),
        F.col("offset").cast("bigint").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("key").cast("string").alias("kafka_key"),
        F.col("value").cast("string").alias("payload"),
        F.sha2(F.col("value").cast("string"), 256).alias("payload_hash"),
        now.alias("bronze_ingest_ts"),
        F.date_format(now, "yyyy-MM-dd").alias("ingest_date"),
        F.date_format(now, "HH").alias("ingest_hour"),
    )


def parse_payload(bronze: DataFrame) -> DataFrame:
    """Adds ``event``; an unreadable field is NULL and the others survive.

    Exploding a one-element array keeps the parsed row apart from the filters
    and projections above it, which Catalyst would otherwise rewrite to parse
    the text once per use.
    """
    event = F.explode(F.array(F.from_json("payload", PAYLOAD_SCHEMA)))
    return bronze.select("*", event.alias("event"))


def is_identified() -> Column:
    return F.col("event.event_id").isNotNull() & F.col("event.event_time").isNotNull()


def drop_unidentified(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with an event id and time, and the rest (malformed JSON among them)."""
    return parsed.where(is_identified()), parsed.where(~is_identified())


def silver_columns() -> list[Column]:
    """The Silver columns of a parsed payload, in table order."""
    derived = {
        "event_date": F.to_date("event.event_time"),
        "event_hour": F.hour("event.event_time"),
        "user_id": F.col("event.uid"),
        "campaign_id": F.col("event.campaign"),
        **{name: narrow_int(f"event.{name}") for name in NARROWED},
        "silver_ingest_ts": F.current_timestamp(),
        "kafka_topic": F.col("topic"),
        **{name: F.col(name) for name in ("bronze_ingest_ts", "kafka_partition", "kafka_offset", "payload_hash")},
    }
    return [derived.get(name, F.col(f"event.{name}")).alias(name) for name in SILVER_COLUMNS]


def select_silver(parsed: DataFrame, *carried: str) -> DataFrame:
    """The Silver columns, in table order, of identified payloads, followed by
    ``carried`` message columns."""
    return parsed.where(is_identified()).select(*silver_columns(), *carried)


def project_landing(bronze: DataFrame, start: date | str | None = None, end: date | str | None = None) -> DataFrame:
    """Every Bronze row, parsed once: Silver columns, ``status`` (``good`` or
    ``rejected``: no event id or time), the message time, and the payload of a
    rejected row. With dates, good rows outside them are left out."""
    status = F.when(is_identified(), GOOD).otherwise(REJECTED)
    kept = F.when(~is_identified(), F.col("payload"))
    rows = parse_payload(bronze).select(*silver_columns(), "kafka_timestamp", kept.alias("payload"), status.alias("status"))
    if start is None:
        return rows
    first, last = as_date(start), as_date(end if end is not None else start)
    return rows.where((F.col("status") == REJECTED) | F.col("event_date").between(F.lit(first), F.lit(last)))


def newest_events(rows: DataFrame) -> DataFrame:
    """One Silver row per event id: the copy at the highest message position."""
    return latest_copy(rows).select(*SILVER_COLUMNS)


def project_silver(bronze: DataFrame) -> DataFrame:
    """Bronze rows as Silver rows, copies included."""
    return select_silver(parse_payload(bronze))


def silver_candidates(
    bronze: DataFrame, start: date | str | None = None, end: date | str | None = None
) -> DataFrame:
    """Silver rows, one per event id: the copy at the highest message position
    among those within the (optional, inclusive) event dates.

    Ranked after parsing, because parsed columns are narrower in the shuffle
    than the payload text.
    """
    rows = select_silver(parse_payload(bronze), "kafka_timestamp")
    if start is not None:
        rows = event_date_between(rows, start, end if end is not None else start)
    return newest_events(rows)


def tag_run(df: DataFrame, name: str | Column, as_of: datetime) -> DataFrame:
    """Stamps result rows with their run time and check name."""
    return df.withColumns(
        {"run_ts": F.lit(as_of).cast(TimestampType()), "query_file": F.lit(name) if isinstance(name, str) else name}
    )
