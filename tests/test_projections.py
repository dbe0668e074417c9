import hashlib
import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from adlake.operators.projections import (
    drop_unidentified,
    parse_payload,
    project_bronze,
    project_silver,
    rebase_time,
    silver_candidates,
    tag_run,
    to_events,
    to_raw_messages,
    with_event_id,
)
from adlake.schemas import BRONZE_SCHEMA, PAYLOAD_SCHEMA, SILVER_COLUMNS, SILVER_SCHEMA, SOURCE_SCHEMA

UTC = timezone.utc


def payload(event_id="e", event_time="2024-01-01T10:00:00+00:00", **fields):
    body = {"event_id": event_id, "event_time": event_time, **fields}
    return json.dumps({k: v for k, v in body.items() if v is not ...})


def bronze(spark, *payloads, offsets=None):
    offsets = offsets or range(len(payloads))
    day = datetime(2024, 1, 2, 7)
    rows = [("t", 0, o, day, None, p, "h", day, "2024-01-02", "07") for o, p in zip(offsets, payloads)]
    return spark.createDataFrame(rows, BRONZE_SCHEMA)


def source(spark, *dicts):
    names = SOURCE_SCHEMA.names
    rows = [tuple(float(d.get(n, 1)) if n in ("cost", "cpo") else d.get(n, 1) for n in names) for d in dicts]
    frame = spark.createDataFrame(rows, SOURCE_SCHEMA)
    return frame.withColumn("line_number", F.monotonically_increasing_id() * 0 + 1)


def test_event_id_is_the_hash_of_the_identity(spark):
    frame = source(spark, {"timestamp": 5, "uid": 7, "campaign": 9, "conversion_id": -1, "click_pos": -1})
    expected = hashlib.sha256(b"1|5|7|9|-1|-1").hexdigest()
    assert with_event_id(frame).first()["event_id"] == expected
    other_line = frame.withColumn("line_number", F.lit(2))
    assert with_event_id(other_line).first()["event_id"] != expected
    missing = frame.withColumn("conversion_id", F.lit(None).cast("bigint"))
    assert with_event_id(missing).first()["event_id"] == hashlib.sha256(b"1|5|7|9|None|-1").hexdigest()


@pytest.mark.parametrize("base", [0.0, 1700000000.0, 1700000000.123456])
def test_rebase(spark, base):
    got = rebase_time(source(spark, {"timestamp": 86399}), base).first()
    assert got["source_timestamp"] == 86399
    assert got["event_time"] == datetime.fromtimestamp(base + 86399, UTC).replace(tzinfo=None)


def test_rebase_beyond_the_clock_is_null(spark):
    assert rebase_time(source(spark, {"timestamp": 2**62}), 1.7e9).first()["event_time"] is None


def test_messages_round_trip_to_silver(spark):
    events = to_events(source(spark, {"timestamp": 3, "cost": 0.1, "uid": -1}), 1700000000.5)
    key, value = to_raw_messages(events).first()
    body = json.loads(value)
    assert key == body["event_id"] and " " not in value
    assert set(body) == {"timestamp", *PAYLOAD_SCHEMA.names}
    assert datetime.fromisoformat(body["event_time"]) == datetime.fromtimestamp(1700000003.5, UTC)
    row = project_silver(bronze(spark, value)).first()
    assert (row["event_id"], row["user_id"], row["cost"], row["source_timestamp"]) == (key, -1, 0.1, 3)
    assert row["event_time"] == datetime(2023, 11, 14, 22, 13, 23, 500000)


def test_null_fields_stay_in_the_message(spark):
    events = to_events(source(spark, {}), 0.0).withColumn("cpo", F.lit(None).cast("double"))
    assert json.loads(to_raw_messages(events).first()["value"])["cpo"] is None


def test_bronze_projection(spark):
    raw = spark.createDataFrame(
        [(bytearray(b"k"), bytearray(b"{}"), "t", 3, 4, datetime(2024, 1, 1))],
        "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp",
    )
    frame = project_bronze(raw)
    assert frame.columns == BRONZE_SCHEMA.names
    assert [f.dataType for f in frame.schema] == [f.dataType for f in BRONZE_SCHEMA]
    row = frame.first()
    assert (row["kafka_partition"], row["kafka_offset"], row["kafka_key"]) == (3, 4, "k")
    assert row["payload_hash"] == hashlib.sha256(b"{}").hexdigest()
    assert row["ingest_hour"] == row["bronze_ingest_ts"].strftime("%H")
    assert row["ingest_date"] == row["bronze_ingest_ts"].strftime("%Y-%m-%d")


def test_unidentified_payloads_are_split_off(spark):
    parsed = parse_payload(
        bronze(spark, "not json", payload(event_id=...), payload(event_time=...), payload(event_time="soon"), payload())
    )
    good, rejected = drop_unidentified(parsed)
    assert (good.count(), rejected.count()) == (1, 4)


def test_bad_field_is_null_and_others_survive(spark):
    row = project_silver(bronze(spark, payload(uid="x", campaign=4, extra=1))).first()
    assert row["user_id"] is None and row["campaign_id"] == 4


def test_silver_columns_and_types(spark):
    frame = project_silver(bronze(spark, payload()))
    assert frame.columns == SILVER_COLUMNS
    assert [f.dataType for f in frame.schema] == [f.dataType for f in SILVER_SCHEMA]


def test_times_are_utc_and_wide_flags_null(spark):
    late = payload(event_time="2024-01-01T23:59:59.999999Z")
    tokyo = payload(event_id="f", event_time="2024-01-02T08:30:00+09:00", click_pos=3_000_000_000, click=1)
    got = {r["event_id"]: r for r in project_silver(bronze(spark, late, tokyo)).collect()}
    assert (str(got["e"]["event_date"]), got["e"]["event_hour"]) == ("2024-01-01", 23)
    assert (str(got["f"]["event_date"]), got["f"]["event_hour"]) == ("2024-01-01", 23)
    assert got["f"]["click_pos"] is None and got["f"]["click"] == 1


def test_candidates_keep_the_highest_offset(spark):
    copies = [payload(cost=c) for c in (1.0, 2.0, 3.0)]
    frame = silver_candidates(bronze(spark, *copies, offsets=[5, 9, 7]))
    assert [(r["cost"], r["kafka_offset"]) for r in frame.collect()] == [(2.0, 9)]


def test_candidates_rank_within_the_date_range(spark):
    """A later copy on a date outside the range does not hide the one inside."""
    inside, outside = payload(cost=1.0), payload(cost=2.0, event_time="2024-01-05T00:00:00Z")
    frame = silver_candidates(bronze(spark, inside, outside), "2024-01-01", "2024-01-02")
    assert [r["cost"] for r in frame.collect()] == [1.0]


def test_unidentified_copy_does_not_win(spark):
    frame = silver_candidates(bronze(spark, payload(cost=1.0), payload(cost=2.0, event_time=...)))
    assert [r["cost"] for r in frame.collect()] == [1.0]


def test_tag_run(spark):
    row = tag_run(spark.range(1), "check", datetime(2024, 1, 31, tzinfo=UTC)).first()
    assert (row["run_ts"], row["query_file"]) == (datetime(2024, 1, 31), "check")


def test_number_suffixes_are_rejected(spark):
    from adlake.operators.projections import coerce
    from adlake.schemas import SOURCE_COLUMNS

    plain = {name: "1" for name in SOURCE_COLUMNS}
    rows = [{**plain, "line_number": n, "cost": cost} for n, cost in enumerate(["1.5", "1.5d", "2F", "inf", "1e3", "3 f"])]
    good, rejected = coerce(spark.createDataFrame(rows))
    assert {row["line_number"] for row in good.collect()} == {0, 3, 4}
    assert {row["line_number"] for row in rejected.collect()} == {1, 2, 5}
