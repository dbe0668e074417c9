from datetime import datetime, timedelta

import pytest

from adlake.plans.scaling import consumer_lag, decide, max_duration, recorded_lag
from adlake.schemas import TOPIC_OFFSET_SCHEMA

AS_OF = datetime(2024, 1, 31)
OFFSETS = "topic string, partition int, end_offset bigint, committed_offset bigint"


def test_lag(spark):
    frame = spark.createDataFrame([("t", 0, 10, 4), ("t", 1, 7, None), ("t", 2, 3, 5)], OFFSETS)
    assert consumer_lag(frame).first()["lag"] == 13
    assert consumer_lag(frame.where("false")).first()["lag"] is None  # unknown


def test_recorded_lag_takes_the_newest_report(spark, rows):
    def report(minutes, query, batch, partition, end, read):
        return (AS_OF - timedelta(minutes=minutes), query, batch, "t", partition, end, read)

    frame = spark.createDataFrame(
        [
            report(10, "a", 1, 0, 100, 0), report(5, "a", 2, 0, 110, 105), report(5, "a", 3, 0, 111, 105), report(5, "a", 2, 1, 7, None),
            report(16, "b", 1, 0, 99, 0), report(15, "c", 1, 0, 5, 9),
        ],
        TOPIC_OFFSET_SCHEMA,
    )
    assert rows(recorded_lag(frame, AS_OF)) == [("a", 13), ("c", 0)]


@pytest.mark.parametrize("duration, expected", [(0, (4, "unknown_lag")), (50000, (4, "unknown_lag")), (120000, (6, "scale_up"))])
def test_unknown_lag_never_scales_down(spark, duration, expected):
    apps = spark.createDataFrame([("a", 4, None, duration)], "app string, current_max int, lag bigint, duration_ms bigint")
    row = decide(apps).first()
    assert (row["target_max_executors"], row["reason"]) == expected


def test_duration(spark):
    rows = [
        (AS_OF - timedelta(minutes=15), "kafka_to_bronze", 5),
        (AS_OF, "other", 99),
        (AS_OF - timedelta(minutes=16), "bronze_to_silver", 77),
    ]
    frame = spark.createDataFrame(rows, "metric_ts timestamp, query_name string, batch_duration_ms bigint")
    assert max_duration(frame, AS_OF).first()["duration_ms"] == 5
    assert max_duration(frame.where("false"), AS_OF).first()["duration_ms"] == 0


@pytest.mark.parametrize(
    "current, lag, duration, expected",
    [
        (4, 200000, 0, (6, "scale_up")),
        (4, 199999, 30001, (4, "hold")),
        (4, 0, 120000, (6, "scale_up")),
        (4, 20000, 30000, (3, "scale_down")),
        (4, 20001, 0, (4, "hold")),
        (12, 200000, 0, (12, "scale_up")),
        (11, 200000, 0, (12, "scale_up")),
        (1, 0, 0, (1, "scale_down")),
        (0, 200000, 0, (2, "scale_up")),
    ],
)
def test_decision(spark, current, lag, duration, expected):
    apps = spark.createDataFrame([("a", current)], "app string, current_max int")
    row = decide(apps, lag, duration).first()
    assert (row["target_max_executors"], row["reason"]) == expected
    assert (row["lag"], row["duration_ms"]) == (lag, duration)


def test_limits_and_frames(spark):
    apps = spark.createDataFrame([("a", 5), ("b", 1)], "app string, current_max int")
    lag = spark.createDataFrame([(50,)], "lag bigint")
    got = decide(apps, lag, 0, scale_up_lag=50, hard_max=6, min_executors=3).collect()
    assert {(r["app"], r["target_max_executors"]) for r in got} == {("a", 6), ("b", 4)}
