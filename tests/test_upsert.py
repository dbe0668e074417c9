import random
from datetime import datetime

import pytest
from pyspark.errors import UnsupportedOperationException
from pyspark.sql import functions as F

from adlake.operators.dedup import duplicate_keys, latest_copy, latest_per_key
from adlake.operators.upsert import merge_frames, merge_into


def frame(spark, rows):
    return spark.createDataFrame(rows, "k bigint, day string, v bigint")


BASE = [(1, "a", 10), (2, "a", 20), (3, "b", 30)]


def test_updates_inserts_and_moves(spark, rows):
    merged = merge_frames(frame(spark, BASE), frame(spark, [(2, "b", 21), (4, "a", 40)]), "k")
    assert rows(merged) == [(1, "a", 10), (2, "b", 21), (3, "b", 30), (4, "a", 40)]


def test_empty_sides(spark, rows):
    empty = frame(spark, [])
    assert rows(merge_frames(empty, frame(spark, BASE), "k")) == BASE
    assert rows(merge_frames(frame(spark, BASE), empty, "k")) == BASE


def test_null_keys_never_match(spark, rows):
    merged = merge_frames(frame(spark, [(None, "a", 1)]), frame(spark, [(None, "b", 2)]), "k")
    assert len(rows(merged)) == 2


@pytest.mark.parametrize("seed", range(3))
def test_against_a_dict(spark, rows, seed):
    random.seed(seed)
    expected, current = {}, frame(spark, [])
    for _ in range(3):
        batch = {(random.randrange(6), random.choice("ab")): random.randrange(99) for _ in range(8)}
        source = frame(spark, [(k, d, v) for (k, d), v in batch.items()])
        current = merge_frames(current, source, ["k", "day"])
        expected |= batch
    assert rows(current) == sorted([(k, d, v) for (k, d), v in expected.items()], key=lambda r: tuple((True, str(v)) for v in r))


def test_twice_is_once_and_disjoint_sources_commute(spark, rows):
    target, one, two = frame(spark, BASE), frame(spark, [(1, "c", 1)]), frame(spark, [(9, "c", 2)])
    once = merge_frames(target, one, "k")
    assert rows(merge_frames(once, one, "k")) == rows(once)
    assert rows(merge_frames(once, two, "k")) == rows(merge_frames(merge_frames(target, two, "k"), one, "k"))


def test_merge_into_needs_a_row_level_format(spark):
    spark.sql("CREATE TABLE IF NOT EXISTS plain_target (k BIGINT, day STRING, v BIGINT) USING parquet")
    with pytest.raises(UnsupportedOperationException, match="TABLE_OPERATION"):
        merge_into(frame(spark, BASE), "plain_target", "k")


def test_latest_copy_and_ties(spark, rows):
    at = datetime(2024, 1, 1)
    copies = spark.createDataFrame(
        [("e", at, 0, 1, 1), ("e", at, 0, 3, 2), ("e", at, 1, 2, 3), ("f", None, 0, 9, 4), ("f", at, 0, 0, 5)],
        "event_id string, kafka_timestamp timestamp, kafka_partition bigint, kafka_offset bigint, v bigint",
    )
    assert rows(latest_copy(copies), "event_id", "v") == [("e", 3), ("f", 5)]


def test_latest_per_key_orders(spark, rows):
    data = frame(spark, [(1, "a", 5), (1, "b", 5), (1, "c", None), (2, "a", None)])
    assert rows(latest_per_key(data, "k", ["v", "day"]), "k", "day") == [(1, "b"), (2, "a")]
    assert rows(latest_per_key(data, "k", F.col("v").asc_nulls_last()), "k", "v") == [(1, 5), (2, None)]


def test_duplicate_keys(spark, rows):
    data = frame(spark, [(1, "a", 1), (1, "b", 1), (2, "a", 1)])
    assert rows(duplicate_keys(data, "k")) == [(1, 2)]
    assert rows(duplicate_keys(data, ["k", "day"])) == []


def test_a_key_with_a_third_of_all_rows(spark):
    rows = spark.range(0, 30000, 1, 8).selectExpr(
        "IF(id % 3 = 0, 0, id) AS k", "CAST(id AS STRING) AS day", "id AS v"
    )
    got = latest_per_key(rows, "k", "v")
    assert got.count() == 20001
    assert got.where("k = 0").first()["v"] == 29997
    assert duplicate_keys(rows, "k").first()["rows"] == 10000
