"""What a task or a batch holds must not grow with the whole input."""

import os

import pytest
from pyspark.sql import functions as F

from adlake import queries
from adlake.operators.key_filter import cannot_hold, key_filter
from adlake.operators.projections import project_bronze
from adlake.plans import landing
from adlake.sources.bronze import read_bronze
from adlake.streaming.queries import silver_batch
from adlake.tables.lake import bootstrap
from test_upsert_table import content, day, folders, plan, put, rows_of, table  # noqa: F401


@pytest.fixture
def events(spark, folder):
    """A tables' folder with 900 events over three days."""
    rows = spark.range(900).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-03 00:00:00' + make_interval(0, 0, 0, int(id % 3), int(id % 24), 0, 0) AS ts", "id % 50 AS user_id",
        "element_at(array('click', 'purchase', 'view'), int(id % 3) + 1) AS event_type", "double(id) AS value", """concat('{"k":', id % 40, '}') AS props""",
    )
    rows.write.parquet(f"{folder}/events.parquet")
    return folder


def test_a_long_feed_has_more_tasks(spark, events, monkeypatch):
    monkeypatch.setattr(queries, "FEED_ROWS", 100, raising=False)
    path = queries.bronze_folder(spark, events, f"{events}/bronze", copies=True)
    bronze = read_bronze(spark, path)
    files = bronze.where(F.col("kafka_offset") < queries.COPY_SHIFT).groupBy(F.input_file_name()).count().collect()
    assert len(files) == 9 and max(r["count"] for r in files) < 150  # six files of 150 rows before
    assert bronze.count() == bronze.select("kafka_offset").distinct().count() == 990


def test_a_batch_of_new_keys_rewrites_nothing(table, monkeypatch):
    put(table, {"a": (0, 1), "b": (1, 2)})
    before = folders(table)
    assert put(table, {"c": (0, 3), "d": (2, 4)}, "q").dates == {day(0), day(2)}
    after = folders(table)
    assert set(before[day(0)]) < set(after[day(0)]) and after[day(1)] == before[day(1)]
    # It may have left rows when it comes again, so then the dates are rewritten.
    put(table, {"c": (0, 3), "d": (2, 4)}, "q")
    assert not set(after[day(0)]) & set(folders(table)[day(0)])
    assert content(table.read()) == {"a": (0, 1), "b": (1, 2), "c": (0, 3), "d": (2, 4)}


def test_an_append_that_died_is_made_whole(table, monkeypatch):
    put(table, {"a": (0, 1)})
    whole = table._append

    def dies(rows):
        whole(rows.where("event_id = 'c'"))
        raise OSError("lost")

    monkeypatch.setattr(table, "_append", dies)
    with pytest.raises(OSError):
        put(table, {"b": (0, 2), "c": (0, 3)}, "q")
    monkeypatch.undo()
    put(table, {"b": (0, 2), "c": (0, 3)}, "q")
    assert content(table.read()) == {"a": (0, 1), "b": (0, 2), "c": (0, 3)}


def test_rows_whose_keys_are_not_in_the_batch_are_not_joined(table):
    put(table, {f"k{n}": (n % 3, n) for n in range(300)})
    batch = rows_of(table, {"k3": (0, -1), "new": (1, -2)})
    filters = table.batch_filter(batch, 2)
    merged = table.merged({day(n) for n in range(3)}, batch, 2, filters)
    assert content(merged) == {f"k{n}": (n % 3, n) for n in range(300)} | {"k3": (0, -1), "new": (1, -2)}
    assert "LeftAnti" not in plan(merged) and cannot_hold(table.read(), ["event_id"], filters, 1).count() > 280


def test_the_librarys_tables_have_one_codec(spark, folder, events, monkeypatch):
    before = spark.conf.get("spark.sql.parquet.compression.codec")
    spark.conf.set("spark.sql.parquet.compression.codec", "snappy")
    try:
        path = queries.bronze_folder(spark, events, f"{folder}/b")
    finally:
        spark.conf.set("spark.sql.parquet.compression.codec", before)
    assert all(name.endswith(".zstd.parquet") for _, _, names in os.walk(path) for name in names if name.startswith("part-"))


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_only_events_with_copies_are_ranked(spark, folder, events, monkeypatch, most):
    ranked, rank = [], landing.newest_events
    monkeypatch.setattr(landing, "newest_events", lambda rows: ranked.append(rows.count()) or rank(rows))
    monkeypatch.setattr(landing, "MOST_REPEATED", most, raising=False)
    lake = bootstrap(spark, f"{folder}/lake", named=False)
    bronze = project_bronze(queries.message_feed(spark, events, copies=True))
    silver_batch(lake, bronze, 0, "q")
    assert ranked == [180 if most else 990]  # all 990 before
    silver = lake.silver.read()
    assert silver.count() == silver.select("event_id").distinct().count() == 900
    assert silver.where(F.col("kafka_offset") >= queries.COPY_SHIFT).count() == 90
    # Without copies nothing is ranked, in a new batch or one that replaces rows.
    silver_batch(lake, bronze.where(F.col("kafka_offset") <= 100), 1, "q")
    assert len(ranked) == 1 and lake.silver.read().where(F.col("kafka_offset") >= queries.COPY_SHIFT).count() == 80
    recorded = {(r["batch_id"], r["row_count"]) for r in lake.batch_metrics.read().collect()}
    assert recorded == {(0, 900), (1, 100)} and lake.silver.read().count() == 900
    assert spark.sparkContext._jsc.getPersistentRDDs().isEmpty()


def test_a_task_makes_bitmaps_of_its_own_buckets(spark):
    text = plan(key_filter(spark.range(100_000).toDF("a"), ["a"], 50))
    assert "partial_bitmap_construct_agg" in text.lower().split("exchange")[0]
