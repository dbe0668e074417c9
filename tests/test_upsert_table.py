import os
import random
import time
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType, StringType, StructField, StructType

from adlake.operators.key_filter import MOST_BUCKETS, buckets_for, key_filter, may_hold
from adlake.tables import files, maintenance
from adlake.tables.maintenance import abandoned_folders, compact_files, expire_changes, maintain, table_files
from adlake.tables.upsert_table import UpsertTable

SCHEMA = StructType(
    [
        StructField("event_id", StringType(), False),
        StructField("event_date", DateType(), False),
        StructField("campaign_id", LongType()),
        StructField("v", LongType()),
    ]
)
DAY = date(2024, 1, 1)
FUTURE = datetime.now(timezone.utc) + timedelta(days=1)


def day(n):
    return DAY + timedelta(days=n)


@pytest.fixture
def table(spark, folder):
    table = UpsertTable(spark, f"{folder}/t", SCHEMA, ["event_id"])
    table.create()
    return table


def rows_of(table, content):
    return table.spark.createDataFrame([(k, day(d), 1, v) for k, (d, v) in content.items()], SCHEMA)


def put(table, content, batch=None):
    """Upserts ``{key: (day number, value)}``."""
    return table.upsert(rows_of(table, content), batch)


def content(frame):
    got = [(r["event_id"], ((r["event_date"] - DAY).days, r["v"])) for r in frame.collect()]
    assert len(got) == len(dict(got)), "a key twice"
    return dict(got)


def folders(table):
    """Each date's data files, to tell which were written again."""
    return {d: [n for n in files.child_names(table.spark, table.date_dir(d)) if n.endswith(".parquet")] for d in table.dates()}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_create_twice_changes_nothing(table):
    assert content(table.read()) == {} and table.dates() == [] and table.changes().count() == 0
    put(table, {"a": (0, 1)})
    assert table.create() is False
    assert content(table.read()) == {"a": (0, 1)}


def test_upsert_latest_wins_and_may_move_dates(table):
    assert put(table, {"a": (0, 1), "b": (0, 2)}).rows == 2
    assert put(table, {"a": (1, 3), "c": (0, 4)}).dates == {day(0), day(1)}
    assert put(table, {"a": (2, 5)}).dates == {day(1), day(2)}
    assert content(table.read()) == {"a": (2, 5), "b": (0, 2), "c": (0, 4)}
    assert content(table.read(start=day(0), end=day(0))) == {"b": (0, 2), "c": (0, 4)}
    assert content(table.read(start=day(1), end=day(1))) == {}
    assert content(table.read(start=day(2))) == {"a": (2, 5)}
    assert content(table.read(end=day(1))) == {"b": (0, 2), "c": (0, 4)}
    assert content(table.read(start=day(2), end=day(1))) == {}
    assert table.dates() == [day(0), day(2)]  # the date all rows left is gone


def test_untouched_dates_are_neither_read_nor_written(table):
    put(table, {f"k{n}": (n, n) for n in range(6)})
    before = folders(table)
    put(table, {"k1": (2, -1), "new": (4, 0)})
    after = folders(table)
    assert set(after) == set(before) - {day(1)}
    assert {d for d in after if after[d] != before[d]} == {day(2), day(4)}
    # Finding the dates reads two columns; the rows read are those of three dates.
    batch = rows_of(table, {"k3": (3, 1)})
    text = plan(table.moves(batch, 1))
    [scan] = [part for part in text.split("FileScan")[1:] if "event_date=" not in part.split("Location")[0] and "ReadSchema" in part]
    assert "struct<event_id:string>" in scan
    assert "InMemoryFileIndex(2 paths)" in plan(table.read_dates({day(2), day(3)}))


def test_rows_pass_the_key_filter_before_a_shuffle(table):
    put(table, {f"k{n}": (n % 5, n) for n in range(400)})
    batch = rows_of(table, {"k3": (3, 1), "other": (1, 1)})
    earlier = table.earlier_rows(batch, 2)
    assert {r["event_id"] for r in earlier.collect()} >= {"k3"} and earlier.count() < 20
    text = plan(earlier)
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "bitmap_construct_agg" in text.lower().replace("bitmapconstructagg", "bitmap_construct_agg")
    # A batch beyond any filter of bounded size is joined without one.
    assert buckets_for(10**10) == 0 and "bitmap" not in plan(table.earlier_rows(batch, 10**10)).lower()


def test_key_filter_misses_no_key_and_few_pass(spark):
    keys = spark.range(20_000).selectExpr("id AS a", "string(id) AS b")
    buckets = buckets_for(20_000)
    asked = spark.range(200_000).selectExpr("id AS a", "string(id) AS b")
    found = may_hold(asked, ["a", "b"], key_filter(keys, ["a", "b"], buckets), buckets).agg(F.count_if(F.col("a") < 20_000), F.count_if(F.col("a") >= 20_000)).first()
    assert found[0] == 20_000 and found[1] < 180_000 * 0.03
    assert buckets_for(0) == 1 and buckets_for(2 * 10**7) == MOST_BUCKETS


def test_a_repeated_batch_ends_in_the_same_rows(table):
    put(table, {"a": (0, 1), "b": (0, 1), "c": (3, 1)})
    for _ in range(3):
        assert put(table, {"a": (1, 2), "n": (2, 2)}, "q-0").rows == 2
        assert content(table.read()) == {"a": (1, 2), "b": (0, 1), "n": (2, 2), "c": (3, 1)}
        assert table.changed_dates("q-0") == {day(0), day(1), day(2)}
    assert table.changes().where("batch = 'q-0'").agg(F.sum("rows")).first()[0] == 2


@pytest.mark.parametrize("written", [[0], [1], [0, 1]])
def test_a_batch_that_died_between_dates_is_made_whole(table, monkeypatch, written):
    """The driver dies after some of the touched dates are in place."""
    put(table, {"a": (0, 1), "b": (0, 2), "c": (1, 3)})
    batch = {"a": (1, 9), "n": (0, 4)}
    whole = table._overwrite

    def dies(rows, days, *args):
        whole(rows.where(F.col("event_date").isin([day(n) for n in written])), {day(n) for n in written})
        raise OSError("lost")

    monkeypatch.setattr(table, "_overwrite", dies)
    with pytest.raises(OSError):
        put(table, batch, "q-1")
    monkeypatch.undo()
    put(table, batch, "q-1")
    assert content(table.read()) == {"a": (1, 9), "b": (0, 2), "c": (1, 3), "n": (0, 4)}
    assert table.changed_dates("q-1") == {day(0), day(1)}


def test_a_driver_that_died_while_replacing_a_date_loses_nothing(table):
    """The date's old folder is gone, its new one still staged."""
    put(table, {"a": (0, 1), "b": (0, 2), "c": (1, 3)})
    put(table, {"a": (0, 9)}, "q-2")
    staged = f"{table.data_path}/.spark-staging-dead"
    files.make_folder(table.spark, staged)
    files.move(table.spark, table.date_dir(day(0)), f"{staged}/event_date=2024-01-01")
    assert content(table.read()) == {"c": (1, 3)}
    put(table, {"a": (0, 9)}, "q-2")
    assert content(table.read()) == {"a": (0, 9), "b": (0, 2), "c": (1, 3)}
    assert table.recover() == [] and not files.exists(table.spark, staged)


def test_change_feed_tells_old_and_new_dates(table):
    put(table, {"a": (0, 1), "b": (0, 2), "c": (1, 3)}, "first")
    put(table, {"a": (2, 1), "b": (0, 5), "n": (1, 6), "m": (1, 6)}, "second")
    pairs = {(r["old_date"], r["new_date"], r["rows"]) for r in table.changes().where("batch = 'second'").collect()}
    assert pairs == {(day(0), day(2), 1), (day(0), day(0), 1), (None, day(1), 2)}
    assert table.changed_dates("first") == {day(0), day(1)}


def test_empty_upsert_leaves_nothing(table):
    assert put(table, {}).rows == 0
    assert table.dates() == [] and table.changes().count() == 0


def test_null_in_a_required_column_fails(table):
    bad = table.spark.createDataFrame([("a", None, 1, 1)], "event_id string, event_date date, campaign_id bigint, v bigint")
    with pytest.raises(Exception, match="event_date must not be NULL"):
        table.upsert(bad)
    assert content(table.read()) == {}


def test_a_repeated_key_is_refused_before_anything_is_written(table, spark):
    twice = spark.createDataFrame([("a", day(0), 1, 1), ("a", day(0), 1, 2)], SCHEMA)
    for _ in range(2):
        with pytest.raises(ValueError, match="repeats a key"):
            table.upsert(twice)
        assert "a" not in content(table.read()) and table.changes().where("batch = 'x'").count() == 0
        put(table, {"b": (0, 1)})


def test_keys_with_the_date_need_no_scan(spark, folder):
    table = UpsertTable(spark, f"{folder}/g", SCHEMA, ["event_date", "event_id"])
    table.create()
    put(table, {"a": (0, 1), "b": (1, 1)})
    assert put(table, {"a": (1, 2)}).dates == {day(1)}
    assert sorted((r["event_id"], r["event_date"]) for r in table.read().collect()) == [("a", day(0)), ("a", day(1)), ("b", day(1))]
    assert "FileScan" not in plan(table.moves(rows_of(table, {"a": (1, 2)}), 1))


def test_compaction_keeps_rows_and_reduces_files(table):
    rows = {f"k{n}": (n % 3, n) for n in range(60)}
    put(table, rows)
    table.rewrite_dates({day(n): 6 for n in range(3)})
    assert table_files(table).count() > 6
    assert compact_files(table, group_bytes=1) == [[day(0)], [day(1)], [day(2)]]
    assert table_files(table).count() == 3
    assert content(table.read()) == rows
    assert compact_files(table) == []


def test_compaction_stopped_half_way_reads_the_same(table, monkeypatch):
    rows = {f"k{n}": (n % 3, n) for n in range(60)}
    put(table, rows)
    table.rewrite_dates({day(n): 6 for n in range(3)})
    write, calls = table.rewrite_dates, []

    def second_fails(group):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return write(group)

    monkeypatch.setattr(table, "rewrite_dates", second_fails)
    with pytest.raises(RuntimeError):
        compact_files(table, group_bytes=1)
    assert content(table.read()) == rows


def test_replace_dates(table, spark):
    put(table, {"a": (0, 1), "b": (1, 1), "c": (1, 2), "e": (3, 1)})
    fresh = spark.createDataFrame([("d", day(1), 1, 9)], SCHEMA)
    table.replace_dates(fresh, {day(1), day(2), day(3)})
    assert content(table.read()) == {"a": (0, 1), "d": (1, 9)}
    put(table, {"b": (1, 7)})
    assert content(table.read()) == {"a": (0, 1), "d": (1, 9), "b": (1, 7)}
    with pytest.raises(Exception, match="outside"):
        table.replace_dates(fresh, {day(2)})
    assert content(table.read()) == {"a": (0, 1), "d": (1, 9), "b": (1, 7)}


def test_large_replaced_date_is_rebalanced(table, spark):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    try:
        rows = spark.range(0, 20000, 1, 8).selectExpr(
            "sha2(string(id), 256) AS event_id", "DATE'2024-01-02' AS event_date", "id AS campaign_id", "id AS v"
        )
        table.replace_dates(rows, {day(1)})
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert table_files(table).count() > 3
    assert table.read().count() == table.read().select("event_id").distinct().count() == 20000


def test_saved_version_stays(table):
    put(table, {"a": (0, 1), "b": (1, 2)})
    table.save_version("before")
    put(table, {"a": (2, 3), "c": (0, 1)})
    assert content(table.read(version="before")) == {"a": (0, 1), "b": (1, 2)}
    assert content(table.read(day(1), day(1), version="before")) == {"b": (1, 2)}


def test_expiry_of_the_change_feed(table):
    for n in range(5):
        put(table, {"a": (0, n)}, f"q-{n}")
    assert expire_changes(table, datetime.now(timezone.utc) - timedelta(days=7), 1) == 0
    assert expire_changes(table, FUTURE, retain_last=2) == 3
    assert {r["batch"] for r in table.changes().collect()} == {"q-3", "q-4"}
    assert content(table.read()) == {"a": (0, 4)}


def test_abandoned_staging_folders_go_when_old(table):
    put(table, {"a": (0, 1)})
    left = f"{table.data_path}/.spark-staging-x"
    table.read().write.parquet(left)
    assert abandoned_folders(table, datetime.now(timezone.utc) - timedelta(days=3)) == []
    assert len(abandoned_folders(table, FUTURE, dry_run=True)) == 1 and os.path.exists(left)
    assert len(abandoned_folders(table, FUTURE)) == 1 and not os.path.exists(left)
    assert content(table.read()) == {"a": (0, 1)}


def test_catalog_name_follows_every_write(spark, folder):
    spark.sql("CREATE NAMESPACE IF NOT EXISTS named")
    table = UpsertTable(spark, f"{folder}/n", SCHEMA, ["event_id"], name="named.events")
    table.create()
    table.register()
    assert spark.table("named.events").schema.names == ["event_id", "campaign_id", "v", "event_date"]
    put(table, {"a": (0, 1), "b": (1, 1)})
    assert content(spark.table("named.events")) == {"a": (0, 1), "b": (1, 1)}
    put(table, {"a": (2, 5)})
    table.replace_dates(spark.createDataFrame([], SCHEMA), {day(1)})
    assert content(spark.sql("SELECT * FROM named.events WHERE event_date >= '2024-01-01'")) == {"a": (2, 5)}
    spark.sql("CREATE TABLE IF NOT EXISTS named.own (v bigint) USING parquet")
    with pytest.raises(ValueError, match="of its own"):
        UpsertTable(spark, f"{folder}/n", SCHEMA, ["event_id"], name="named.own").register()
    again = UpsertTable(spark, f"{folder}/other", SCHEMA, ["event_id"], name="named.events")
    again.create()
    again.register()
    assert content(spark.table("named.events")) == {} and content(table.read()) == {"a": (2, 5)}


@pytest.mark.parametrize("seed", range(2))
def test_random_history_against_a_dict(table, seed):
    """Upserts mixed with every maintenance action."""
    random.seed(seed)
    expected = {}
    for step in range(8):
        batch = {f"k{random.randrange(12)}": (random.randrange(4), step * 100 + i) for i in range(6)}
        put(table, batch, f"q-{step}")
        expected |= batch
        action = random.choice(["none", "compact", "expire", "orphan", "all"])
        if action != "none":
            maintain([table], action, retention=timedelta(0), retain_last=2, orphan_age=timedelta(0))
        if step % 3 == 2:
            assert content(table.read()) == expected
            d = random.randrange(4)
            assert content(table.read(day(d), day(d))) == {k: v for k, v in expected.items() if v[0] == d}
    assert content(table.read()) == expected


def test_unknown_action(table):
    with pytest.raises(ValueError):
        maintain([table], "polish")


def test_defaults():
    assert maintenance.TARGET_BYTES == 134217728
    assert (maintenance.RETENTION, maintenance.RETAIN_LAST) == (timedelta(days=7), 24)
    assert maintenance.ORPHAN_AGE == timedelta(days=3)


def test_listing_takes_a_task_a_folder_and_survives_what_vanishes(spark, folder):
    from adlake.sources.file_stats import FolderReader, Folders, file_stats

    for n in range(4):
        spark.range(20, numPartitions=5).write.parquet(f"{folder}/d{n}")
    paths = [f"{folder}/d{n}" for n in range(4)]
    listing = file_stats(spark, [*paths, f"file:{folder}/gone"])
    rows = listing.collect()
    assert len(rows) == 20 and listing.rdd.getNumPartitions() <= 5
    sizes = {os.path.join(root, name): os.path.getsize(os.path.join(root, name)) for path in paths for root, _, names in os.walk(path) for name in names if name.endswith(".parquet")}
    assert {r["path"]: r["length"] for r in rows} == sizes
    assert all(abs(r["modificationTime"].timestamp() - time.time()) < 86400 * 2 and r["content"] == "DATA" for r in rows)
    assert [len(p.paths) for p in FolderReader([str(n) for n in range(600)]).partitions()].count(3) == 88
    assert list(FolderReader([]).read(Folders([f"{folder}/never"]))) == []
    assert file_stats(spark, []).count() == 0
