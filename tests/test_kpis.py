from datetime import date, datetime, timedelta, timezone

import pytest

from adlake.operators.filters import (
    date_range,
    event_date_between,
    ingest_date_between,
    resolve_dates,
    trailing,
)
from adlake.operators.kpis import daily_kpis, events_without_campaign, hourly_kpis, hourly_unique_users, with_ratios
from adlake.plans.gold import build_gold, gold_daily, gold_hourly
from adlake.plans.reports import conversion_efficiency, health_latest, hourly_funnel, top_spend, wasteful_campaigns
from adlake.schemas import DAILY_SCHEMA, HOURLY_SCHEMA
from adlake.tables.lake import bootstrap

SILVER = (
    "event_date date, event_hour int, campaign_id bigint, user_id bigint, "
    "click int, conversion int, attribution int, cost double"
)
D = date(2024, 1, 1)


def silver(spark, rows):
    return spark.createDataFrame(rows, SILVER)


EVENTS = [
    (D, 1, 7, 1, 1, 1, 1, 0.5),
    (D, 1, 7, 2, 1, 0, 0, None),
    (D, 2, 7, 1, 0, 0, 0, 0.25),
    (D, 2, 8, 3, 0, 0, 0, 1.0),
    (D, 2, None, 3, 1, 1, 1, 9.0),
]


def test_hourly(spark):
    got = {(r["event_hour"], r["campaign_id"]): r for r in hourly_kpis(silver(spark, EVENTS)).collect()}
    assert set(got) == {(1, 7), (2, 7), (2, 8)}
    first = got[1, 7]
    assert (first["events"], first["clicks"], first["conversions"], first["attributed_conversions"]) == (2, 2, 1, 1)
    assert (first["spend"], first["avg_event_cost"], first["unique_users"]) == (0.5, 0.5, 2)
    assert (first["ctr_proxy"], first["conversion_rate"], first["cost_per_attributed_conversion"]) == (1.0, 0.5, 0.5)
    assert got[2, 7]["conversion_rate"] is None and got[2, 7]["cost_per_attributed_conversion"] is None


def test_events_without_campaign_are_counted(spark):
    assert [tuple(r) for r in events_without_campaign(silver(spark, EVENTS)).collect()] == [(D, 1)]


def test_daily_sums_hourly(spark):
    hourly = hourly_kpis(silver(spark, EVENTS))
    got = {r["campaign_id"]: r for r in daily_kpis(hourly).collect()}
    assert (got[7]["events"], got[7]["clicks"], got[7]["spend"]) == (3, 2, 0.75)
    # User 1 counts in both hours: an upper bound of the day's two users.
    assert got[7]["unique_users_approx"] == 3
    assert got[7]["conversion_rate"] == 0.5


def test_exact_users_and_estimate(spark):
    rows = [(D, 1, 7, user % 1000, 0, 0, 0, 0.0) for user in range(3000)]
    frame = silver(spark, rows)
    assert hourly_unique_users(frame).first()["unique_users_exact"] == 1000
    assert abs(hourly_kpis(frame).first()["unique_users"] - 1000) < 200


def test_ratios_of_nothing_are_null(spark):
    frame = spark.createDataFrame(
        [(0, 0, 0, 0, 0.0)], "events bigint, clicks bigint, conversions bigint, attributed_conversions bigint, spend double"
    )
    row = with_ratios(frame).first()
    assert row["ctr_proxy"] is row["conversion_rate"] is row["cost_per_attributed_conversion"] is None


def test_gold_frames_match_their_tables(spark):
    hourly = gold_hourly(silver(spark, EVENTS))
    for frame, schema in ((hourly, HOURLY_SCHEMA), (gold_daily(hourly), DAILY_SCHEMA)):
        assert [(f.name, f.dataType) for f in frame.schema] == [(f.name, f.dataType) for f in schema]


def test_dates(spark):
    days = [(D + timedelta(days=n),) for n in range(5)]
    frame = spark.createDataFrame(days, "event_date date")
    assert event_date_between(frame, "2024-01-02", date(2024, 1, 4)).count() == 3
    assert event_date_between(frame, "2024-01-04", "2024-01-02").count() == 0
    assert date_range(frame, "2024-01-03").count() == 1
    yesterday = datetime.now(timezone.utc).date() - timedelta(days=1)
    assert resolve_dates() == (yesterday, yesterday)
    assert resolve_dates("2024-01-03") == (date(2024, 1, 3), date(2024, 1, 3))


def test_ingest_dates(spark):
    frame = spark.createDataFrame([(f"2024-01-0{n}",) for n in range(1, 6)], "ingest_date string")
    assert ingest_date_between(frame).count() == 5
    assert ingest_date_between(frame, start="2024-01-04").count() == 2
    assert ingest_date_between(frame, end="2024-01-04").count() == 4
    assert ingest_date_between(frame, "2024-01-02", "2024-01-02").count() == 1


def test_trailing_includes_its_bound(spark):
    at = datetime(2024, 1, 8, 12)
    frame = spark.createDataFrame(
        [(at - timedelta(minutes=n), (at - timedelta(days=n)).date()) for n in (14, 15, 16)], "ts timestamp, day date"
    )
    assert trailing(frame, "ts", timedelta(minutes=15), at).count() == 2
    days = spark.createDataFrame([(date(2024, 1, 1),), (date(2023, 12, 31),)], "day date")
    assert trailing(days, "day", timedelta(days=7), at).count() == 1


DAILY = (
    "event_date date, campaign_id bigint, events bigint, clicks bigint, conversions bigint, "
    "attributed_conversions bigint, spend double, conversion_rate double, cost_per_attributed_conversion double"
)


def daily(spark):
    rows = [(D, n, 10, n, n % 3, n % 2, float(n // 2), None, None) for n in range(1, 31)]
    return spark.createDataFrame(rows, DAILY)


def test_top_spend_breaks_ties_by_campaign(spark):
    got = [r["campaign_id"] for r in top_spend(daily(spark), "2024-01-01", 4).collect()]
    assert got == [30, 28, 29, 26]
    assert top_spend(daily(spark), "2024-01-02").count() == 0


def test_conversion_efficiency(spark):
    frame = daily(spark).unionByName(daily(spark))
    got = conversion_efficiency(frame).collect()
    assert len(got) == 20
    assert all(r["attributed_conversions"] == 2 for r in got[:15])
    assert got[0]["conversion_rate"] == got[0]["conversions"] / got[0]["clicks"]


def test_wasteful_campaigns(spark):
    rows = [(D, 1, 10, 10, 0, 0, 9.0), (D, 2, 10, 10, 9, 1, 8.0), (D, 3, 10, 10, 5, 1, 1.0), (D, 4, 10, 0, 0, 0, 7.0)]
    frame = spark.createDataFrame(
        [(*r, None, None) for r in rows], DAILY
    )
    got = {r["campaign_id"] for r in wasteful_campaigns(frame, spend_q=0.25, rate_q=0.75).collect()}
    assert got == {1, 4}


def test_funnel(spark):
    got = hourly_funnel(hourly_kpis(silver(spark, EVENTS))).collect()
    assert [(r["event_hour"], r["events"]) for r in got] == [(1, 2), (2, 2)]


def test_health_latest_ties(spark):
    at = datetime(2024, 1, 1)
    frame = spark.createDataFrame(
        [("m", 1.0, "OK", "", at, "a"), ("m", 2.0, "OK", "", at, "b"), ("n", 3.0, "OK", "", at, "a")],
        "metric_name string, metric_value double, severity string, details string, run_ts timestamp, query_file string",
    )
    assert {(r["metric_name"], r["metric_value"]) for r in health_latest(frame).collect()} == {("m", 2.0), ("n", 3.0)}


def load_silver(lake, rows):
    columns = [f.name for f in lake.silver.schema]
    frame = silver(lake.spark, rows)
    named = frame.selectExpr(
        "concat_ws('-', event_date, event_hour, campaign_id, user_id) AS event_id",
        "CAST(event_date AS TIMESTAMP) AS event_time", *frame.columns,
    )
    for missing in [c for c in columns if c not in named.columns]:
        named = named.selectExpr("*", f"NULL AS {missing}")
    lake.silver.upsert(named)


def test_merge_keeps_stale_groups_and_replace_drops_them(spark, folder):
    lake = bootstrap(spark, folder)
    load_silver(lake, [(D, 1, 7, 1, 1, 0, 0, 1.0), (D, 1, 8, 2, 1, 0, 0, 1.0)])
    build_gold(lake, D, D)
    # The event of campaign 8 moves to the next day.
    lake.silver.upsert(lake.silver.read().where("campaign_id = 8").selectExpr(
        *[c if c != "event_date" else "DATE'2024-01-02' AS event_date" for c in lake.silver.schema.names]
    ))
    build_gold(lake, D, D + timedelta(days=1))
    stale = {(str(r["event_date"]), r["campaign_id"]) for r in lake.daily.read().collect()}
    assert stale == {("2024-01-01", 7), ("2024-01-01", 8), ("2024-01-02", 8)}
    build_gold(lake, D, D + timedelta(days=1), mode="replace")
    for table in (lake.hourly, lake.daily):
        fresh = {(str(r["event_date"]), r["campaign_id"]) for r in table.read().collect()}
        assert fresh == {("2024-01-01", 7), ("2024-01-02", 8)}
    build_gold(lake, D, D + timedelta(days=1), mode="replace")
    assert lake.daily.read().count() == 2
    with pytest.raises(ValueError):
        build_gold(lake, D, D, mode="guess")


def test_gold_of_an_empty_range(spark, folder):
    lake = bootstrap(spark, folder)
    build_gold(lake, "2024-01-02", "2024-01-01")
    build_gold(lake, "2024-01-01", "2024-01-02")
    assert lake.hourly.read().count() == lake.daily.read().count() == 0
