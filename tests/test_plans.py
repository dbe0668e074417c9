"""What Catalyst makes of the queries."""

import re
from datetime import date, datetime, timezone
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import __spark_entry__ as contract
from adlake.operators.dedup import latest_copy
from adlake.operators.kpis import hourly_kpis
from adlake.operators.projections import project_bronze, project_silver, silver_candidates
from adlake.plans.gold import gold_hourly
from adlake.plans.health import health_checks
from adlake.queries import message_feed, with_copies
from adlake.schemas import BRONZE_SCHEMA
from adlake.sources.bronze import read_bronze, write_bronze
from adlake.sources.testdata import ad_events
from adlake.tables.lake import bootstrap


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lake(spark, sf_dir, tmp_path_factory):
    """Silver with rows of all dates, written more than once."""
    lake = bootstrap(spark, str(tmp_path_factory.mktemp("plans")))
    write_bronze(project_bronze(message_feed(spark, sf_dir)), lake.bronze_path, "feed")
    rows = silver_candidates(read_bronze(spark, lake.bronze_path))
    lake.silver.upsert(rows)
    lake.silver.upsert(rows.where(F.col("kafka_offset") % 2 == 0))
    return lake


def test_no_python_on_the_data_path(spark, sf_dir):
    for name, run in contract.queries().items():
        if name.startswith(("report", "health", "campaign", "gold_hourly", "silver", "scaling", "source", "latest")):
            if name != "health_run":  # lists folders in tasks
                text = plan(run(spark, sf_dir))
                assert not re.search("Python|Pandas|BatchEval", text), name
                assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_kpis_read_only_their_columns(spark, sf_dir):
    text = plan(hourly_kpis(ad_events(spark, sf_dir)))
    [schema] = re.findall(r"ReadSchema: struct<(.*?)>", text)
    assert "event_id" not in schema
    assert text.count("Exchange") == 1 and "partial_count" in text


def test_date_bounds_prune_the_scan(lake):
    text = plan(gold_hourly(lake.silver.read("2024-01-10", "2024-01-11")))
    assert "Join" not in text
    scan = text.split("FileScan")[1]
    assert "InMemoryFileIndex(2 paths)" in scan
    assert "PartitionFilters: [isnotnull(event_date" in scan
    # Gold needs 6 of 33 columns.
    assert "cat1" not in scan.split("ReadSchema")[1] and "event_id" not in scan.split("ReadSchema")[1]


def test_filters_reach_the_scan(lake):
    text = plan(lake.silver.read().where((F.col("event_date") == F.lit(date(2024, 1, 10))) & (F.col("campaign_id") == 3)))
    scan = text.split("FileScan")[1]
    assert re.search(r"PartitionFilters: \[.*event_date", scan)
    assert "EqualTo(campaign_id,3)" in scan and "Exchange" not in text


def test_health_scans_silver_once(lake):
    checks = reduce(DataFrame.unionByName, health_checks(lake, datetime(2024, 1, 31, tzinfo=timezone.utc)))
    scans = re.findall(r"FileScan parquet \[([^]]*)\]", plan(checks))
    silver = [columns for columns in scans if "event_id#" in columns]
    assert [re.sub("#[0-9]+", "", columns) for columns in silver] == ["event_id,event_time,event_date"]
    assert plan(checks).count("folder_listing") <= 1


def test_dedup_limits_each_key_before_the_shuffle(spark, sf_dir):
    text = plan(latest_copy(with_copies(ad_events(spark, sf_dir))))
    before_shuffle = text.split("Exchange", 1)[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_payload_is_parsed_once_and_left_behind(lake, spark):
    bronze = read_bronze(spark, lake.bronze_path)
    assert plan(project_silver(bronze)).count("from_json") == 1
    text = plan(silver_candidates(bronze))
    assert text.count("from_json") == 1
    assert "payload#" not in text.split("Exchange")[0]


def test_ingest_dates_prune_bronze(lake, spark):
    text = plan(read_bronze(spark, lake.bronze_path, "2024-01-01", "2024-01-02"))
    assert re.search(r"PartitionFilters: \[.*ingest_date", text)
    assert BRONZE_SCHEMA.names[-2:] == ["ingest_date", "ingest_hour"]


def test_top_n_is_not_a_full_sort(spark, sf_dir):
    text = plan(contract.queries()["report_top_spend"](spark, sf_dir))
    assert "TakeOrderedAndProject" in text


def test_quantiles_are_exact(spark):
    import math
    import random

    from adlake.plans.reports import exact_quantile

    draw = random.Random(5)
    for count in (1, 7, 30_000):
        values = sorted(draw.choice([draw.random(), 0.25]) for _ in range(count))
        rows = spark.createDataFrame([(value,) for value in values] + [(None,)], "x double")
        for q in (0.0, 0.25, 0.5, 0.75, 1.0):
            assert exact_quantile(rows, "x", q).first()[0] == values[max(1, math.ceil(q * count)) - 1]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    import pytest

    from adlake.session import scratch_dir

    class Conf:
        def __init__(self, **values):
            self.values = values

        def get(self, name, default=None):
            return self.values.get(name.rpartition(".")[2], default)

    class Session:
        def __init__(self, **values):
            self.conf = Conf(**values)

    for master in ("yarn", "local-cluster[3,2,1024]"):
        with pytest.raises(ValueError, match="checkpoint"):
            scratch_dir(Session(master=master), "x")


def test_scratch_of_an_application_can_be_removed(spark, tmp_path):
    from adlake.session import clear_scratch, scratch_dir

    class Conf:
        def get(self, name, default=None):
            return str(tmp_path)

    class Session:
        conf, sparkContext, _jvm, _jsc = Conf(), spark.sparkContext, spark._jvm, spark._jsc

    folder = scratch_dir(Session(), "x")
    assert folder.startswith(f"{tmp_path}/adlake-{spark.sparkContext.applicationId}/x-")
    spark.range(3).write.parquet(folder)
    assert len(list(tmp_path.iterdir())) == 1
    clear_scratch(Session())
    assert list(tmp_path.iterdir()) == []
