"""Every operator as a query over the given tables.

Each takes the session and the tables' folder. Results use text for dates and
times and round doubles to six digits, so they compare across engines.
Operators that work on files or streams get these derived from the tables,
under the session's shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.errors import SparkRuntimeException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from adlake.functions.exprs import ISO_MICROS
from adlake.operators.dedup import latest_copy, latest_per_key
from adlake.operators.filters import date_range, ingest_date_between, trailing
from adlake.operators.kpis import (
    DAILY_KEYS,
    HOURLY_KEYS,
    daily_kpis,
    daily_unique_users,
    events_without_campaign,
    hourly_kpis,
    hourly_unique_users,
    hourly_user_sketches,
)
from adlake.operators.projections import (
    coerce,
    drop_unidentified,
    parse_payload,
    project_bronze,
    project_silver,
    rebase_time,
    to_events,
    to_raw_messages,
    with_event_id,
)
from adlake.operators.upsert import merge_frames
from adlake.plans import health, reports, scaling
from adlake.plans.backfill import backfill_and_rebuild, backfill_silver
from adlake.plans.gold import build_gold, rebuild_changed
from adlake.plans.landing import rejected_rows
from adlake.schemas import PAYLOAD_SCHEMA, SOURCE_COLUMNS, SOURCE_SCHEMA
from adlake.session import CODEC, scratch_dir
from adlake.sources.bronze import bronze_stream, read_bronze, register_bronze, write_bronze
from adlake.sources.messages import as_feed, publish, raw_stream
from adlake.sources.source_log import read_source_log
from adlake.sources.testdata import (
    BASE_EPOCH,
    PARTITIONS,
    TOPIC,
    ad_events,
    batch_metrics,
    file_stats_frame,
    read_table,
    source_rows,
    topic_offsets,
)
from adlake.streaming.queries import bronze_batch, silver_batch, start_bronze, start_silver
from adlake.tables.lake import Lake, bootstrap
from adlake.tables.maintenance import compact_files, maintain, orphan_files
from adlake.tables.upsert_table import UpsertTable

AS_OF = datetime(2024, 1, 31)
ONCE = {"availableNow": True}
COPY_SHIFT = 1_000_000_000
FEED_ROWS = 250_000  # source rows in a task that makes messages

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]):
    """Registers a query under its function's name, less the ``_query`` that
    keeps it apart from the operator it runs."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(function(spark, sf_dir))

    run.__name__ = function.__name__.removesuffix("_query")
    run.__doc__ = function.__doc__
    REGISTRY[run.__name__] = run
    return function


def plain(df: DataFrame) -> DataFrame:
    columns = []
    for f in df.schema:
        kind, column = f.dataType.typeName(), F.col(f.name)
        if kind == "date":
            column = column.cast("string")
        elif kind == "timestamp":
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind == "double":
            # Ratios of decimal inputs often end in a 5 at the seventh digit; the
            # shift rounds them up whichever way their last bit went.
            column = F.round(column + 1e-9, 6)
        columns.append(column.alias(f.name))
    return df.select(*columns)


# -- derived inputs ------------------------------------------------------


def sent_after() -> Column:
    """When a message is made: two seconds after its event."""
    return F.timestamp_seconds(F.col("timestamp") + BASE_EPOCH + 2)


def message_feed(spark: SparkSession, sf_dir: str, copies: bool = False) -> DataFrame:
    """Source rows as messages, spread like a topic's partitions; with
    ``copies``, every tenth row comes again later with its cost doubled.

    A long feed has more tasks, as a writer may sort what one task holds."""
    tasks = max(PARTITIONS, -(-read_table(spark, sf_dir, "events").count() // FEED_ROWS))
    rows = source_rows(spark, sf_dir, tasks).withColumn("position", F.col("line_number"))
    if copies:
        again = rows.where("line_number % 10 = 0").withColumns(
            {"cost": F.col("cost") * 2, "position": F.col("line_number") + COPY_SHIFT}
        )
        rows = rows.unionByName(again)
    sent = F.timestamp_seconds(F.col("timestamp") + BASE_EPOCH)
    events = to_events(rows, BASE_EPOCH, sent_after()).withColumn("sent", sent)
    return as_feed(to_raw_messages(events, "position", "sent"), TOPIC, PARTITIONS, "position", F.col("sent"))


def bronze_folder(spark: SparkSession, sf_dir: str, path: str, copies: bool = False) -> str:
    write_bronze(project_bronze(message_feed(spark, sf_dir, copies)), path, "feed")
    return path


def new_lake(spark: SparkSession, name: str) -> Lake:
    return bootstrap(spark, scratch_dir(spark, name), named=False)


def hourly_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_kpis(ad_events(spark, sf_dir))


def daily_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_kpis(hourly_of(spark, sf_dir))


def with_copies(events: DataFrame) -> DataFrame:
    """Every tenth event again at a later position with its cost doubled."""
    first = events.withColumns({"kafka_timestamp": F.col("event_time"), "kafka_offset": F.col("seq")})
    again = first.where("seq % 10 = 0").withColumns(
        {"cost": F.col("cost") * 2, "kafka_offset": F.col("seq") + COPY_SHIFT}
    )
    return first.unionByName(again).withColumn("kafka_partition", F.lit(0).cast("bigint"))


def without_estimate(df: DataFrame) -> DataFrame:
    return df.drop("unique_users", "unique_users_approx", "gold_updated_at")


# -- KPIs ----------------------------------------------------------------


@query
def campaign_hourly_kpis(spark, sf_dir):
    return without_estimate(hourly_of(spark, sf_dir))


@query
def campaign_daily_kpis(spark, sf_dir):
    return without_estimate(daily_of(spark, sf_dir))


@query
def gold_hourly_range(spark, sf_dir):
    events = date_range(ad_events(spark, sf_dir), "2024-01-10", "2024-01-12")
    return without_estimate(hourly_kpis(events))


@query
def hourly_unique_users_query(spark, sf_dir):
    return hourly_unique_users(ad_events(spark, sf_dir))


@query
def unique_users_estimate(spark, sf_dir):
    """The estimate per campaign and day stays within a quarter of the count."""
    groups = ad_events(spark, sf_dir).groupBy("event_date")
    counts = groups.agg(
        F.approx_count_distinct("user_id").alias("estimate"), F.count_distinct("user_id").alias("users")
    )
    close = F.abs(F.col("estimate") - F.col("users")) <= F.col("users") * 0.25
    return counts.select("event_date", "users", close.alias("within_a_quarter"))


@query
def unique_users_hll(spark, sf_dir):
    """Daily users from hourly sketches stay within a twentieth of the count."""
    events = ad_events(spark, sf_dir)
    estimate = daily_unique_users(hourly_user_sketches(events))
    users = events.where("campaign_id IS NOT NULL").groupBy(*DAILY_KEYS).agg(F.count_distinct("user_id").alias("users"))
    close = F.abs(F.col("unique_users_hll") - F.col("users")) <= F.col("users") * 0.05
    return users.join(estimate, DAILY_KEYS).select("event_date", "campaign_id", "users", close.alias("within_a_twentieth"))


@query
def events_left_out_of_gold(spark, sf_dir):
    events = ad_events(spark, sf_dir)
    some_missing = F.when(F.col("seq") % 7 != 0, F.col("campaign_id"))
    return events_without_campaign(events.withColumn("campaign_id", some_missing))


# -- ingest --------------------------------------------------------------


def written_log(spark: SparkSession, sf_dir: str) -> str:
    """The source rows as a headed text log of several files in order; every
    ninth row lacks a field."""
    path = scratch_dir(spark, "source-log")
    row = F.concat_ws("\t", *SOURCE_COLUMNS)
    lines = source_rows(spark, sf_dir).select(
        "line_number",
        F.when(F.col("line_number") % 9 == 0, F.regexp_replace(row, r"\t[^\t]*$", "")).otherwise(row).alias("value"),
    )
    header = spark.range(1).select(
        F.lit(0).cast("bigint").alias("line_number"), F.lit("\t".join(SOURCE_COLUMNS)).alias("value")
    )
    ordered = lines.unionByName(header).repartitionByRange("line_number").sortWithinPartitions("line_number")
    ordered.select("value").write.text(path)
    return path


@query
def source_log_lines(spark, sf_dir):
    rows = read_source_log(spark, written_log(spark, sf_dir), start_line=100)
    good, _ = coerce(rows)
    return with_event_id(good).select("line_number", "event_id", "uid", "campaign", "cost")


@query
def source_log_first_events(spark, sf_dir):
    return read_source_log(spark, written_log(spark, sf_dir), max_events=500).select("line_number", "uid")


@query
def source_log_events_after(spark, sf_dir):
    """A stretch of the log: the first rows after a line."""
    return read_source_log(spark, written_log(spark, sf_dir), start_line=400, max_events=300).select("line_number", "uid")


def textual_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source rows as text, some with a word where a number belongs."""
    rows = source_rows(spark, sf_dir)
    text = rows.select("line_number", *[F.col(c).cast("string").alias(c) for c in SOURCE_COLUMNS])
    return text.withColumns(
        {
            "uid": F.when(F.col("line_number") % 17 == 0, "none").otherwise(F.col("uid")),
            "cost": F.when(F.col("line_number") % 23 == 0, "").otherwise(F.col("cost")),
        }
    )


@query
def source_coercion(spark, sf_dir):
    good, _ = coerce(textual_rows(spark, sf_dir))
    return good.select("line_number", "uid", "campaign", "cost", "cpo", "cat9")


@query
def source_quarantine(spark, sf_dir):
    _, rejected = coerce(textual_rows(spark, sf_dir))
    return rejected.select("line_number", "reject_reason")


@query
def event_time_rebase(spark, sf_dir):
    rows = rebase_time(source_rows(spark, sf_dir), 1700000000.25)
    return rows.select("line_number", "source_timestamp", "event_time")


@query
def event_identity(spark, sf_dir):
    return with_event_id(source_rows(spark, sf_dir)).select("line_number", "event_id")


@query
def raw_messages(spark, sf_dir):
    """Every message field, read back out of the JSON text."""
    messages = to_raw_messages(to_events(source_rows(spark, sf_dir), BASE_EPOCH, sent_after()))
    fields = ["timestamp", *PAYLOAD_SCHEMA.names]
    read = messages.select("key", F.json_tuple("value", *fields).alias(*fields))
    kinds = {f.name: f.dataType for f in SOURCE_SCHEMA} | {"source_timestamp": LongType()}
    return read.withColumns({name: F.col(name).cast(kind) for name, kind in kinds.items()})


@query
def bronze_projection(spark, sf_dir):
    raw = read_table(spark, sf_dir, "events").select(
        F.lit(TOPIC).alias("topic"),
        (F.col("user_id") % PARTITIONS).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
    )
    return project_bronze(raw).drop("bronze_ingest_ts", "ingest_date", "ingest_hour")


SILVER_CHECKED = [
    "event_id", "event_time", "event_date", "event_hour", "source_timestamp", "user_id", "campaign_id",
    "conversion", "conversion_timestamp", "conversion_id", "attribution", "click", "click_pos",
    "click_nb", "cost", "cpo", "time_since_last_click", *[f"cat{i}" for i in range(1, 10)],
    "producer_ingest_ts", "kafka_topic", "kafka_offset",
]


@query
def silver_events(spark, sf_dir):
    path = bronze_folder(spark, sf_dir, scratch_dir(spark, "bronze"))
    return project_silver(read_bronze(spark, path)).select(*SILVER_CHECKED)


@query
def payload_rejects(spark, sf_dir):
    """Payloads by whether they carry an event id and time; the plain props do not."""
    events = read_table(spark, sf_dir, "events")
    made = F.to_json(
        F.struct(F.col("event_id").cast("string").alias("event_id"), F.col("ts").cast("timestamp").alias("event_time")),
        {"timestampFormat": ISO_MICROS},
    )
    broken = F.when(F.col("event_id") % 5 == 0, F.substring(made, 1, 20)).otherwise(made)
    bronze = events.select("event_type", F.when(F.col("event_id") % 3 == 0, F.col("props")).otherwise(broken).alias("payload"))
    good, rejected = drop_unidentified(parse_payload(bronze))
    both = good.select("event_type", F.lit("good").alias("kind")).unionByName(
        rejected.select("event_type", F.lit("rejected").alias("kind"))
    )
    return both.groupBy("event_type", "kind").agg(F.count("*").alias("rows"))


@query
def bronze_sql_table(spark, sf_dir):
    """Bronze as an external table, asked in SQL."""
    path = bronze_folder(spark, sf_dir, scratch_dir(spark, "bronze"), copies=True)
    register_bronze(spark, path, "bronze_ad_events")
    return spark.sql(
        "SELECT topic, count(*) AS messages, count(DISTINCT kafka_key) AS events, "
        "max(kafka_offset) AS last_offset FROM bronze_ad_events GROUP BY topic"
    )


@query
def ingest_date_bounds(spark, sf_dir):
    frame = ad_events(spark, sf_dir).withColumn("ingest_date", F.date_format("event_time", "yyyy-MM-dd"))
    both = ingest_date_between(frame, "2024-01-05", "2024-01-07")
    return both.groupBy("ingest_date").agg(F.count("*").alias("rows"))


@query
def trailing_window(spark, sf_dir):
    recent = trailing(ad_events(spark, sf_dir), "event_time", timedelta(hours=36), AS_OF)
    return recent.select("event_id", "event_time")


# -- dedup and upsert ----------------------------------------------------


@query
def silver_dedup(spark, sf_dir):
    rows = latest_copy(with_copies(ad_events(spark, sf_dir)))
    return rows.select("event_id", "seq", "kafka_offset", "cost")


def upsert_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Overlapping sides; the source doubles costs and moves rows a day on."""
    events = ad_events(spark, sf_dir)
    source = events.where("seq % 2 = 0").withColumns(
        {
            "cost": F.col("cost") * 2,
            "event_time": F.col("event_time") + F.expr("INTERVAL 1 DAY"),
            "event_date": F.date_add("event_date", 1),
        }
    )
    return events.where("seq % 3 <> 0"), source


UPSERT_COLUMNS = ["event_id", "seq", "event_date", "event_hour", "campaign_id", "cost"]


@query
def silver_upsert(spark, sf_dir):
    target, source = upsert_sides(spark, sf_dir)
    return merge_frames(target, source, "event_id").select(*UPSERT_COLUMNS)


def upserted_table(spark: SparkSession, sf_dir: str, name: str) -> UpsertTable:
    """The same upsert on a stored table: its content, then two batches."""
    target, source = upsert_sides(spark, sf_dir)
    columns = ["event_id", "seq", "event_date", "event_hour", "campaign_id", "user_id", "click", "cost"]
    schema = target.select(*columns).schema
    table = UpsertTable(spark, scratch_dir(spark, name), schema, ["event_id"])
    table.create()
    table.upsert(target)
    table.save_version("first")
    table.upsert(source.where("seq % 4 = 0").withColumn("cost", F.lit(-1.0)), "feed-0")
    table.upsert(source, "feed-1")
    table.upsert(source, "feed-1")  # replayed, which changes nothing
    return table


@query
def stored_table_upsert(spark, sf_dir):
    table = upserted_table(spark, sf_dir, "upserted")
    return table.read().select(*UPSERT_COLUMNS)


@query
def stored_table_range(spark, sf_dir):
    table = upserted_table(spark, sf_dir, "ranged")
    return table.read("2024-01-10", "2024-01-12").select(*UPSERT_COLUMNS)


@query
def stored_table_folded(spark, sf_dir):
    """Contents after its files were made fewer."""
    table = upserted_table(spark, sf_dir, "folded")
    compact_files(table)
    return table.read().select(*UPSERT_COLUMNS)


@query
def stored_table_maintained(spark, sf_dir):
    """Contents after compaction, expiry and clean-up."""
    table = upserted_table(spark, sf_dir, "maintained")
    maintain([table], "all", retention=timedelta(0), retain_last=1, orphan_age=timedelta(0))
    return table.read().select(*UPSERT_COLUMNS)


@query
def stored_table_earlier_version(spark, sf_dir):
    """The rows as they were kept before the batches."""
    table = upserted_table(spark, sf_dir, "versions")
    return table.read(version="first").select(*UPSERT_COLUMNS)


@query
def stored_table_changes(spark, sf_dir):
    """What the two batches changed, by old and new date."""
    return upserted_table(spark, sf_dir, "changes").changes().where("batch LIKE 'feed-%'").drop("changed_at")


@query
def backfill_range(spark, sf_dir):
    """Two overlapping backfills from a Bronze with later copies."""
    lake = new_lake(spark, "backfill")
    bronze_folder(spark, sf_dir, lake.bronze_path, copies=True)
    backfill_silver(lake, "2024-01-03", "2024-01-10")
    backfill_silver(lake, "2024-01-08", "2024-01-15")
    return lake.silver.read().select(*SILVER_CHECKED)


# -- gold tables ---------------------------------------------------------


def gold_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """KPIs of the first 20 days, and of days 15 to 30 from half the events."""
    events = ad_events(spark, sf_dir)
    target = hourly_kpis(date_range(events, "2024-01-01", "2024-01-20"))
    source = hourly_kpis(date_range(events.where("seq % 2 = 0"), "2024-01-15", "2024-01-30"))
    return target, source


@query
def gold_hourly_upsert(spark, sf_dir):
    return without_estimate(merge_frames(*gold_sides(spark, sf_dir), HOURLY_KEYS))


@query
def gold_daily_upsert(spark, sf_dir):
    target, source = gold_sides(spark, sf_dir)
    return without_estimate(merge_frames(daily_kpis(target), daily_kpis(source), DAILY_KEYS))


def loaded_lake(spark: SparkSession, sf_dir: str, name: str, copies: bool = False) -> Lake:
    lake = new_lake(spark, name)
    bronze_folder(spark, sf_dir, lake.bronze_path, copies)
    backfill_silver(lake, "2024-01-01", "2024-01-31")
    return lake


@query
def gold_tables(spark, sf_dir):
    """Both Gold tables built twice over overlapping dates."""
    lake = loaded_lake(spark, sf_dir, "gold")
    build_gold(lake, "2024-01-01", "2024-01-20")
    build_gold(lake, "2024-01-15", "2024-01-31")
    return without_estimate(lake.daily.read())


@query
def gold_rebuild_after_move(spark, sf_dir):
    """Gold after events moved to later days and both days were rebuilt."""
    lake = loaded_lake(spark, sf_dir, "moved")
    build_gold(lake, "2024-01-01", "2024-01-31")
    bronze = read_bronze(spark, lake.bronze_path)
    # The replay sends the campaigns of one day again, two days later.
    shifted = F.regexp_replace("payload", '"event_time":"2024-01-05T', '"event_time":"2024-01-07T')
    replay = bronze.withColumns({"payload": shifted, "kafka_offset": F.col("kafka_offset") + COPY_SHIFT})
    write_bronze(replay.where(F.get_json_object("payload", "$.event_time").startswith("2024-01-07T")), lake.bronze_path, "replay")
    backfill_and_rebuild(lake, "2024-01-07", "2024-01-07")
    return without_estimate(lake.daily.read())


@query
def gold_rebuild_of_changes(spark, sf_dir):
    """Gold kept current by Silver's change feed alone, over three batches."""
    lake = new_lake(spark, "fed")
    bronze_folder(spark, sf_dir, lake.bronze_path, copies=True)
    for first, last in (("2024-01-03", "2024-01-10"), ("2024-01-08", "2024-01-15")):
        backfill_silver(lake, first, last)
        rebuild_changed(lake)
    events = lake.silver.read()
    moved = events.where(F.col("kafka_offset") % 3 == 0).withColumns(
        {"event_date": F.date_add("event_date", 1), "event_time": F.col("event_time") + F.expr("INTERVAL 1 DAY")}
    )
    lake.silver.upsert(moved, "moved")
    rebuild_changed(lake)
    return without_estimate(lake.daily.read())


@query
def gold_by_name(spark, sf_dir):
    """Daily KPIs asked in SQL by the table's name, after two builds."""
    lake = bootstrap(spark, scratch_dir(spark, "by-name"))
    bronze_folder(spark, sf_dir, lake.bronze_path)
    backfill_silver(lake, "2024-01-01", "2024-01-31")
    build_gold(lake, "2024-01-01", "2024-01-20")
    build_gold(lake, "2024-01-15", "2024-01-31")
    return without_estimate(spark.sql("SELECT * FROM ad_gold.campaign_daily_kpis"))


# -- streams -------------------------------------------------------------


def streamed_lake(spark: SparkSession, sf_dir: str, name: str) -> Lake:
    """Messages through both streams, in two runs each: a stop, more messages, a restart."""
    lake = new_lake(spark, name)
    feed = f"{lake.root}/feed"
    messages = message_feed(spark, sf_dir, copies=True)
    for part in (F.col("offset") < COPY_SHIFT, F.col("offset") >= COPY_SHIFT):
        publish(messages.where(part), "parquet", {"path": feed, "compression": CODEC})
        start_bronze(lake, raw_stream(spark, "parquet", {"path": feed}), ONCE).awaitTermination()
        start_silver(lake, bronze_stream(spark, lake.bronze_path), ONCE).awaitTermination()
    return lake


@query
def stream_to_silver(spark, sf_dir):
    return streamed_lake(spark, sf_dir, "streamed").silver.read().select(*SILVER_CHECKED)


@query
def stream_batch_metrics(spark, sf_dir):
    """Rows that both streams' batches recorded, by status, a failed Bronze
    batch among them."""
    lake = streamed_lake(spark, sf_dir, "metrics")
    messages = message_feed(spark, sf_dir).where("offset % 4 = 0")
    failing = messages.withColumn("value", F.raise_error(F.lit("no payload")).cast("binary"))
    try:
        bronze_batch(lake, failing, 99, "failing")
    except SparkRuntimeException:
        pass  # recorded, and raised for the stream to stop
    return lake.batch_metrics.read().groupBy("query_name", "status").agg(F.sum("row_count").alias("rows"))


@query
def stream_batch_rejects(spark, sf_dir):
    """Good and rejected rows of each Silver batch: every seventh payload is
    broken, and every eleventh message of the second batch."""
    lake = new_lake(spark, "rejects")
    messages = project_bronze(message_feed(spark, sf_dir))
    for number, every in ((0, 7), (1, 11)):
        broken = F.when(F.col("kafka_offset") % every == 0, F.substring("payload", 1, 20)).otherwise(F.col("payload"))
        batch = messages.where(F.col("kafka_offset") % 2 == number).withColumn("payload", broken)
        write_bronze(batch, lake.bronze_path, f"part-{number}")
        start_silver(lake, bronze_stream(spark, lake.bronze_path, 1_000_000), ONCE).awaitTermination()
    return lake.batch_rejects.read().select("query_name", "batch_id", "good", "rejected")


@query
def stream_dead_letters(spark, sf_dir):
    """The rejected rows themselves, as the dead-letter partition keeps them."""
    lake = new_lake(spark, "letters")
    broken = F.when(F.col("kafka_offset") % 7 == 0, F.lit("{")).otherwise(F.col("payload"))
    silver_batch(lake, project_bronze(message_feed(spark, sf_dir)).withColumn("payload", broken), 0, "letters")
    return rejected_rows(lake).select("batch", "kafka_topic", "kafka_offset", "payload")


# -- reports -------------------------------------------------------------


@query
def report_campaign_daily(spark, sf_dir):
    return reports.campaign_daily(daily_of(spark, sf_dir), AS_OF)


@query
def report_campaign_hourly(spark, sf_dir):
    return reports.campaign_hourly(hourly_of(spark, sf_dir), AS_OF)


@query
def report_hourly_funnel(spark, sf_dir):
    return reports.hourly_funnel(hourly_of(spark, sf_dir))


@query
def report_conversion_efficiency(spark, sf_dir):
    return reports.conversion_efficiency(daily_of(spark, sf_dir))


@query
def report_top_spend(spark, sf_dir):
    return reports.top_spend(daily_of(spark, sf_dir), "2024-01-15")


@query
def report_wasteful_campaigns(spark, sf_dir):
    return reports.wasteful_campaigns(daily_of(spark, sf_dir), 0.25, 0.75)


@query
def report_streaming_batches(spark, sf_dir):
    return reports.streaming_batches(batch_metrics(spark, sf_dir), AS_OF)


@query
def latest_per_key_query(spark, sf_dir):
    events = read_table(spark, sf_dir, "events")
    return latest_per_key(events, "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


@query
def report_health_latest(spark, sf_dir):
    """The newest result per metric, from one result row per ``events`` row."""
    results = read_table(spark, sf_dir, "events").select(
        F.concat(F.lit("metric_"), (F.col("user_id") % 50).cast("string")).alias("metric_name"),
        F.col("value").alias("metric_value"),
        F.when(F.col("event_type") == "error", "CRITICAL").otherwise("OK").alias("severity"),
        F.col("props").alias("details"),
        F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("run_ts"),
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("query_file"),
    )
    return reports.health_latest(results)


# -- health --------------------------------------------------------------


@query
def health_silver_freshness(spark, sf_dir):
    return health.silver_freshness(ad_events(spark, sf_dir), AS_OF)


@query
def health_gold_freshness(spark, sf_dir):
    updated = F.col("event_date").cast("timestamp") + F.make_interval(hours=F.col("event_hour"))
    hourly = hourly_of(spark, sf_dir).withColumn("gold_updated_at", updated)
    return health.gold_freshness(hourly, AS_OF + timedelta(minutes=47))


@query
def health_daily_rows(spark, sf_dir):
    return health.daily_row_count(ad_events(spark, sf_dir), AS_OF)


@query
def health_duplicates(spark, sf_dir):
    return health.duplicate_event_ids(with_copies(ad_events(spark, sf_dir)), AS_OF)


@query
def health_batch_duration(spark, sf_dir):
    return health.batch_duration(batch_metrics(spark, sf_dir), AS_OF)


@query
def health_avg_file_size(spark, sf_dir):
    return health.avg_file_size(file_stats_frame(spark, sf_dir)).drop("details")


@query
def health_small_file_ratio(spark, sf_dir):
    return health.small_file_ratio(file_stats_frame(spark, sf_dir))


@query
def health_delta_files(spark, sf_dir):
    listing = file_stats_frame(spark, sf_dir)
    recent = listing.where(F.col("modificationTime") >= F.lit(datetime(1998, 1, 1)))
    return health.gold_delta_file_count(listing, recent).drop("details")


def commit_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events").select(
        F.col("event_id").alias("commit"), F.col("ts").cast("timestamp").alias("committed_at")
    )


@query
def health_snapshot_growth(spark, sf_dir):
    return health.snapshot_growth(commit_frame(spark, sf_dir), AS_OF)


@query
def health_manifest_count(spark, sf_dir):
    return health.commit_record_count(file_stats_frame(spark, sf_dir)).drop("details")


# These follow the clock or the size of files, and so have no fixed value.
UNSTEADY = ["gold_freshness_minutes", "silver_avg_file_size_mb"]
WITH_SIZES = ["silver_small_file_ratio", "silver_snapshots_last_24h", "silver_manifest_count"]


@query
def health_run(spark, sf_dir):
    """All checks on a loaded lake. Values and details that the clock or the
    codec decide are left out; every metric has its severity."""
    lake = loaded_lake(spark, sf_dir, "health")
    build_gold(lake, "2024-01-01", "2024-01-31")
    rows = health.run_health(lake, AS_OF)
    unsteady = F.col("metric_name").isin(*UNSTEADY)
    return rows.withColumns(
        {
            "metric_value": F.when(~unsteady, F.col("metric_value")),
            "details": F.when(~unsteady & ~F.col("metric_name").isin(*WITH_SIZES), F.regexp_replace("details", "data_files=[0-9]+", "data_files=n")),
        }
    )


@query
def orphan_files_query(spark, sf_dir):
    listing = file_stats_frame(spark, sf_dir)
    commits = read_table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 50).alias("commit"))
    known = commits.where("commit < 40").distinct()
    return orphan_files(listing, known, datetime(1997, 1, 1)).select("path", "length")


# -- scaling -------------------------------------------------------------


@query
def scaling_lag(spark, sf_dir):
    return scaling.consumer_lag(topic_offsets(spark, sf_dir))


@query
def scaling_duration(spark, sf_dir):
    return scaling.max_duration(batch_metrics(spark, sf_dir), AS_OF)


@query
def scaling_decision(spark, sf_dir):
    """One decision per user, with the table's lag and the last batch duration."""
    apps = read_table(spark, sf_dir, "events").select(
        F.concat(F.lit("app-"), F.col("user_id").cast("string")).alias("app"),
        (F.col("user_id") % 13 + 1).cast("int").alias("current_max"),
    )
    lag = scaling.consumer_lag(topic_offsets(spark, sf_dir))
    duration = scaling.max_duration(batch_metrics(spark, sf_dir), AS_OF)
    return scaling.decide(apps.distinct(), lag, duration, scale_up_duration=1_000_000)


def recorded_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets as the listener records them: one query per user, one report per
    event; users above 40 stopped reporting before the last quarter of an hour."""
    events = read_table(spark, sf_dir, "events")
    late = F.when(F.col("user_id") % 50 > 40, F.expr("INTERVAL 1 DAY")).otherwise(F.expr("INTERVAL 0 DAY"))
    return events.select(
        (F.lit(AS_OF) - F.make_interval(secs=F.col("event_id") % 900) - late).alias("metric_ts"),
        F.concat(F.lit("app-"), (F.col("user_id") % 50).cast("string")).alias("query_name"),
        F.col("event_id").alias("batch_id"),
        F.lit(TOPIC).alias("topic"),
        (F.col("event_id") % PARTITIONS).cast("int").alias("partition"),
        (F.col("event_id") * 10).alias("end_offset"),
        (F.col("event_id") * 10 - (F.col("user_id") % 50) * 100).alias("committed_offset"),
    )


@query
def scaling_of_recorded_lag(spark, sf_dir):
    """A decision per query from the offsets it recorded: up, down, hold, and
    for those that recorded none, unknown."""
    lag = scaling.recorded_lag(recorded_offsets(spark, sf_dir), AS_OF)
    apps = read_table(spark, sf_dir, "events").select(
        F.concat(F.lit("app-"), (F.col("user_id") % 50).cast("string")).alias("app"),
        (F.col("user_id") % 50 % 13 + 1).cast("int").alias("current_max"),
        ((F.col("user_id") % 50 % 5) * 10_000).cast("bigint").alias("duration_ms"),
    )
    known = apps.distinct().join(lag, F.col("app") == F.col("query_name"), "left").drop("query_name")
    return scaling.decide(known, scale_up_lag=15_000, scale_down_lag=6_000)
