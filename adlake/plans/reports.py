"""Dashboard queries over the Gold and Ops tables."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlake.functions.exprs import as_date
from adlake.operators.dedup import latest_per_key
from adlake.operators.filters import trailing
from adlake.operators.kpis import COUNTERS, with_ratios

SKETCH_ACCURACY = 10_000  # ranks are wrong by at most rows / accuracy
MEASURES = [*COUNTERS, "conversion_rate", "cost_per_attributed_conversion"]


def campaign_daily(daily: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Campaigns by day, last 30 days."""
    recent = trailing(daily, "event_date", timedelta(days=30), as_of)
    return recent.select("event_date", "campaign_id", *MEASURES)


def campaign_hourly(hourly: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Campaigns by hour, last 7 days."""
    recent = trailing(hourly, "event_date", timedelta(days=7), as_of)
    return recent.select("event_date", "event_hour", "campaign_id", *MEASURES)


def hourly_funnel(hourly: DataFrame) -> DataFrame:
    """Counters per hour of day, over all campaigns."""
    totals = hourly.groupBy("event_hour").agg(*[F.sum(c).alias(c) for c in COUNTERS])
    return totals.orderBy("event_hour")


def campaign_totals(daily: DataFrame) -> DataFrame:
    """Counters and ratios per campaign, over all days."""
    totals = daily.groupBy("campaign_id").agg(*[F.sum(c).alias(c) for c in COUNTERS])
    return with_ratios(totals).select("campaign_id", *MEASURES)


def conversion_efficiency(daily: DataFrame, n: int = 20) -> DataFrame:
    """The campaigns with most attributed conversions."""
    order = [F.desc("attributed_conversions"), F.desc("conversions"), F.asc("campaign_id")]
    return campaign_totals(daily).orderBy(*order).limit(n)


def top_spend(daily: DataFrame, day: date | str, n: int = 20) -> DataFrame:
    """The campaigns of a day with most spend."""
    rows = daily.where(F.col("event_date") == F.lit(as_date(day)))
    return rows.select("event_date", "campaign_id", *MEASURES).orderBy(F.desc("spend"), "campaign_id").limit(n)


def health_latest(results: DataFrame) -> DataFrame:
    """The newest result of each health metric."""
    newest = latest_per_key(results, "metric_name", ["run_ts", F.col("query_file").desc_nulls_last()])
    return newest.select("metric_name", "metric_value", "severity", "details", "run_ts")


def streaming_batches(metrics: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Batches of the last six hours in time order."""
    columns = ["metric_ts", "query_name", "batch_id", "row_count", "batch_duration_ms", "status", "detail"]
    recent = trailing(metrics, "metric_ts", timedelta(hours=6), as_of)
    return recent.select(*columns).orderBy("metric_ts", "query_name", "batch_id")


def wasteful_campaigns(daily: DataFrame, spend_q: float = 0.75, rate_q: float = 0.5) -> DataFrame:
    """Campaigns that spend more than a quantile of campaigns and convert less
    than another; a campaign without clicks converts at rate 0.

    The quantiles are exact at any number of campaigns.
    """
    totals = campaign_totals(daily)
    rate = F.coalesce("conversion_rate", F.lit(0.0))
    bounded = totals.withColumns(
        {
            "_spend": exact_quantile(totals.select("spend"), "spend", spend_q).scalar(),
            "_rate": exact_quantile(totals.select(rate.alias("rate")), "rate", rate_q).scalar(),
        }
    )
    return bounded.where((F.col("spend") > F.col("_spend")) & (rate < F.col("_rate"))).drop("_spend", "_rate")


def exact_quantile(rows: DataFrame, name: str, q: float) -> DataFrame:
    """One row: the least value with at least a share ``q`` of values up to it.

    A mergeable sketch brackets the value by ranks at most a few ten-thousandths
    of the rows apart; only distinct values within the bracket are ranked in one
    task, and the rows below it are counted.
    """
    known = rows.where(F.col(name).isNotNull())
    around = [max(q - 2 / SKETCH_ACCURACY, 0.0), min(q + 2 / SKETCH_ACCURACY, 1.0)]
    bracket = known.agg(
        F.struct(F.percentile_approx(name, around, SKETCH_ACCURACY).alias("ends"), F.count("*").alias("rows")).alias("bracket")
    )
    marked = known.withColumn("_bracket", bracket.scalar())
    low, high = F.col("_bracket.ends")[0], F.col("_bracket.ends")[1]
    below = marked.where(F.col(name) < low).agg(F.count("*").alias("below"))
    inside = marked.where(F.col(name).between(low, high)).groupBy(name).agg(F.count("*").alias("_count"), F.first("_bracket.rows").alias("_rows"))
    upto = F.sum("_count").over(Window.orderBy(name)) + F.col("_below")
    ranked = inside.withColumn("_below", below.scalar()).withColumn("_upto", upto)
    return ranked.where(F.col("_upto") >= F.greatest(F.ceil(F.col("_rows") * q), F.lit(1))).agg(F.min(name).alias(name))
