"""The same results as SQL over the same tables, for an independent engine."""

from __future__ import annotations

AD = """
ad AS (
  SELECT event_id AS seq,
    sha256(concat_ws('|', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR))) AS event_id,
    ts AS event_time, CAST(ts AS DATE) AS event_date, CAST(hour(ts) AS INT) AS event_hour, user_id,
    CAST(json_extract_string(props, '$.k') AS BIGINT) % 20 AS campaign_id,
    CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS click,
    CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS conversion,
    CASE WHEN event_type = 'purchase' AND user_id % 2 = 0 THEN 1 ELSE 0 END AS attribution,
    value / 1000 AS cost
  FROM events)"""

COUNTERS = """
    CAST(count(*) AS BIGINT) AS events, CAST(sum(click) AS BIGINT) AS clicks,
    CAST(sum(conversion) AS BIGINT) AS conversions,
    CAST(sum(attribution) AS BIGINT) AS attributed_conversions, sum(cost) AS spend"""

SUMMED = """
    CAST(sum(events) AS BIGINT) AS events, CAST(sum(clicks) AS BIGINT) AS clicks,
    CAST(sum(conversions) AS BIGINT) AS conversions,
    CAST(sum(attributed_conversions) AS BIGINT) AS attributed_conversions, sum(spend) AS spend"""


def hourly(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT event_date, event_hour, campaign_id, {COUNTERS}, avg(cost) AS avg_event_cost
  FROM {source} GROUP BY event_date, event_hour, campaign_id)"""


def daily(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT event_date, campaign_id, {SUMMED} FROM {source} GROUP BY event_date, campaign_id)"""


HOURLY = hourly("hourly", "ad")
DAILY = daily("daily", "hourly")

DATE = "CAST(event_date AS VARCHAR) AS event_date"
RATES = """
  round(CAST(conversions AS DOUBLE) / nullif(clicks, 0) + 1e-9, 6) AS conversion_rate,
  round(spend / nullif(attributed_conversions, 0) + 1e-9, 6) AS cost_per_attributed_conversion"""
RATIOS = f"round(CAST(clicks AS DOUBLE) / nullif(events, 0) + 1e-9, 6) AS ctr_proxy, {RATES}"
MEASURES = "events, clicks, conversions, attributed_conversions, round(spend + 1e-9, 6) AS spend"
HOURLY_OUT = f"{DATE}, event_hour, campaign_id, {MEASURES}, round(avg_event_cost + 1e-9, 6) AS avg_event_cost, {RATIOS}"
DAILY_OUT = f"{DATE}, campaign_id, {MEASURES}, {RATIOS}"

SRC = """
raw AS (
  SELECT *, epoch_us(ts) // 1000000 - 1704067200 AS sec,
    CAST(json_extract_string(props, '$.k') AS BIGINT) % 20 AS camp FROM events),
src AS (
  SELECT event_id + 1 AS line_number, sec AS source_timestamp, user_id, camp AS campaign_id,
    CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS conversion,
    CASE WHEN event_type = 'purchase' THEN sec + event_id % 86400 ELSE -1 END AS conversion_timestamp,
    CASE WHEN event_type = 'purchase' THEN event_id ELSE -1 END AS conversion_id,
    CASE WHEN event_type = 'purchase' AND user_id % 2 = 0 THEN 1 ELSE 0 END AS attribution,
    CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS click,
    CAST(CASE WHEN event_type = 'click' THEN event_id % 10 ELSE -1 END AS INT) AS click_pos,
    CAST(CASE WHEN event_type = 'click' THEN event_id % 10 + 1 ELSE -1 END AS INT) AS click_nb,
    value / 1000 AS cost, value / 100 AS cpo,
    CASE WHEN event_type = 'click' THEN event_id % 5000 ELSE -1 END AS time_since_last_click,
    event_id % 1000 AS cat1, event_id * 2 % 1000 AS cat2, event_id * 3 % 1000 AS cat3, event_id * 4 % 1000 AS cat4,
    event_id * 5 % 1000 AS cat5, event_id * 6 % 1000 AS cat6, event_id * 7 % 1000 AS cat7, event_id * 8 % 1000 AS cat8,
    event_id * 9 % 1000 AS cat9,
    make_timestamp((1704067200 + sec) * 1000000) AS event_time,
    sha256(concat_ws('|', CAST(event_id + 1 AS VARCHAR), CAST(sec AS VARCHAR), CAST(user_id AS VARCHAR),
      CAST(camp AS VARCHAR),
      CAST(CASE WHEN event_type = 'purchase' THEN event_id ELSE -1 END AS VARCHAR),
      CAST(CASE WHEN event_type = 'click' THEN event_id % 10 ELSE -1 END AS VARCHAR))) AS event_id
  FROM raw)"""

SRC_EVENTS = """
sad AS (
  SELECT *, CAST(event_time AS DATE) AS event_date, CAST(hour(event_time) AS INT) AS event_hour FROM src)"""

MICROS = "'%Y-%m-%d %H:%M:%S.%f'"


def silver_out(cost: str, offset: str, source: str = "src", where: str = "true") -> str:
    return f"""
WITH {SRC}
SELECT event_id, strftime(event_time, {MICROS}) AS event_time,
  CAST(CAST(event_time AS DATE) AS VARCHAR) AS event_date, CAST(hour(event_time) AS INT) AS event_hour,
  source_timestamp, user_id, campaign_id, conversion, conversion_timestamp, conversion_id, attribution,
  click, click_pos, click_nb, round({cost} + 1e-9, 6) AS cost, round(cpo + 1e-9, 6) AS cpo, time_since_last_click,
  cat1, cat2, cat3, cat4, cat5, cat6, cat7, cat8, cat9,
  strftime(event_time + INTERVAL 2 SECOND, {MICROS}) AS producer_ingest_ts, 'ad-events' AS kafka_topic, {offset} AS kafka_offset
FROM {source} WHERE {where}"""


COPIED_COST = "CASE WHEN line_number % 10 = 0 THEN cost * 2 ELSE cost END"
COPIED_OFFSET = "CASE WHEN line_number % 10 = 0 THEN line_number + 1000000000 ELSE line_number END"

UPSERTED = f"""
WITH {AD},
source AS (
  SELECT event_id, seq, event_date + 1 AS event_date, event_hour, campaign_id, cost * 2 AS cost
  FROM ad WHERE seq % 2 = 0),
merged AS (
  SELECT * FROM source
  UNION ALL
  SELECT event_id, seq, event_date, event_hour, campaign_id, cost FROM ad
  WHERE seq % 3 <> 0 AND event_id NOT IN (SELECT event_id FROM source))
SELECT event_id, seq, CAST(event_date AS VARCHAR) AS event_date, event_hour, campaign_id,
  round(cost + 1e-9, 6) AS cost
FROM merged"""

GOLD_SIDES = f"""
WITH {AD},
first_days AS (SELECT * FROM ad WHERE event_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-20'),
last_days AS (
  SELECT * FROM ad WHERE seq % 2 = 0 AND event_date BETWEEN DATE '2024-01-15' AND DATE '2024-01-30'),
{hourly("target", "first_days")}, {hourly("source", "last_days")}"""

METRICS = """
metrics AS (
  SELECT ts AS metric_ts,
    CASE WHEN event_id % 2 = 0 THEN 'kafka_to_bronze' ELSE 'bronze_to_silver' END AS query_name,
    event_id AS batch_id, user_id * 10 AS row_count,
    CAST(floor(value * 1000) AS BIGINT) AS batch_duration_ms,
    CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
    CASE WHEN event_type = 'error' THEN props ELSE '' END AS detail
  FROM events)"""

OFFSETS = """
offsets AS (
  SELECT user_id % 6 AS part, max(event_id) AS end_offset,
    CASE WHEN user_id % 6 <> 5 THEN min(event_id) END AS committed_offset
  FROM events GROUP BY user_id % 6)"""

LAG = "CAST(coalesce(sum(greatest(0, end_offset - coalesce(committed_offset, 0))), 0) AS BIGINT)"

FILES = """
files AS (
  SELECT 'data/commit=' || CAST(o_orderkey % 50 AS VARCHAR) || '/part-' || CAST(o_orderkey AS VARCHAR) AS path,
    CAST(floor(o_totalprice * 1000) AS BIGINT) AS length, o_orderdate AS modified, o_orderkey % 50 AS commit,
    CASE WHEN o_orderkey % 4 = 0 THEN 'DELTA' ELSE 'DATA' END AS content
  FROM orders)"""

MIB = 1048576


def delta_count(name: str, where: str) -> str:
    return f"""
SELECT '{name}' AS metric_name, CAST(deltas AS DOUBLE) AS metric_value,
  CASE WHEN deltas > 1000 THEN 'CRITICAL' WHEN deltas > greatest(data, 1) * 0.5 THEN 'WARN' ELSE 'OK' END AS severity
FROM (SELECT count(*) FILTER (content = 'DELTA') AS deltas, count(*) FILTER (content = 'DATA') AS data
      FROM files WHERE {where})"""


def freshness(metric: str, label: str, latest: str, as_of: str, warn: int, critical: int) -> str:
    minutes = f"(epoch_us(TIMESTAMP '{as_of}') // 1000000 - epoch_us(latest) // 1000000) / 60.0"
    return f"""
SELECT '{metric}' AS metric_name, CAST(round(coalesce({minutes}, 999999.0) + 1e-9, 6) AS DOUBLE) AS metric_value,
  CASE WHEN latest IS NULL OR {minutes} > {critical} THEN 'CRITICAL'
       WHEN {minutes} > {warn} THEN 'WARN' ELSE 'OK' END AS severity,
  'max_{label}=' || CAST(latest AS VARCHAR) AS details
FROM ({latest})"""


DAILY_ROWS = """
SELECT 'silver_daily_row_count_min_7d' AS metric_name, CAST(coalesce(low, 0) AS DOUBLE) AS metric_value,
  CASE WHEN days = 0 THEN 'CRITICAL' WHEN low < mean * 0.3 THEN 'WARN' ELSE 'OK' END AS severity,
  'active_days=' || days || ', min_rows=' || low || ', avg_rows=' || CAST(floor(mean) AS BIGINT)
    || ', max_rows=' || high AS details
FROM (SELECT count(*) AS days, min(n) AS low, max(n) AS high, avg(n) AS mean
      FROM (SELECT event_date, count(*) AS n FROM {source} WHERE event_date >= DATE '2024-01-24' GROUP BY event_date))"""

MOVED = f"""
moved AS (
  SELECT * REPLACE (CASE WHEN event_date = DATE '2024-01-05' THEN DATE '2024-01-07' ELSE event_date END AS event_date)
  FROM sad)"""


def oracle() -> dict[str, str]:
    checks = {
        "campaign_hourly_kpis": f"WITH {AD}, {HOURLY} SELECT {HOURLY_OUT} FROM hourly",
        "campaign_daily_kpis": f"WITH {AD}, {HOURLY}, {DAILY} SELECT {DAILY_OUT} FROM daily",
        "gold_hourly_range": f"""WITH {AD}, {HOURLY} SELECT {HOURLY_OUT} FROM hourly
            WHERE event_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""",
        "hourly_unique_users": f"""WITH {AD} SELECT {DATE}, event_hour, campaign_id,
            CAST(count(DISTINCT user_id) AS BIGINT) AS unique_users_exact
            FROM ad GROUP BY ad.event_date, event_hour, campaign_id""",
        "unique_users_hll": f"""WITH {AD} SELECT {DATE}, campaign_id, CAST(count(DISTINCT user_id) AS BIGINT) AS users,
            true AS within_a_twentieth FROM ad WHERE campaign_id IS NOT NULL GROUP BY event_date, campaign_id""",
        "unique_users_estimate": f"""WITH {AD} SELECT {DATE}, CAST(count(DISTINCT user_id) AS BIGINT) AS users,
            true AS within_a_quarter FROM ad GROUP BY ad.event_date""",
        "events_left_out_of_gold": f"""WITH {AD} SELECT {DATE},
            CAST(count(*) AS BIGINT) AS events_without_campaign FROM ad WHERE seq % 7 = 0 GROUP BY ad.event_date""",
        "source_log_lines": f"""WITH {SRC} SELECT line_number, event_id, user_id AS uid, campaign_id AS campaign,
            round(cost + 1e-9, 6) AS cost FROM src WHERE line_number > 100 AND line_number % 9 <> 0""",
        "source_log_first_events": f"""WITH {SRC} SELECT line_number, CAST(user_id AS VARCHAR) AS uid FROM src
            WHERE line_number % 9 <> 0 ORDER BY line_number LIMIT 500""",
        "source_log_events_after": f"""WITH {SRC} SELECT line_number, CAST(user_id AS VARCHAR) AS uid FROM src
            WHERE line_number % 9 <> 0 AND line_number > 400 ORDER BY line_number LIMIT 300""",
        "source_coercion": f"""WITH {SRC} SELECT line_number, user_id AS uid, campaign_id AS campaign,
            round(cost + 1e-9, 6) AS cost, round(cpo + 1e-9, 6) AS cpo, cat9 FROM src
            WHERE line_number % 17 <> 0 AND line_number % 23 <> 0""",
        "source_quarantine": f"""WITH {SRC} SELECT line_number, 'not a number: ' || concat_ws(', ',
            CASE WHEN line_number % 17 = 0 THEN 'uid' END, CASE WHEN line_number % 23 = 0 THEN 'cost' END)
            AS reject_reason FROM src WHERE line_number % 17 = 0 OR line_number % 23 = 0""",
        "event_time_rebase": f"""WITH {SRC} SELECT line_number, source_timestamp,
            strftime(make_timestamp(1700000000250000 + source_timestamp * 1000000), {MICROS}) AS event_time FROM src""",
        "event_identity": f"WITH {SRC} SELECT line_number, event_id FROM src",
        "raw_messages": f"""WITH {SRC} SELECT event_id AS key, event_id,
            strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS event_time, source_timestamp AS timestamp, source_timestamp,
            user_id AS uid, campaign_id AS campaign, CAST(conversion AS BIGINT) AS conversion, conversion_timestamp, conversion_id,
            CAST(attribution AS BIGINT) AS attribution, CAST(click AS BIGINT) AS click, CAST(click_pos AS BIGINT) AS click_pos,
            CAST(click_nb AS BIGINT) AS click_nb, round(cost + 1e-9, 6) AS cost, round(cpo + 1e-9, 6) AS cpo, time_since_last_click,
            cat1, cat2, cat3, cat4, cat5, cat6, cat7, cat8, cat9,
            strftime(event_time + INTERVAL 2 SECOND, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS producer_ingest_ts FROM src""",
        "bronze_projection": f"""SELECT 'ad-events' AS topic, user_id % 6 AS kafka_partition,
            event_id AS kafka_offset, strftime(ts, {MICROS}) AS kafka_timestamp,
            CAST(event_id AS VARCHAR) AS kafka_key, props AS payload, sha256(props) AS payload_hash FROM events""",
        "silver_events": silver_out("cost", "line_number"),
        "payload_rejects": """SELECT event_type, CASE WHEN event_id % 3 = 0 OR event_id % 5 = 0 THEN 'rejected'
            ELSE 'good' END AS kind, CAST(count(*) AS BIGINT) AS rows FROM events GROUP BY 1, 2""",
        "bronze_sql_table": f"""WITH {SRC} SELECT 'ad-events' AS topic,
            CAST(count(*) + count(*) FILTER (line_number % 10 = 0) AS BIGINT) AS messages,
            CAST(count(DISTINCT event_id) AS BIGINT) AS events, max({COPIED_OFFSET}) AS last_offset FROM src""",
        "ingest_date_bounds": f"""WITH {AD} SELECT CAST(event_date AS VARCHAR) AS ingest_date,
            CAST(count(*) AS BIGINT) AS rows FROM ad
            WHERE event_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-07' GROUP BY event_date""",
        "trailing_window": f"""WITH {AD} SELECT event_id, strftime(event_time, {MICROS}) AS event_time FROM ad
            WHERE event_time >= TIMESTAMP '2024-01-29 12:00:00'""",
        "silver_dedup": f"""WITH {AD} SELECT event_id, seq,
            CASE WHEN seq % 10 = 0 THEN seq + 1000000000 ELSE seq END AS kafka_offset,
            round(CASE WHEN seq % 10 = 0 THEN cost * 2 ELSE cost END + 1e-9, 6) AS cost FROM ad""",
        "silver_upsert": UPSERTED,
        "stored_table_upsert": UPSERTED,
        "stored_table_range": f"SELECT * FROM ({UPSERTED}) WHERE event_date BETWEEN '2024-01-10' AND '2024-01-12'",
        "stored_table_folded": UPSERTED,
        "stored_table_maintained": UPSERTED,
        "stored_table_changes": f"""WITH {AD},
            target AS (SELECT event_id, event_date AS d FROM ad WHERE seq % 3 <> 0),
            source AS (SELECT event_id, seq, event_date + 1 AS d FROM ad WHERE seq % 2 = 0),
            first AS (SELECT * FROM source WHERE seq % 4 = 0),
            middle AS (SELECT event_id, d FROM first UNION ALL SELECT * FROM target WHERE event_id NOT IN (SELECT event_id FROM first)),
            pairs AS (
              SELECT 'feed-0' AS batch, t.d AS old_date, f.d AS new_date FROM first f LEFT JOIN target t ON t.event_id = f.event_id
              UNION ALL SELECT 'feed-1', m.d, s.d FROM source s LEFT JOIN middle m ON m.event_id = s.event_id)
            SELECT batch, CAST(old_date AS VARCHAR) AS old_date, CAST(new_date AS VARCHAR) AS new_date, CAST(count(*) AS BIGINT) AS rows
            FROM pairs GROUP BY ALL""",
        "stored_table_earlier_version": f"""WITH {AD} SELECT event_id, seq, {DATE}, event_hour, campaign_id,
            round(cost + 1e-9, 6) AS cost FROM ad WHERE seq % 3 <> 0""",
        "backfill_range": silver_out(
            COPIED_COST, COPIED_OFFSET,
            where="CAST(event_time AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-15'",
        ),
        "gold_hourly_upsert": f"""{GOLD_SIDES}, merged AS (
            SELECT * FROM source UNION ALL
            SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.event_date = t.event_date
              AND s.event_hour = t.event_hour AND s.campaign_id = t.campaign_id))
            SELECT {HOURLY_OUT} FROM merged""",
        "gold_daily_upsert": f"""{GOLD_SIDES}, {daily("dt", "target")}, {daily("ds", "source")}, merged AS (
            SELECT * FROM ds UNION ALL
            SELECT * FROM dt t WHERE NOT EXISTS (SELECT 1 FROM ds s WHERE s.event_date = t.event_date
              AND s.campaign_id = t.campaign_id))
            SELECT {DAILY_OUT} FROM merged""",
        "gold_tables": f"""WITH {SRC}, {SRC_EVENTS}, {hourly("hourly", "sad")}, {DAILY}
            SELECT {DAILY_OUT} FROM daily""",
        "gold_rebuild_after_move": f"""WITH {SRC}, {SRC_EVENTS}, {MOVED}, {hourly("hourly", "moved")}, {DAILY}
            SELECT {DAILY_OUT} FROM daily""",
        "gold_rebuild_of_changes": f"""WITH {SRC}, {SRC_EVENTS}, fed AS (
              SELECT * REPLACE ({COPIED_COST} AS cost, CASE WHEN {COPIED_OFFSET} % 3 = 0 THEN event_date + 1 ELSE event_date END AS event_date)
              FROM sad WHERE event_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-15'),
            {hourly("hourly", "fed")}, {DAILY}
            SELECT {DAILY_OUT} FROM daily""",
        "gold_by_name": f"""WITH {SRC}, {SRC_EVENTS}, {hourly("hourly", "sad")}, {DAILY}
            SELECT {DAILY_OUT} FROM daily""",
        "stream_to_silver": silver_out(COPIED_COST, COPIED_OFFSET),
        "stream_batch_metrics": f"""WITH {SRC}, copied AS (
              SELECT CAST(count(*) + count(*) FILTER (line_number % 10 = 0) AS BIGINT) AS n FROM src)
            SELECT 'bronze_to_silver' AS query_name, 'success' AS status, n AS rows FROM copied
            UNION ALL SELECT 'kafka_to_bronze', 'success', n FROM copied
            UNION ALL SELECT 'kafka_to_bronze', 'failed', CAST(count(*) FILTER (line_number % 4 = 0) AS BIGINT) FROM src""",
        "stream_batch_rejects": f"""WITH {SRC}, numbered AS (
              SELECT line_number % 2 AS batch_id, line_number % CASE WHEN line_number % 2 = 0 THEN 7 ELSE 11 END = 0 AS broken FROM src)
            SELECT 'bronze_to_silver' AS query_name, batch_id, CAST(count(*) FILTER (NOT broken) AS BIGINT) AS good,
              CAST(count(*) FILTER (broken) AS BIGINT) AS rejected FROM numbered GROUP BY batch_id""",
        "stream_dead_letters": f"""WITH {SRC} SELECT 'letters-0' AS batch, 'ad-events' AS kafka_topic, line_number AS kafka_offset,
            '{{' AS payload FROM src WHERE line_number % 7 = 0""",
        "report_campaign_daily": f"""WITH {AD}, {HOURLY}, {DAILY} SELECT {DATE}, campaign_id, {MEASURES}, {RATES}
            FROM daily WHERE daily.event_date >= DATE '2024-01-01'""",
        "report_campaign_hourly": f"""WITH {AD}, {HOURLY} SELECT {DATE}, event_hour, campaign_id, {MEASURES}, {RATES}
            FROM hourly WHERE hourly.event_date >= DATE '2024-01-24'""",
        "report_hourly_funnel": f"""WITH {AD} SELECT event_hour, events, clicks, conversions,
            attributed_conversions, round(spend + 1e-9, 6) AS spend
            FROM (SELECT event_hour, {COUNTERS} FROM ad GROUP BY event_hour)""",
        "report_conversion_efficiency": f"""WITH {AD}, totals AS (
            SELECT campaign_id, {COUNTERS} FROM ad GROUP BY campaign_id)
            SELECT campaign_id, {MEASURES}, {RATES} FROM totals
            ORDER BY totals.attributed_conversions DESC, totals.conversions DESC, campaign_id LIMIT 20""",
        "report_top_spend": f"""WITH {AD}, {HOURLY}, {DAILY} SELECT {DATE}, campaign_id, {MEASURES}, {RATES}
            FROM daily WHERE daily.event_date = DATE '2024-01-15' ORDER BY daily.spend DESC, campaign_id LIMIT 20""",
        "report_wasteful_campaigns": f"""WITH {AD}, totals AS (
            SELECT campaign_id, {COUNTERS}, coalesce(CAST(sum(conversion) AS DOUBLE) / nullif(sum(click), 0), 0) AS rate
            FROM ad GROUP BY campaign_id)
            SELECT campaign_id, {MEASURES}, {RATES} FROM totals
            WHERE totals.spend > (SELECT quantile_disc(spend, 0.25) FROM totals)
              AND rate < (SELECT quantile_disc(rate, 0.75) FROM totals)""",
        "report_streaming_batches": f"""WITH {METRICS} SELECT strftime(metric_ts, {MICROS}) AS metric_ts,
            query_name, batch_id, row_count, batch_duration_ms, status, detail FROM metrics
            WHERE metrics.metric_ts >= TIMESTAMP '2024-01-30 18:00:00'""",
        "latest_per_key": """SELECT user_id, event_id, event_type, round(value + 1e-9, 6) AS value FROM events
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
        "report_health_latest": f"""SELECT metric_name, round(value + 1e-9, 6) AS metric_value, severity, props AS details,
            strftime(run_ts, {MICROS}) AS run_ts
            FROM (SELECT *, 'metric_' || CAST(user_id % 50 AS VARCHAR) AS metric_name,
                CASE WHEN event_type = 'error' THEN 'CRITICAL' ELSE 'OK' END AS severity,
                date_trunc('hour', ts) AS run_ts FROM events)
            QUALIFY row_number() OVER (PARTITION BY metric_name ORDER BY run_ts DESC, event_id DESC) = 1""",
        "health_silver_freshness": f"WITH {AD} " + freshness(
            "silver_freshness_minutes", "event_time", "SELECT max(event_time) AS latest FROM ad",
            "2024-01-31 00:00:00", 10, 30),
        "health_gold_freshness": f"WITH {AD} " + freshness(
            "gold_freshness_minutes", "gold_updated_at", "SELECT max(date_trunc('hour', event_time)) AS latest FROM ad",
            "2024-01-31 00:47:00", 90, 180),
        "health_daily_rows": f"WITH {AD} " + DAILY_ROWS.format(source="ad"),
        "health_duplicates": f"""WITH {AD} SELECT 'silver_duplicate_event_ids_7d' AS metric_name,
            CAST(n AS DOUBLE) AS metric_value, CASE WHEN n > 0 THEN 'CRITICAL' ELSE 'OK' END AS severity,
            'duplicate_event_ids=' || n AS details
            FROM (SELECT count(*) AS n FROM ad WHERE seq % 10 = 0 AND event_date >= DATE '2024-01-24')""",
        "health_batch_duration": f"""WITH {METRICS} SELECT 'streaming_max_batch_duration_ms_15m' AS metric_name,
            CAST(coalesce(longest, 0) AS DOUBLE) AS metric_value,
            CASE WHEN longest > 120000 THEN 'CRITICAL' WHEN longest > 60000 THEN 'WARN' ELSE 'OK' END AS severity,
            'recent_batches=' || n || ', failed_batches=' || CAST(failed AS VARCHAR) AS details
            FROM (SELECT count(*) AS n, max(batch_duration_ms) AS longest,
                CAST(sum(CASE WHEN status <> 'success' THEN 1 ELSE 0 END) AS BIGINT) AS failed
                FROM metrics WHERE metric_ts >= TIMESTAMP '2024-01-30 23:45:00')""",
        "health_avg_file_size": f"""WITH {FILES} SELECT 'silver_avg_file_size_mb' AS metric_name,
            round(coalesce(mean / {MIB}, 0.0) + 1e-9, 6) AS metric_value,
            CASE WHEN n = 0 THEN 'CRITICAL' WHEN mean < 16 * {MIB} THEN 'WARN' ELSE 'OK' END AS severity
            FROM (SELECT count(*) AS n, avg(length) AS mean FROM files WHERE content = 'DATA')""",
        "health_small_file_ratio": f"""WITH {FILES} SELECT 'silver_small_file_ratio' AS metric_name,
            round(coalesce(CAST(small AS DOUBLE) / nullif(n, 0), 0.0) + 1e-9, 6) AS metric_value,
            CASE WHEN n = 0 THEN 'CRITICAL' WHEN CAST(small AS DOUBLE) / n > 0.7 THEN 'WARN' ELSE 'OK' END AS severity,
            'small_files=' || small || ', total_files=' || n AS details
            FROM (SELECT count(*) AS n, count(*) FILTER (length < 32 * {MIB}) AS small
                  FROM files WHERE content = 'DATA')""",
        "health_delta_files": f"WITH {FILES} {delta_count('gold_hourly_delete_file_count', 'true')} UNION ALL "
            + delta_count("gold_daily_delete_file_count", "modified >= TIMESTAMP '1998-01-01'"),
        "health_snapshot_growth": """SELECT 'silver_snapshots_last_24h' AS metric_name,
            CAST(n AS DOUBLE) AS metric_value, CASE WHEN n > 300 THEN 'WARN' ELSE 'OK' END AS severity,
            'latest_snapshot_id=' || latest || ', snapshots_24h=' || n AS details
            FROM (SELECT count(*) AS n, max(event_id) AS latest FROM events WHERE ts >= TIMESTAMP '2024-01-30')""",
        "health_manifest_count": f"""WITH {FILES} SELECT 'silver_manifest_count' AS metric_name,
            CAST(count(*) AS DOUBLE) AS metric_value,
            CASE WHEN count(*) > 1000 THEN 'WARN' ELSE 'OK' END AS severity FROM files""",
        "orphan_files": f"""WITH {FILES} SELECT path, length FROM files
            WHERE commit >= 40 AND modified < TIMESTAMP '1997-01-01'""",
        "scaling_lag": f"WITH {OFFSETS} SELECT {LAG} AS lag FROM offsets",
        "scaling_duration": f"""WITH {METRICS} SELECT CAST(coalesce(max(batch_duration_ms), 0) AS BIGINT) AS duration_ms
            FROM metrics WHERE metric_ts >= TIMESTAMP '2024-01-30 23:45:00'""",
        "scaling_decision": f"""WITH {OFFSETS}, {METRICS},
            lags AS (SELECT {LAG} AS lag FROM offsets),
            durations AS (SELECT CAST(coalesce(max(batch_duration_ms), 0) AS BIGINT) AS duration_ms
                FROM metrics WHERE metric_ts >= TIMESTAMP '2024-01-30 23:45:00'),
            apps AS (SELECT DISTINCT 'app-' || CAST(user_id AS VARCHAR) AS app,
                CAST(user_id % 13 + 1 AS INT) AS current_max,
                (SELECT lag FROM lags) AS lag, (SELECT duration_ms FROM durations) AS duration_ms FROM events),
            graded AS (SELECT *, CASE WHEN lag >= 200000 OR duration_ms >= 1000000 THEN 'scale_up'
                WHEN lag <= 20000 AND duration_ms <= 30000 THEN 'scale_down' ELSE 'hold' END AS reason FROM apps)
            SELECT app, current_max, lag, duration_ms, CAST(CASE reason
                WHEN 'scale_up' THEN least(12, greatest(current_max + 2, 2))
                WHEN 'scale_down' THEN greatest(1, current_max - 1) ELSE current_max END AS INT)
                AS target_max_executors, reason FROM graded""",
        "scaling_of_recorded_lag": """WITH base AS (SELECT *, user_id % 50 AS u FROM events),
            recent AS (SELECT u, event_id % 6 AS part, event_id, epoch_us(TIMESTAMP '2024-01-31') - (event_id % 900) * 1000000 AS moment FROM base WHERE u <= 40),
            newest AS (SELECT * FROM recent QUALIFY row_number() OVER (PARTITION BY u, part ORDER BY moment DESC, event_id DESC) = 1),
            lags AS (SELECT u, CAST(sum(u * 100) AS BIGINT) AS lag FROM newest GROUP BY u),
            apps AS (SELECT DISTINCT u, 'app-' || u AS app, CAST(u % 13 + 1 AS INT) AS current_max, CAST(u % 5 * 10000 AS BIGINT) AS duration_ms FROM base),
            graded AS (SELECT apps.*, lag, CASE WHEN lag >= 15000 OR duration_ms >= 120000 THEN 'scale_up' WHEN lag IS NULL THEN 'unknown_lag'
                WHEN lag <= 6000 AND duration_ms <= 30000 THEN 'scale_down' ELSE 'hold' END AS reason FROM apps LEFT JOIN lags ON lags.u = apps.u)
            SELECT app, current_max, duration_ms, lag, CAST(CASE reason WHEN 'scale_up' THEN least(12, greatest(current_max + 2, 2))
                WHEN 'scale_down' THEN greatest(1, current_max - 1) ELSE current_max END AS INT) AS target_max_executors, reason FROM graded""",
    }
    no_deltas = "0.0, 'OK', 'delete_files=0, data_files=n, delete_file_mb=0.0'"
    results = [
        f"SELECT * FROM ({freshness('silver_freshness_minutes', 'event_time', 'SELECT max(event_time) AS latest FROM sad', '2024-01-31 00:00:00', 10, 30)})",
        f"SELECT * FROM ({DAILY_ROWS.format(source='sad')})",
        "SELECT 'silver_duplicate_event_ids_7d', 0.0, 'OK', 'duplicate_event_ids=0'",
        "SELECT 'streaming_max_batch_duration_ms_15m', 0.0, 'OK', NULL",
        "SELECT 'gold_freshness_minutes', NULL, 'OK', NULL",
        "SELECT 'silver_avg_file_size_mb', NULL, 'WARN', NULL",
        "SELECT 'silver_small_file_ratio', 1.0, 'WARN', NULL",
        "SELECT 'silver_snapshots_last_24h', 1.0, 'OK', NULL",
        "SELECT 'silver_manifest_count', 1.0, 'OK', NULL",
        *[f"SELECT '{name}_delete_file_count', {no_deltas}" for name in ("silver", "gold_hourly", "gold_daily")],
    ]
    files = {
        "silver_freshness_minutes": "silver_freshness",
        "silver_daily_row_count_min_7d": "silver_daily_row_count",
        "silver_duplicate_event_ids_7d": "duplicate_event_id",
        "streaming_max_batch_duration_ms_15m": "streaming_batch_duration",
        "gold_freshness_minutes": "gold_freshness",
        "silver_avg_file_size_mb": "silver_avg_file_size",
        "silver_small_file_ratio": "silver_small_file_ratio",
        "silver_snapshots_last_24h": "snapshot_growth_24h",
        "silver_manifest_count": "manifest_count",
        "silver_delete_file_count": "silver_delete_file_count",
        "gold_hourly_delete_file_count": "gold_delete_file_count",
        "gold_daily_delete_file_count": "gold_delete_file_count",
    }
    file_of = " ".join(f"WHEN '{metric}' THEN '{name}'" for metric, name in files.items())
    checks["health_run"] = (
        f"WITH {SRC}, {SRC_EVENTS} SELECT *, '2024-01-31 00:00:00.000000' AS run_ts, CASE metric_name {file_of} END AS query_file FROM ("
        + " UNION ALL ".join(results) + ")"
    )
    return checks
