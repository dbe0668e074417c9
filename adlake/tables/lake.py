"""The lake: where each table lives, and how a new one is set up."""

from __future__ import annotations

from dataclasses import dataclass
from string import Template

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from adlake.schemas import (
    BATCH_METRIC_SCHEMA,
    BATCH_REJECT_SCHEMA,
    DAILY_SCHEMA,
    GOLD_REBUILD_SCHEMA,
    HEALTH_SCHEMA,
    HOURLY_SCHEMA,
    SILVER_SCHEMA,
    TOPIC_OFFSET_SCHEMA,
)
from adlake.sources.bronze import register_bronze
from adlake.tables.append_table import AppendTable
from adlake.tables.upsert_table import UpsertTable

NAMESPACES = """
CREATE NAMESPACE IF NOT EXISTS ${silver_db};
CREATE NAMESPACE IF NOT EXISTS ${gold_db};
CREATE NAMESPACE IF NOT EXISTS ${ops_db};
"""


def run_ddl(spark: SparkSession, text: str, **values: str) -> None:
    """Runs ``;``-separated statements after filling in ``${name}`` values."""
    for statement in Template(text).substitute(values).split(";"):
        if statement.strip():
            spark.sql(statement)


@dataclass
class Lake:
    spark: SparkSession
    root: str
    silver_db: str = "ad_silver"
    gold_db: str = "ad_gold"
    ops_db: str = "ad_ops"

    @classmethod
    def unnamed(cls, spark: SparkSession, root: str) -> Lake:
        """A lake that keeps out of the catalog: tables by path alone."""
        return cls(spark, root, "", "", "")

    def named(self, database: str, table: str) -> str | None:
        return f"{database}.{table}" if database else None

    @property
    def bronze_path(self) -> str:
        return f"{self.root}/bronze/ad_events"

    def checkpoint(self, query: str) -> str:
        return f"{self.root}/checkpoints/{query}"

    @property
    def silver(self) -> UpsertTable:
        name = self.named(self.silver_db, "events")
        return UpsertTable(self.spark, f"{self.root}/silver/events", SILVER_SCHEMA, ["event_id"], name=name)

    @property
    def landing_path(self) -> str:
        """Parsed batches by status; the rejected rows stay."""
        return f"{self.root}/silver/landing"

    @property
    def hourly(self) -> UpsertTable:
        keys = ["event_date", "event_hour", "campaign_id"]
        name = self.named(self.gold_db, "campaign_hourly_kpis")
        return UpsertTable(self.spark, f"{self.root}/gold/campaign_hourly_kpis", HOURLY_SCHEMA, keys, name=name)

    @property
    def daily(self) -> UpsertTable:
        keys = ["event_date", "campaign_id"]
        name = self.named(self.gold_db, "campaign_daily_kpis")
        return UpsertTable(self.spark, f"{self.root}/gold/campaign_daily_kpis", DAILY_SCHEMA, keys, name=name)

    def _ops(self, table: str, schema: StructType, time_column: str) -> AppendTable:
        return AppendTable(self.spark, f"{self.root}/ops/{table}", schema, time_column, self.named(self.ops_db, table))

    @property
    def batch_metrics(self) -> AppendTable:
        return self._ops("streaming_batch_metrics", BATCH_METRIC_SCHEMA, "metric_ts")

    @property
    def health_results(self) -> AppendTable:
        return self._ops("health_check_results", HEALTH_SCHEMA, "run_ts")

    @property
    def batch_rejects(self) -> AppendTable:
        """Good and rejected rows of each Silver batch."""
        return self._ops("streaming_batch_rejects", BATCH_REJECT_SCHEMA, "metric_ts")

    @property
    def topic_offsets(self) -> AppendTable:
        """Where each topic partition ends and how far a query has read it."""
        return self._ops("streaming_topic_offsets", TOPIC_OFFSET_SCHEMA, "metric_ts")

    @property
    def gold_rebuilds(self) -> AppendTable:
        """Batches of Silver's change feed that Gold has taken in."""
        return self._ops("gold_rebuilds", GOLD_REBUILD_SCHEMA, "rebuilt_at")

    def upsert_tables(self) -> dict[str, UpsertTable]:
        return {"silver": self.silver, "hourly": self.hourly, "daily": self.daily}

    def append_tables(self) -> list[AppendTable]:
        return [self.batch_metrics, self.health_results, self.batch_rejects, self.topic_offsets, self.gold_rebuilds]


def bootstrap(spark: SparkSession, root: str, bronze_table: str | None = None, named: bool = True, **names: str) -> Lake:
    """Namespaces, empty tables and their catalog names. Safe to run again: it
    changes no row then.

    The names are bound to this lake, also where they named another lake's
    tables before; that lake's files stay. With ``named`` false, the catalog
    is left alone and tables are found by path.
    """
    root = root.rstrip("/")
    lake = Lake(spark, root, **names) if named else Lake.unnamed(spark, root)
    if named:
        run_ddl(spark, NAMESPACES, silver_db=lake.silver_db, gold_db=lake.gold_db, ops_db=lake.ops_db)
    for table in [*lake.upsert_tables().values(), *lake.append_tables()]:
        table.create()
        if named:
            table.register()
    if bronze_table:
        register_bronze(spark, lake.bronze_path, bronze_table)
    return lake
