"""From Bronze rows to the Silver table: one parse, good and rejected rows told apart."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from adlake.functions.local import local_rows
from adlake.operators.projections import GOOD, REJECTED, newest_events, project_landing
from adlake.schemas import LANDING_SCHEMA, SILVER_COLUMNS
from adlake.session import CODEC
from adlake.tables import files
from adlake.tables.lake import Lake
from adlake.tables.upsert_table import Change


MOST_REPEATED = 1_000_000  # hashes of event ids, 8 MB, the most that is broadcast


@dataclass(frozen=True)
class Landed:
    """A parsed batch on storage and how many of its rows were good and rejected."""

    good: DataFrame
    counts: dict[str, int]


def land(lake: Lake, bronze: DataFrame, batch: str, start: date | str | None = None, end: date | str | None = None) -> Landed:
    """Writes the parsed rows of a batch by status, in one pass that counts them.

    A batch that comes again replaces what an earlier run of it left.
    """
    folder = f"{lake.landing_path}/batch={batch}"
    counts = Observation()
    rows = project_landing(bronze, start, end).observe(
        counts, *[F.count_if(F.col("status") == status).alias(status) for status in (GOOD, REJECTED)]
    )
    rows.write.mode("overwrite").option("compression", CODEC).partitionBy("status").parquet(folder)
    landed = lake.spark.read.schema(LANDING_SCHEMA).parquet(folder)
    return Landed(landed.where(F.col("status") == GOOD), dict(counts.get))


def rejected_rows(lake: Lake) -> DataFrame:
    """Rows that were not events, of all batches: their payload, where it was
    read, and the batch."""
    columns = ["batch", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "bronze_ingest_ts", "payload_hash", "payload"]
    if not files.exists(lake.spark, lake.landing_path):
        return local_rows(lake.spark, [], LANDING_SCHEMA).select(*columns)
    landed = lake.spark.read.schema(LANDING_SCHEMA).parquet(lake.landing_path)
    return landed.where(F.col("status") == REJECTED).select(*columns)


@contextmanager
def single_copies(landed: Landed) -> Iterator[tuple[DataFrame, int | None]]:
    """The newest copy of each event of a landed batch, and how many there are.

    Hashes of ids tell which rows may have copies: those alone are ranked and
    cached, the others stay on storage as they are. Where too many ids repeat for
    a broadcast, all rows are ranked and their number is not known.
    """
    hashed = landed.good.withColumn("_hash", F.xxhash64("event_id"))
    repeated = hashed.groupBy("_hash").agg(F.count("*").alias("_copies")).where("_copies > 1")
    ids, copies = repeated.agg(F.count("*"), F.coalesce(F.sum("_copies"), F.lit(0))).first()
    if not ids:
        yield landed.good.select(*SILVER_COLUMNS), landed.counts[GOOD]
    elif ids > MOST_REPEATED:
        yield newest_events(landed.good), None
    else:
        marked = repeated.select("_hash").persist(StorageLevel.MEMORY_AND_DISK)
        newest = newest_events(hashed.join(F.broadcast(marked), "_hash", "left_semi")).persist(StorageLevel.MEMORY_AND_DISK)
        rest = hashed.join(F.broadcast(marked), "_hash", "left_anti").select(*SILVER_COLUMNS)
        try:
            yield rest.unionByName(newest), landed.counts[GOOD] - copies + newest.count()
        finally:
            newest.unpersist()
            marked.unpersist()


def upsert_events(
    lake: Lake, bronze: DataFrame, batch: str, start: date | str | None = None, end: date | str | None = None
) -> tuple[Change, dict[str, int]]:
    """Upserts the events of Bronze rows into Silver, optionally of some event
    dates, under a batch name. Rejected rows stay in the landing folder; good
    ones leave it once Silver holds them."""
    landed = land(lake, bronze, batch, start, end)
    with single_copies(landed) as (rows, count):
        change = lake.silver.upsert(rows, batch, unique=True, stored=count)
    files.delete(lake.spark, f"{lake.landing_path}/batch={batch}/status={GOOD}")
    return change, landed.counts
