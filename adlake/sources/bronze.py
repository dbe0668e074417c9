"""Writer and readers of the Bronze zone.

Each batch has a folder of its own, so a batch written again replaces itself and
nothing else. A folder with Spark's success marker is complete.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from adlake.operators.filters import ingest_date_between
from adlake.schemas import BRONZE_SCHEMA
from adlake.session import CODEC
from adlake.tables import files


def write_bronze(rows: DataFrame, path: str, batch: str) -> int | None:
    """Writes one batch by ingest date and hour and returns its rows; None where
    it is already there, whole. Half a batch is written anew."""
    folder = f"{path}/batch={batch}"
    if files.exists(rows.sparkSession, f"{folder}/_SUCCESS"):
        return None
    written = Observation()
    observed = rows.observe(written, F.count(F.lit(1)).alias("rows"))
    observed.write.mode("overwrite").option("compression", CODEC).partitionBy("ingest_date", "ingest_hour").parquet(folder)
    return written.get["rows"]


def bronze_stream(spark: SparkSession, path: str, max_files: int = 20) -> DataFrame:
    """Bronze as a file stream of at most ``max_files`` files a trigger.

    A batch that is written again after a crash may take files away that the
    stream has listed; their rows come with the new files.
    """
    stream = spark.readStream.schema(BRONZE_SCHEMA).option("maxFilesPerTrigger", max_files).option("ignoreMissingFiles", "true")
    return stream.parquet(path).select(*BRONZE_SCHEMA.names)


def read_bronze(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Bronze rows, optionally within inclusive ingest dates (pruned partitions)."""
    return ingest_date_between(spark.read.schema(BRONZE_SCHEMA).parquet(path).select(*BRONZE_SCHEMA.names), start, end)


def register_bronze(spark: SparkSession, path: str, table: str = "bronze_events") -> None:
    """Bronze as an external SQL table over its folder, with the batch as one
    more column."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in BRONZE_SCHEMA)
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(
        f"CREATE TABLE {table} ({columns}, batch string) USING parquet "
        f"PARTITIONED BY (batch, ingest_date, ingest_hour) LOCATION '{path}'"
    )
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
