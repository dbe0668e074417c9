"""Catalog names over the tables' folders."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType


def bind(spark: SparkSession, name: str, schema: StructType, partitions: list[str], path: str) -> None:
    """Makes ``name`` an external table over a folder of Parquet files.

    A name that was bound to another folder is bound anew; files are never
    touched. A table that the catalog itself keeps is refused.
    """
    if spark.catalog.tableExists(name):
        if spark.catalog.getTable(name).tableType != "EXTERNAL":
            raise ValueError(f"{name} is a table of its own, not a name of a folder")
        spark.sql(f"DROP TABLE {name}")
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}{'' if f.nullable else ' NOT NULL'}" for f in schema)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(partitions)}) LOCATION '{path}'")
    publish(spark, name)


def publish(spark: SparkSession, name: str | None) -> None:
    """Makes the partitions of a name, if there is one, those of its folder."""
    if name and spark.catalog.tableExists(name):
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
        spark.catalog.refreshTable(name)
