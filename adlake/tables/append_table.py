"""Append-only tables of run results."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from adlake.functions.local import local_rows
from adlake.tables import files
from adlake.tables.names import bind, publish


@dataclass
class AppendTable:
    """Rows by date of ``time_column``. Each writer has its own folder, because
    two appends into one folder share a staging area and can undo each other."""

    spark: SparkSession
    path: str
    schema: StructType
    time_column: str
    name: str | None = None  # of a catalog table over the folder, kept current by every write

    def create(self) -> bool:
        """An empty table; False when it is already there."""
        if files.exists(self.spark, self.path):
            return False
        files.make_folder(self.spark, self.path)
        return True

    @property
    def _stored(self) -> StructType:
        return StructType([*self.schema.fields, StructField("writer", StringType()), StructField(self._partition, DateType())])

    def register(self) -> None:
        """Makes ``name`` a table over the folder."""
        bind(self.spark, self.name, self._stored, ["writer", self._partition], self.path)

    @property
    def _partition(self) -> str:
        return f"{self.time_column}_date"

    def append(self, rows: DataFrame, writer: str = "all") -> None:
        body = rows.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema],
            F.to_date(self.time_column).alias(self._partition),
        )
        body.write.mode("append").partitionBy(self._partition).parquet(f"{self.path}/writer={writer}")
        publish(self.spark, self.name)

    def read(self) -> DataFrame:
        """All rows. Filter on ``<time_column>_date`` before selecting to prune
        folders; ``since`` does."""
        return self._scan().select(*self.schema.names)

    def since(self, moment) -> DataFrame:
        """Rows at or after a moment, reading the folders of those days only."""
        bound = F.lit(moment)
        return (
            self._scan()
            .where((F.col(self._partition) >= F.to_date(bound)) & (F.col(self.time_column) >= bound))
            .select(*self.schema.names)
        )

    def _scan(self) -> DataFrame:
        if not files.exists(self.spark, self.path):
            return local_rows(self.spark, [], self._stored)
        return self.spark.read.schema(self._stored).parquet(self.path)


def append_rows(rows: DataFrame, table: AppendTable, writer: str = "all") -> None:
    table.append(rows, writer)
