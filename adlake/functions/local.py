"""A few rows that the driver holds, as a frame."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

ARROW = {
    "string": pa.string(),
    "bigint": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "date": pa.date32(),
    "timestamp": pa.timestamp("us", "UTC"),
}


def local_rows(spark: SparkSession, rows: Sequence[Sequence], schema: StructType) -> DataFrame:
    """The rows as a local relation: no task runs Python to make them."""
    columns = list(zip(*rows)) or [()] * len(schema)
    arrays = [pa.array(list(column), ARROW[field.dataType.simpleString()]) for column, field in zip(columns, schema)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema.names), schema)
