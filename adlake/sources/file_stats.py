"""File listing as a relation."""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from adlake.functions.local import local_rows
from adlake.schemas import FILE_STATS_SCHEMA

MOST_TASKS = 256  # folders beyond so many share tasks


class Folders(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class FolderReader(DataSourceReader):
    """Lists folders in tasks, a folder with all below it by one request (or by
    as many as the store's listing has pages), not one per file."""

    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self) -> list[Folders]:
        tasks = max(1, min(MOST_TASKS, len(self.paths)))
        return [Folders(self.paths[at::tasks]) for at in range(tasks)]

    def read(self, partition: Folders) -> Iterator[tuple[str, int, datetime]]:
        from pyarrow import fs

        for path in partition.paths:
            scheme, _, rest = path.partition(":")
            if scheme == "file" or not rest:
                store, folder = fs.LocalFileSystem(), "/" + (rest or scheme).lstrip("/")
            else:
                store, folder = fs.FileSystem.from_uri(path)
            # What vanishes between being listed and being described is left out.
            for info in store.get_file_info(fs.FileSelector(folder, allow_not_found=True, recursive=True)):
                name = info.path.rsplit("/", 1)[-1]
                if info.type == fs.FileType.File and name.endswith(".parquet") and name[0] not in "._":
                    moment = info.mtime or datetime.fromtimestamp(0, timezone.utc)
                    yield info.path, info.size, moment


class FolderListing(DataSource):
    """``format("folder_listing")``: the Parquet files under ``paths``, a JSON list."""

    @classmethod
    def name(cls) -> str:
        return "folder_listing"

    def schema(self) -> str:
        return "path string, length bigint, modificationTime timestamp"

    def reader(self, schema) -> FolderReader:
        return FolderReader(json.loads(self.options["paths"]))


def file_stats(spark: SparkSession, paths: str | list[str], content: str = "DATA") -> DataFrame:
    """One row per Parquet file under the paths. Only the listing is read, a
    folder in one task; a folder or file that is gone gives no row."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        return local_rows(spark, [], FILE_STATS_SCHEMA)
    spark.dataSource.register(FolderListing)
    listing = spark.read.format("folder_listing").option("paths", json.dumps(paths)).load()
    return listing.withColumn("content", F.lit(content))
