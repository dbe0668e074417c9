"""A keyed table on Spark's own Parquet writer, for installations without a
row-level table format (where one exists, use ``operators.upsert.merge_into``).

The table is a folder of Parquet files by date. An upsert rewrites the dates it
touches, and no others, by a dynamic partition overwrite: dates of the batch, and
dates that hold an earlier row of one of its keys. The latter come from a scan of
keys and dates alone, which a Bloom filter of the batch's keys thins out before
it is shuffled. A batch of new keys alone rewrites nothing: its rows are appended.

What an upsert changes is kept as a *change feed*: a row per batch and pair of
old and new date. It is written before any date is, so that a batch repeated
after a crash rewrites the same dates and ends in the same rows.

Limits: one writer at a time, and readers should not run through a write's last
moments, when Spark replaces the dates' folders one by one by a delete and a
rename. A driver that dies between the two leaves a date's new files in Spark's
staging folder; the next write moves them into place first.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StringType, StructField, StructType, TimestampType

from adlake.functions.exprs import as_date, utc_now
from adlake.functions.local import local_rows
from adlake.operators.key_filter import buckets_for, cannot_hold, key_filter, may_hold
from adlake.operators.upsert import merge_frames
from adlake.session import CODEC
from adlake.tables import files
from adlake.tables.names import bind, publish

STAGING = ".spark-staging-"  # Fixed value: how Spark names its staging folders

CHANGE_SCHEMA = StructType(
    [
        StructField("changed_at", TimestampType()),
        StructField("old_date", DateType()),  # null for an inserted row
        StructField("new_date", DateType()),
        StructField("rows", LongType()),
        StructField("batch", StringType()),
    ]
)


@dataclass(frozen=True)
class Change:
    """What one upsert did: its name in the feed, its rows, and the dates that
    gained or lost rows."""

    batch: str
    rows: int
    dates: frozenset[date]


class UpsertTable:
    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: StructType,
        keys: list[str],
        date_column: str = "event_date",
        cluster_by: str = "campaign_id",
        name: str | None = None,
    ):
        """``name`` is a catalog table over the folder, kept current by every write."""
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.keys = list(keys)
        self.date_column = date_column
        self.cluster_by = cluster_by
        self.name = name

    @property
    def data_path(self) -> str:
        return f"{self.path}/data"

    @property
    def changes_path(self) -> str:
        return f"{self.path}/changes"

    def version_path(self, version: str) -> str:
        return f"{self.path}/versions/{version}"

    def date_dir(self, day: date) -> str:
        return f"{self.data_path}/{self.date_column}={day.isoformat()}"

    def is_created(self) -> bool:
        return files.exists(self.spark, self.data_path)

    def create(self) -> bool:
        """An empty table; False when it is already there."""
        if self.is_created():
            return False
        files.make_folder(self.spark, self.data_path)
        return True

    # -- reading ---------------------------------------------------------

    def dates(self) -> list[date]:
        """The dates that hold rows."""
        prefix = f"{self.date_column}="
        names = files.child_names(self.spark, self.data_path)
        return sorted(date.fromisoformat(name.removeprefix(prefix)) for name in names if name.startswith(prefix))

    def read_dates(self, days: set[date]) -> DataFrame:
        """Rows of some dates; only their folders are listed."""
        folders = [self.date_dir(day) for day in self.dates() if day in days]
        if not folders:
            return local_rows(self.spark, [], self.schema)
        return self.spark.read.schema(self.schema).option("basePath", self.data_path).parquet(*folders).select(*self.schema.names)

    def read(self, start: date | str | None = None, end: date | str | None = None, version: str | None = None) -> DataFrame:
        """The rows, optionally within inclusive dates, or those of a saved version."""
        first, last = start and as_date(start), end and as_date(end)
        if version is None and (first or last):
            rows = self.read_dates({d for d in self.dates() if (not first or d >= first) and (not last or d <= last)})
        else:
            path = self.data_path if version is None else self.version_path(version)
            rows = self.spark.read.schema(self.schema).parquet(path).select(*self.schema.names)
        if first:
            rows = rows.where(F.col(self.date_column) >= F.lit(first))
        if last:
            rows = rows.where(F.col(self.date_column) <= F.lit(last))
        return rows

    def changes(self) -> DataFrame:
        """The change feed: a row per batch, old date and new date."""
        if not files.exists(self.spark, self.changes_path):
            return local_rows(self.spark, [], CHANGE_SCHEMA)
        return self.spark.read.schema(CHANGE_SCHEMA).parquet(self.changes_path)

    def changed_dates(self, batch: str) -> set[date]:
        """Dates that gained or lost rows by a batch; one row per pair is read."""
        folder = f"{self.changes_path}/batch={batch}"
        pairs = self.spark.read.schema(CHANGE_SCHEMA).parquet(folder).select("old_date", "new_date").collect()
        return {day for pair in pairs for day in pair if day is not None}

    # -- writing ---------------------------------------------------------

    def recover(self) -> list[date]:
        """Moves dates that an earlier write deleted but did not replace from its
        staging folder into place, and returns them.

        A date is deleted only once all its new files are staged. A date that
        the table never had may come with part of its batch; the batch, which
        then comes again, replaces these rows by key.
        """
        moved, held = [], set(self.dates())
        for status in files.matching(self.spark, f"{self.data_path}/{STAGING}*"):
            folder = status.getPath().toString()
            for name in files.child_names(self.spark, folder):
                day = name.removeprefix(f"{self.date_column}=")
                if day != name and date.fromisoformat(day) not in held:
                    files.move(self.spark, f"{folder}/{name}", f"{self.data_path}/{name}")
                    moved.append(date.fromisoformat(day))
            files.delete(self.spark, folder)
        return moved

    def conform(self, df: DataFrame) -> DataFrame:
        """Columns in table order and type; a NULL in a required one fails the write."""
        columns = []
        for f in self.schema:
            value = F.col(f.name).cast(f.dataType)
            if not f.nullable:
                value = F.coalesce(value, F.raise_error(F.lit(f"{f.name} must not be NULL")).cast(f.dataType))
            columns.append(value.alias(f.name))
        return df.select(*columns)

    def earlier_rows(self, batch: DataFrame, rows: int, filters: DataFrame | None = None) -> DataFrame:
        """``(keys, old_date)`` of the rows that ``batch`` may replace.

        The scan reads keys and dates alone. Rows that fail the filter of the
        batch's keys never reach the join's shuffle; a batch too large for a
        filter of bounded size is joined without.
        """
        held = self.read().select(*self.keys, F.col(self.date_column).alias("old_date"))
        buckets = buckets_for(rows)
        if not buckets:
            return held
        return may_hold(held, self.keys, key_filter(batch, self.keys, buckets) if filters is None else filters, buckets)

    def moves(self, batch: DataFrame, rows: int, filters: DataFrame | None = None) -> DataFrame:
        """Rows of ``batch`` by the date that holds the key now and the new one."""
        new = F.col(self.date_column).alias("new_date")
        if self.date_column in self.keys or not self.dates():
            # A key cannot change its date, or has none yet, so the batch alone tells.
            pairs = batch.select(F.lit(None).cast("date").alias("old_date"), new)
        else:
            pairs = batch.select(*self.keys, new).join(self.earlier_rows(batch, rows, filters), self.keys, "left")
        return pairs.groupBy("old_date", "new_date").agg(F.count("*").alias("rows"))

    def _record(self, batch: DataFrame, rows: int, name: str, filters: DataFrame | None) -> tuple[set[date], bool]:
        """Writes what the batch will change, unless an earlier run of it did,
        and returns the dates, and whether the table holds none of its keys.
        Of a batch that comes again nobody knows: it may have left rows."""
        folder = f"{self.changes_path}/batch={name}"
        if files.exists(self.spark, f"{folder}/_SUCCESS"):
            return self.changed_dates(name), False
        # One row per pair of dates.
        found = self.moves(batch, rows, filters).collect()
        moment = utc_now()
        pairs = local_rows(self.spark, [(moment, *pair) for pair in found], StructType(CHANGE_SCHEMA.fields[:-1]))
        pairs.coalesce(1).write.mode("overwrite").parquet(folder)
        dates = {day for pair in found for day in (pair["old_date"], pair["new_date"]) if day is not None}
        return dates, self.date_column not in self.keys and all(pair["old_date"] is None for pair in found)

    def merged(self, days: set[date], batch: DataFrame, rows: int, filters: DataFrame | None) -> DataFrame:
        """The rows of some dates with those of ``batch`` in place. Rows that
        fail the filter of the batch's keys stay without being joined."""
        held = self.read_dates(days)
        if filters is None:
            return merge_frames(held, batch, self.keys)
        buckets = buckets_for(rows)
        near, far = may_hold(held, self.keys, filters, buckets), cannot_hold(held, self.keys, filters, buckets)
        # Catalyst would move an anti-join below the filter, where it shuffles all rows.
        marked = near.join(batch.select(*self.keys, F.lit(True).alias("_replaced")), self.keys, "left")
        kept = marked.where(F.col("_replaced").isNull()).select(*held.columns)
        return far.unionByName(kept).unionByName(batch.select(*held.columns))

    def batch_filter(self, batch: DataFrame, rows: int) -> DataFrame | None:
        """The cached filter of a batch's keys; None where there is none or no need."""
        buckets = 0 if self.date_column in self.keys or not self.dates() else buckets_for(rows)
        return key_filter(batch, self.keys, buckets).persist(StorageLevel.MEMORY_AND_DISK) if buckets else None

    def upsert(self, source: DataFrame, batch: str | None = None, unique: bool = False, stored: int | None = None) -> Change:
        """Updates or inserts rows by key; ``source`` holds one row per key.

        ``unique`` says that it does by construction; otherwise it is counted
        first, and a source that repeats a key is refused before anything is
        written, as a merge would. A named ``batch`` that comes again, whole or
        after a crash, ends in the same rows.

        ``stored`` is the number of rows of a unique source that lies on storage:
        each step reads the columns it needs from there, and nothing is cached.
        """
        name = batch or uuid.uuid4().hex
        self.recover()
        rows = self.conform(source)
        if stored is None:
            rows.persist(StorageLevel.MEMORY_AND_DISK)
        filters = None
        try:
            if stored is not None:
                count = stored
            elif unique:
                count = rows.count()
            else:
                counts = rows.groupBy(*self.keys).agg(F.count("*").alias("n"))
                count, most = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.max("n")).first()
                if count and most > 1:
                    raise ValueError(f"the source repeats a key ({', '.join(self.keys)})")
            if not count:
                return Change(name, 0, frozenset())
            filters = self.batch_filter(rows, count)
            touched, new = self._record(rows, count, name, filters)
            if new:
                self._append(rows)
            else:
                self._overwrite(self.merged(touched, rows, count, filters), touched)
            return Change(name, count, frozenset(touched))
        finally:
            if filters is not None:
                filters.unpersist()
            if stored is None:
                rows.unpersist()

    def replace_dates(self, rows: DataFrame, days: set[date]) -> None:
        """Makes ``rows`` the whole content of ``days``; keys gone from them disappear."""
        self.recover()
        day = F.col(self.date_column)
        inside = F.when(day.isin(sorted(days)), day).otherwise(F.raise_error(F.lit("a row outside the replaced dates")).cast("date"))
        self._overwrite(self.conform(rows).withColumn(self.date_column, inside), set(days))

    def rewrite_dates(self, files_per_date: dict[date, int]) -> None:
        """The same rows of some dates in so many files each."""
        self._overwrite(self.read_dates(set(files_per_date)), set(files_per_date), files_per_date)

    def _overwrite(self, rows: DataFrame, days: set[date], files_per_date: dict[date, int] | None = None) -> None:
        """Replaces the content of ``days``. Dates left without rows are removed
        last, so that no row is missing meanwhile."""
        before = {day: files.child_names(self.spark, self.date_dir(day)) for day in self.dates() if day in days}
        self._write(self._spread(rows, files_per_date), "overwrite")
        for day, names in before.items():
            if files.child_names(self.spark, self.date_dir(day)) == names:  # nothing replaced them
                files.delete(self.spark, self.date_dir(day))
        publish(self.spark, self.name)

    def _append(self, rows: DataFrame) -> None:
        """Adds files with ``rows`` to their dates; none is rewritten."""
        self._write(self._spread(rows, None), "append")
        publish(self.spark, self.name)

    def _write(self, rows: DataFrame, mode: str) -> None:
        order = [self.date_column] + ([self.cluster_by] if self.cluster_by else [])
        (
            rows.sortWithinPartitions(*order)
            .select(*self.schema.names)
            .write.mode(mode)
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", CODEC)
            .partitionBy(self.date_column)
            .parquet(self.data_path)
        )

    def _spread(self, rows: DataFrame, files_per_date: dict[date, int] | None) -> DataFrame:
        """Rows in partitions of about one file each, a large date in several.

        With known file counts, a date is cut by key hash. Without them AQE
        cuts and joins partitions by the sizes it sees.
        """
        if files_per_date is None:
            return rows.hint("rebalance", self.date_column)
        # One row per date.
        counts = local_rows(self.spark, list(files_per_date.items()), StructType([StructField(self.date_column, DateType()), StructField("_files", IntegerType())]))
        slot = F.pmod(F.xxhash64(*self.keys), F.coalesce("_files", F.lit(1)))
        return (
            rows.join(F.broadcast(counts), self.date_column, "left")
            .withColumn("_slot", slot)
            .repartition(max(1, sum(files_per_date.values())), self.date_column, "_slot")
        )

    def save_version(self, version: str) -> None:
        """Keeps a copy of the rows as they are, to read with ``version``."""
        self.read().write.partitionBy(self.date_column).parquet(self.version_path(version))

    # -- the catalog -----------------------------------------------------

    def register(self) -> None:
        """Makes ``name`` a table over the folder."""
        bind(self.spark, self.name, self.schema, [self.date_column], self.data_path)
