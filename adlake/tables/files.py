"""The few file-system calls that Spark's reader and writer do not offer."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_path(spark, path))


def make_folder(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).mkdirs(_path(spark, path))


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder, sorted; none when it does not exist."""
    if not exists(spark, path):
        return []
    return sorted(status.getPath().getName() for status in _file_system(spark, path).listStatus(_path(spark, path)))


def matching(spark: SparkSession, pattern: str) -> list:
    """Statuses of the paths a glob names, sorted by path."""
    return _file_system(spark, pattern).globStatus(_path(spark, pattern)) or []


def move(spark: SparkSession, path: str, target: str) -> None:
    _file_system(spark, path).rename(_path(spark, path), _path(spark, target))


def delete(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).delete(_path(spark, path), True)
