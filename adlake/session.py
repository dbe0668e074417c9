"""Spark session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

CODEC = "zstd"  # of the library's tables, in whatever session

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": CODEC,
    "spark.sql.streaming.metricsEnabled": "true",
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Session with the project defaults; ``settings`` use ``__`` for dots.

    Shuffle width, broadcast limit and executor sizes stay with the cluster:
    AQE coalesces from whatever initial width is configured there.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in DEFAULTS.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def _run_folder(spark: SparkSession, shared: str) -> str:
    """What one application keeps in the shared folder."""
    return f"{shared.rstrip('/')}/adlake-{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Removes what this application's queries left in the shared folder. Call it
    when their results are written or read; frames not yet read lose their input."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        path = spark._jvm.org.apache.hadoop.fs.Path(_run_folder(spark, shared))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared ``spark.checkpoint.dir``.

    Only a session without that setting on a local master (a test) falls back
    to a temporary folder of this machine, removed when the process ends; on a
    cluster its executors would not share it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{_run_folder(spark, shared)}/{name}-{uuid.uuid4().hex}"
    if not spark.conf.get("spark.master", "local").startswith("local") or spark.conf.get("spark.master").startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix=f"{name}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder
