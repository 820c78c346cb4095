"""Session defaults for local runs and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession


# Wide projections and aggregates compile to methods longer than HotSpot will optimise, and then run
# interpreted. From this size on Spark splits them instead. It is a session setting; clusters that
# run the wide jobs (cleaning, profiles, publication) should have it too.
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")


@contextmanager
def small_methods(spark: SparkSession):
    """Run actions with the method limit, then restore the session as it was."""
    key, value = METHOD_LIMIT
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def settings(spark: SparkSession, **values: str):
    """Run actions with session settings, dots written as double underscores, then restore the session."""
    keys = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def open_writers(spark: SparkSession, most: int):
    """Run writes that keep up to ``most`` files open in a task; beyond them Spark sorts the rest by folder."""
    return settings(spark, spark__sql__maxConcurrentOutputFileWriters=str(most))


def freed_shuffles(spark: SparkSession):
    """Run actions whose shuffle files go when they end; elsewhere the files stay until Spark's cleaner comes."""
    return settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true")


def local_session(cores: int | str = 8, **conf: str) -> SparkSession:
    """A local session for tests and benches; clusters bring their own session and settings."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("claimworks")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config(*METHOD_LIMIT)
        .config("spark.driver.memory", "16g")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_scratch() -> str:
    """One temporary folder for this process, removed when it ends."""
    folder = tempfile.mkdtemp(prefix="claimworks-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder for intermediate tables, in the shared folder of the cluster.

    The shared folder is ``spark.checkpoint.dir``. Only a local master may go without it: there
    driver and executors see the same disk.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = _local_scratch()
    return os.path.join(shared, "claimworks", f"{label}-{uuid.uuid4().hex}")


def drop_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder of this package's own intermediate tables, in whatever store it lies."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
