"""Reading the sample tables, and intermediate tables in the folder that all executors share."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks.session import scratch_dir

MARK = "#"  # keeps the digest of a text apart from that of another column


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


BATCH_ROWS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


@contextmanager
def small_batches(spark: SparkSession):
    """Run actions with fewer rows per Arrow batch, since rows hold whole texts; then restore."""
    key, value = BATCH_ROWS
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared folder and read back, so that lineage ends here."""
    spark = frame.sparkSession
    path = scratch_dir(spark, label)
    with small_batches(spark):
        frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def digest(*columns) -> list:
    """128 bits in two columns that stand for a row's content; nulls differ from empty texts."""
    parts = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
    return [F.xxhash64(*parts).alias("__k1"), F.xxhash64(F.lit(MARK), *parts).alias("__k2")]
