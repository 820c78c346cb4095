"""Published month partitions."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimworks.sources.files import exists
from claimworks.sources.labels import read_labels
from claimworks.sources.metadata import read_manifests

PARTITION = "month"
# Rows with unreadable values lie beside the sound ones, by the names of the damaged columns; only the
# sound part of a month is ever published.
UNREADABLE, SOUND = "unreadable", "none"


def curated_path(root: str) -> str:
    return f"{root.rstrip('/')}/data/curated"


def schema_path(root: str) -> str:
    return f"{root.rstrip('/')}/data/curated_schema"


def current_runs(spark: SparkSession, root: str, months: list[str] | None = None) -> dict[str, str]:
    """The run in which each published month was written, as its manifest says."""
    manifests = read_manifests(spark, root).where(F.col("run").isNotNull())
    if months is not None:
        manifests = manifests.where(F.col(PARTITION).isin(list(months)))
    return {r[PARTITION]: r["run"] for r in manifests.select(PARTITION, "run").collect()}


def month_path(root: str, run: str, month: str) -> str:
    return f"{curated_path(root)}/run={run}/{PARTITION}={month}/{UNREADABLE}={SOUND}"


def record_schema(
    spark: SparkSession, root: str, numeric: Sequence[str], columns: Sequence[str] = ()
) -> None:
    """Write down the columns of all published months and new ones, in order of first position.

    Readers then unite months by name from this one document. Merging footers would open every
    published file for every query. Recorded before the manifests, it is never behind them.
    """
    found = read_manifests(spark, root).select(F.posexplode("source_columns").alias("at", "name"))
    if columns:
        found = found.union(spark.createDataFrame(list(enumerate(columns)), "at int, name string"))
    named = found.groupBy("name").agg(F.min("at").alias("at")).orderBy("at", "name").collect()
    if not named:
        return
    schema = T.StructType([
        T.StructField(
            c["name"], T.DecimalType(24, 6) if c["name"] in numeric else T.StringType()
        )
        for c in named
    ])
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(schema_path(root))


def read_curated(
    spark: SparkSession, root: str, months: list[str] | None = None, keep_month: bool = False
) -> DataFrame:
    """Published months united by column name, each from the run its manifest names.

    The partition column is hidden unless asked for: the table has its own month column.
    """
    if not exists(spark, schema_path(root)):
        raise ValueError(f"no published month under {root}")
    document = spark.read.text(schema_path(root)).first()
    columns = T.StructType.fromJson(json.loads(document["value"]))
    schema = T.StructType(columns.fields)
    for name in ("run", PARTITION, UNREADABLE):
        schema = schema.add(name, T.StringType())
    runs = current_runs(spark, root, months)
    paths = [month_path(root, run, month) for month, run in sorted(runs.items())]
    if paths:
        table = spark.read.schema(schema).option("basePath", curated_path(root)).parquet(*paths)
    else:
        table = spark.createDataFrame([], schema)
    return table.drop("run", UNREADABLE) if keep_month else table.drop("run", UNREADABLE, PARTITION)


def remove_old_runs(spark: SparkSession, root: str) -> None:
    """Delete what no manifest names: months of superseded, failed and unfinished runs.

    Readers of an older run should have ended.
    """
    current = current_runs(spark, root)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    top = hadoop(curated_path(root))
    store = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(top):
        return
    for run in store.listStatus(top):
        name = run.getPath().getName()
        kept = {f"{PARTITION}={m}" for m, r in current.items() if name == f"run={r}"}
        for month in store.listStatus(run.getPath()) if kept else ():
            if month.isDirectory() and month.getPath().getName() not in kept:
                store.delete(month.getPath(), True)
        if not kept:
            store.delete(run.getPath(), True)


def register_views(spark: SparkSession, root: str, months: list[str] | None = None) -> None:
    """Make the published table and the labels available to SQL under their public names."""
    read_curated(spark, root, months).createOrReplaceTempView("remboursements")
    read_labels(spark, f"{root.rstrip('/')}/references").createOrReplaceTempView("nomenclatures")
