"""Metadata documents beside the data: sidecars, manifests and quality reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks.sources.files import exists

SIDECAR_SCHEMA = (
    "filename string, month string, bytes long, sha256 string, downloaded_at string, "
    "catalogue_url string"
)
MANIFEST_SCHEMA = (
    "pipeline_version string, source_sha256 string, parquet_sha256 string, "
    "source_columns array<string>, rows long, csv_bytes long, gzip_bytes long, "
    "parquet_bytes long, transform_seconds double, completed_at string, run string, month string"
)
QUALITY_SCHEMA = (
    "checked_at string, status string, blocking_errors array<string>, "
    "metrics map<string,string>, policy string, month string"
)


def manifests_path(root: str) -> str:
    return f"{root.rstrip('/')}/data/manifests"


def quality_path(root: str, status: str = "passed") -> str:
    folder = "quality" if status == "passed" else "quality_failed"
    return f"{root.rstrip('/')}/reports/{folder}"


def read_sidecars(spark: SparkSession, raw_folder: str) -> DataFrame:
    """Declared facts of each archive, one JSON document ``<archive>.json`` beside it.

    The month comes from the archive name, so a sidecar needs no field but the digest. A document that
    cannot be read has a ``sidecar_problem`` and stops nothing else.
    """
    documents = (
        spark.read.schema(f"{SIDECAR_SCHEMA}, _corrupt string")
        .options(
            multiLine="true", pathGlobFilter="*.csv.gz.json", mode="PERMISSIVE",
            columnNameOfCorruptRecord="_corrupt",
        )
        .json(raw_folder)
        .withColumn("path", F.regexp_replace(F.col("_metadata.file_path"), r"\.json\z", ""))
    )
    return documents.select(
        F.regexp_extract("path", r"A([0-9]{6})\.csv\.gz\z", 1).alias("month"),
        "path", F.col("bytes").alias("declared_bytes"), F.col("sha256").alias("declared_sha256"),
        F.when(F.col("_corrupt").isNotNull(), "unreadable sidecar").alias("sidecar_problem"),
    )


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    return _read_monthly(spark, manifests_path(root), MANIFEST_SCHEMA)


def read_quality(spark: SparkSession, root: str, status: str = "passed") -> DataFrame:
    return _read_monthly(spark, quality_path(root, status), QUALITY_SCHEMA)


def _read_monthly(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path) if exists(spark, path) else spark.createDataFrame([], schema)

