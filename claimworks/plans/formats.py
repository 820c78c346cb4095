"""The same aggregate over the same rows in two storage formats."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks.operators.aggregates import count_and_sum, first_rows
from claimworks.operators.report_tables import bench_summary
from claimworks.plans.publish import ZSTD
from claimworks.sources.archives import CSV_TEXT, read_typed_csv
from claimworks.sources.curated import PARTITION

# The columns and the aggregate that are compared.
COLUMNS = ["BEN_RES_REG", "PRS_NAT", "FLT_REM_MNT", "FLT_PAI_MNT"]
SAMPLE_SCHEMA = (
    "BEN_RES_REG string, PRS_NAT string, FLT_REM_MNT decimal(24,6), FLT_PAI_MNT decimal(24,6)"
)
KEY, VALUE = "BEN_RES_REG", "FLT_REM_MNT"
MEASUREMENTS = "mode string, repeat int, seconds double"


def write_both(df: DataFrame, folder: str) -> dict[str, str]:
    """The same rows as CSV and as Parquet; returns the folder of each."""
    paths = {"csv": f"{folder}/sample_csv", "parquet": f"{folder}/sample_parquet"}
    df.write.mode("overwrite").options(**ZSTD).parquet(paths["parquet"])
    written = df.sparkSession.read.schema(df.schema).parquet(paths["parquet"])
    written.write.mode("overwrite").options(**CSV_TEXT).csv(paths["csv"])
    return paths


def read_both(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    return {
        "csv": read_typed_csv(spark, paths["csv"], SAMPLE_SCHEMA),
        "parquet": spark.read.parquet(paths["parquet"]),
    }


def format_equivalence(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """``(key, csv_n, csv_total, parquet_n, parquet_total, equal)`` for each group."""
    read = read_both(spark, paths)
    sides = [
        count_and_sum(read[name], KEY, VALUE).select(
            F.col("key").alias(f"{name}_key"), F.col("n").alias(f"{name}_n"),
            F.col("total").alias(f"{name}_total"),
        )
        for name in ("csv", "parquet")
    ]
    same_key = F.col("csv_key").eqNullSafe(F.col("parquet_key"))
    return sides[0].join(sides[1], same_key, "full_outer").select(
        F.coalesce("csv_key", "parquet_key").alias("key"),
        "csv_n", "csv_total", "parquet_n", "parquet_total",
        (F.col("csv_n").eqNullSafe(F.col("parquet_n"))
         & F.col("csv_total").eqNullSafe(F.col("parquet_total"))).alias("equal"),
    )


def compare_formats(
    spark: SparkSession, claims: DataFrame, folder: str, rows: int | None = None, repeats: int = 3
) -> tuple[DataFrame, DataFrame]:
    """Write both formats, check equality, then time each: ``(measurements, summary)``.

    The whole table is compared, or the first ``rows`` rows where a sample is asked for; ``claims``
    has the month partition column, which orders the sample. Each format is read once before it is
    timed.
    """
    if (rows is not None and rows < 1) or repeats < 1:
        raise ValueError("rows and repeats must be at least 1")
    sample = claims.select(PARTITION, *COLUMNS)
    if rows is not None:
        sample = first_rows(sample, rows, PARTITION, F.xxhash64(*COLUMNS))
    sample = sample.select(*COLUMNS)
    paths = write_both(sample, folder)
    content = spark.read.parquet(paths["parquet"]).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(VALUE).isNull()).alias("nulls")
    ).first()
    if content["n"] == 0 or content["nulls"]:
        raise ValueError("the comparison needs rows, and a reimbursement in each")
    if format_equivalence(spark, paths).where(~F.col("equal")).count():
        raise AssertionError("the formats give different results")
    timed = []
    for repeat in range(repeats + 1):
        for mode in ("csv", "parquet"):
            started = time.perf_counter()
            count_and_sum(read_both(spark, paths)[mode], KEY, VALUE).write.format("noop").mode(
                "overwrite"
            ).save()
            if repeat:
                timed.append((f"spark_{mode}", repeat, time.perf_counter() - started))
    measurements = spark.createDataFrame(timed, MEASUREMENTS)
    summary = bench_summary(measurements)
    write_summary(summary, folder)
    return measurements, summary


def write_summary(summary: DataFrame, folder: str) -> None:
    """The timing summary as CSV and as JSON."""
    rows = summary.orderBy("mode")
    rows.write.mode("overwrite").options(**CSV_TEXT).csv(f"{folder}/summary_csv")
    rows.write.mode("overwrite").json(f"{folder}/summary_json")


def read_summary(spark: SparkSession, folder: str) -> DataFrame:
    schema = "mode string, median_seconds double, min_seconds double, max_seconds double"
    return spark.read.schema(schema).json(f"{folder}/summary_json")
