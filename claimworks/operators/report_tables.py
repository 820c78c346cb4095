"""Tables a report needs; no rendering."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimworks.functions import total
from claimworks.operators.aggregates import exact_median
from claimworks.operators.labels import with_labels


def top_totals(
    groups: DataFrame, labels: DataFrame, variable: str, code: str, value: str, n: int = 10
) -> DataFrame:
    """``(code, total, label, share)`` of the ``n`` largest totals over all months.

    The share is a percentage of the largest, never negative. Ties fall to the smaller code.
    """
    summed = groups.groupBy(F.col(code).alias("code")).agg(total(value).alias("total"))
    top = summed.orderBy(F.col("total").desc_nulls_last(), F.col("code").asc_nulls_last()).limit(n)
    # The window sees at most n rows.
    largest = F.max("total").over(Window.partitionBy())
    base = F.when(F.coalesce(largest, F.lit(0)) == 0, F.lit(1)).otherwise(largest).cast("double")
    share = F.greatest(F.lit(0.0), F.col("total").cast("double") / base * 100)
    named = with_labels(
        top.withColumn("share", F.round(share, 2)), labels, variable, "code", "label",
        default=F.concat(F.lit("Code "), F.coalesce("code", F.lit(""))),
    )
    # A shuffle join returns the few rows in any order.
    return named.select("code", "total", "label", "share").orderBy(
        F.col("total").desc_nulls_last(), F.col("code").asc_nulls_last()
    )


def kpis(manifests: DataFrame, monthly: DataFrame, amount: str) -> DataFrame:
    """One row: rows, sizes, their ratio, months and the total amount.

    Manifests have one row per month, so the list of months stays short.
    """
    both = manifests.select("month", "rows", "csv_bytes", "parquet_bytes").unionByName(
        monthly.select(F.col(amount).alias("amount")), allowMissingColumns=True
    )
    ratio = F.sum("csv_bytes") / F.nullif(F.sum("parquet_bytes"), F.lit(0))
    return both.agg(
        F.sum("rows").alias("rows"),
        F.sum("csv_bytes").alias("csv_bytes"),
        F.sum("parquet_bytes").alias("parquet_bytes"),
        F.round(ratio, 2).alias("csv_to_parquet"),
        F.array_join(F.sort_array(F.collect_list("month")), ", ").alias("months"),
        total("amount").alias("amount"),
    )


QUALITY_COUNTS = (
    "negative_reimbursement_rows", "unknown_reimbursement_type_rows", "missing_act_count_rows",
    "region_code_99_rows",
)


def quality_rollup(profiles: DataFrame) -> DataFrame:
    """The counts a report shows, over all months."""
    return profiles.agg(*[F.sum(c).cast("long").alias(c) for c in QUALITY_COUNTS])


def bench_summary(measurements: DataFrame, mode: str = "mode", seconds: str = "seconds") -> DataFrame:
    """Median, minimum and maximum time of each mode."""
    return exact_median(measurements, mode, seconds).select(
        mode, F.col("median").alias("median_seconds"), F.col("min").alias("min_seconds"),
        F.col("max").alias("max_seconds"),
    )
