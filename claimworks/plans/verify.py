"""Reconciliation jobs over published data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks.functions import total, utc_now
from claimworks.operators.fingerprints import group_equality
from claimworks.operators.reconcile import counts_and_sums, raw_amount, reconcile, reconcile_tolerance
from claimworks.schema import CLAIMS, TableSpec
from claimworks.session import freed_shuffles, small_methods
from claimworks.sources.archives import CSV_TEXT, MONTH_IN_PATH, read_archives
from claimworks.sources.curated import PARTITION, read_curated
from claimworks.sources.metadata import read_manifests

REGION_KEYS = ["mois_traitement", "code_region_residence"]
REGION_VALUE = "remboursement_part_legale_eur"


def verify_source(
    spark: SparkSession, root: str, spec: TableSpec = CLAIMS, raw: str | None = None,
    month_in_path: str = MONTH_IN_PATH, archive_glob: str = "A{month}.csv.gz",
) -> DataFrame:
    """Compare archives with published months: row counts and the exact sum of every amount.

    Rows are also compared with the manifests. Returns ``(month, metric, raw, curated, equal,
    checked_at, method)`` and stores it beside the reports. Any difference raises before anything is stored.
    """
    root = root.rstrip("/")
    raw = raw or f"{root}/data/raw"
    manifests = read_manifests(spark, root)
    months = [row["month"] for row in manifests.select("month").collect()]
    if not months:
        raise ValueError(f"no published month under {root}")
    amounts = list(spec.money)
    archives = [f"{raw}/{archive_glob.format(month=m)}" for m in sorted(months)]
    source = read_archives(spark, archives).select(
        F.regexp_extract(F.input_file_name(), month_in_path, 1).alias(PARTITION), *amounts
    )
    left = counts_and_sums(source, PARTITION, {c: raw_amount(c) for c in amounts})
    right = counts_and_sums(
        read_curated(spark, root, months, keep_month=True), PARTITION, {c: F.col(c) for c in amounts}
    )
    # One wide comparison, so that every archive is read once.
    left = left.withColumn("manifest_rows", F.col("rows"))
    recorded = manifests.select(PARTITION, F.col("rows").alias("manifest_rows"))
    right = right.join(recorded, PARTITION, "full_outer")
    result = reconcile(left, right, PARTITION, ["rows", "manifest_rows", *amounts])
    result = result.withColumns({
        "checked_at": utc_now(), "method": F.lit("sums read from archive text against decimals"),
    })
    verdict = f"{root}/data/staging/verification"
    with small_methods(spark):
        result.write.mode("overwrite").parquet(verdict)
    result = spark.read.parquet(verdict)
    different = result.where(~F.col("equal")).select(PARTITION).distinct().collect()
    if different:
        raise AssertionError(
            f"archives and published data differ: {', '.join(sorted(r[0] for r in different))}"
        )
    ordered = result.orderBy(PARTITION, "metric").withColumns(
        {c: F.col(c).cast("string") for c in ("raw", "curated")}
    )
    ordered.write.mode("overwrite").json(f"{root}/reports/source_verification")
    return result


def verify_rows(
    spark: SparkSession, root: str, spec: TableSpec = CLAIMS, raw: str | None = None,
    month_in_path: str = MONTH_IN_PATH, archive_glob: str = "A{month}.csv.gz",
) -> DataFrame:
    """Compare archives with published months row by row: ``(month, left_rows, right_rows, equal)``.

    Sums do not see rows whose values were swapped; added fingerprints of rows do. Codes are read with
    blanks cut off and amounts by a plain cast, apart from the cleaning operators. Any difference raises
    with the first months; :func:`claimworks.operators.fingerprints.row_differences_by_bucket` then finds
    the rows.
    """
    root = root.rstrip("/")
    months = sorted(row["month"] for row in read_manifests(spark, root).select("month").collect())
    if not months:
        raise ValueError(f"no published month under {root}")
    left, right = source_and_curated(spark, root, months, spec, raw or f"{root}/data/raw", month_in_path, archive_glob)
    stored = f"{root}/data/staging/rows_verified"
    with small_methods(spark), freed_shuffles(spark):
        group_equality(left, right, PARTITION).write.mode("overwrite").parquet(stored)
    result = spark.read.parquet(stored)
    different = sorted(r[0] for r in result.where(~F.col("equal")).select(PARTITION).collect())
    if different:
        raise AssertionError(f"rows of archives and published data differ: {', '.join(map(str, different[:12]))}")
    return result


def source_and_curated(
    spark: SparkSession, root: str, months: list[str], spec: TableSpec, raw: str, month_in_path: str, archive_glob: str
) -> tuple[DataFrame, DataFrame]:
    """The rows of archives and of published months in one form: month, codes, amounts."""
    blanks = F.lit(" \t")
    source = read_archives(spark, [f"{raw}/{archive_glob.format(month=m)}" for m in months]).select(
        F.regexp_extract(F.input_file_name(), month_in_path, 1).alias(PARTITION),
        *[F.nullif(F.btrim(c, blanks), F.lit("")).alias(c) for c in spec.codes],
        *[raw_amount(F.btrim(c, blanks)).alias(c) for c in spec.numeric],
    )
    published = read_curated(spark, root, months, keep_month=True).select(PARTITION, *spec.codes, *spec.numeric)
    return source, published


def verify_regions(spark: SparkSession, root: str, stored: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """Recompute the region totals and compare them with a stored result, group by group.

    Raises when a group is missing on either side, a value is missing or differs by more than the
    tolerance. The recomputed totals are stored as text.
    """
    root = root.rstrip("/")
    computed = f"{root}/data/staging/regions"
    region_totals_as_text(read_curated(spark, root)).write.mode("overwrite").parquet(computed)
    again = spark.read.parquet(computed)
    left = again.withColumn(REGION_VALUE, F.col(REGION_VALUE).cast("decimal(38,6)"))
    right = stored.withColumn(REGION_VALUE, F.col(REGION_VALUE).cast("decimal(38,6)"))
    compared = reconcile_tolerance(left, right, REGION_KEYS, REGION_VALUE, tolerance)
    wrong = compared.groupBy("verdict").count().where("verdict <> 'same'").collect()
    if wrong:
        raise AssertionError("; ".join(f"{r['count']} groups {r['verdict']}" for r in wrong))
    again.orderBy(*REGION_KEYS).write.mode("overwrite").options(**CSV_TEXT).csv(
        f"{root}/reports/analyses/regions_recomputed"
    )
    return compared


def region_totals_as_text(claims: DataFrame) -> DataFrame:
    """Totals by month and region, the amount as text."""
    return claims.groupBy(
        F.col("FLX_ANN_MOI").alias("mois_traitement"),
        F.col("BEN_RES_REG").alias("code_region_residence"),
    ).agg(total("FLT_REM_MNT").cast("string").alias(REGION_VALUE))
