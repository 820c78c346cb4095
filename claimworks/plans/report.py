"""All tables of the report from published data."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks.functions import fr_number
from claimworks.operators.report_tables import QUALITY_COUNTS, kpis, quality_rollup, top_totals
from claimworks.plans.analyses import ANALYSES
from claimworks.plans.formats import read_summary
from claimworks.sources.curated import read_curated
from claimworks.sources.labels import read_labels
from claimworks.sources.metadata import read_manifests, read_quality

AMOUNT = "remboursement_part_legale_eur"


def millions(column: str) -> Column:
    """An amount in millions with one decimal, as text; the division is exact."""
    exact = F.col(column).cast("decimal(30,6)") * F.lit(Decimal("0.000001"))
    return F.concat(fr_number(exact, 1), F.lit(" M€"))


def report_tables(
    spark: SparkSession, root: str, formats_folder: str | None = None
) -> dict[str, DataFrame]:
    """``kpis``, ``top_regions`` and ``quality`` over all published months.

    Every published month must have its quality report. With the folder of a format comparison its
    timing summary comes along as ``formats``. Display columns hold numbers as French readers
    expect them.
    """
    root = root.rstrip("/")
    manifests = read_manifests(spark, root)
    if manifests.isEmpty():
        raise ValueError(f"no published month under {root}")
    quality = read_quality(spark, root).select(
        "month", *[F.col("metrics")[c].cast("long").alias(c) for c in QUALITY_COUNTS]
    )
    orphans = manifests.join(quality, "month", "left_anti").select("month").collect()
    if orphans:
        raise ValueError(f"quality report missing: {', '.join(sorted(r[0] for r in orphans))}")
    labels = read_labels(spark, f"{root}/references")
    # The region totals hold the amount of the indicators too, so the table is read once.
    totals = f"{root}/data/staging/report_regions"
    ANALYSES["02_regions"].run(read_curated(spark, root)).write.mode("overwrite").parquet(totals)
    regions = spark.read.parquet(totals)
    indicators = kpis(manifests, regions, AMOUNT)
    top = top_totals(regions, labels, "BEN_RES_REG", "code_region_residence", AMOUNT)
    tables = {
        "kpis": indicators.withColumns({
            "rows_display": fr_number(F.col("rows")),
            "amount_display": F.concat(fr_number(F.col("amount"), 2), F.lit(" EUR")),
        }),
        "top_regions": top.withColumn("display", millions("total")),
        "quality": quality_rollup(quality.join(manifests.select("month"), "month")),
    }
    if formats_folder:
        summary = read_summary(spark, formats_folder)
        tables["formats"] = summary.withColumns({
            f"{name}_display": F.concat(fr_number(F.col(f"{name}_seconds"), 3), F.lit(" s"))
            for name in ("median", "min", "max")
        })
    return tables
