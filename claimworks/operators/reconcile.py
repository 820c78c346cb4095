"""Independent checks of one result against another."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimworks.functions import total
from claimworks.schema import AMOUNT_TYPE


def raw_amount(column: Column | str) -> Column:
    """Amount read straight from text, on purpose not through the cleaning operators.

    Only spaces are trimmed and the cast decides. The result may differ from strict cleaning on
    damaged input, which is what makes the comparison worth something.
    """
    return F.replace(F.trim(column), F.lit(","), F.lit(".")).cast(AMOUNT_TYPE)


def counts_and_sums(df: DataFrame, by: str, amounts: dict[str, Column]) -> DataFrame:
    """Row count and exact sums per group, wide."""
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"),
        *[total(amount).alias(name) for name, amount in amounts.items()],
    )


def reconcile(left: DataFrame, right: DataFrame, by: str, metrics: list[str]) -> DataFrame:
    """``(by, metric, raw, curated, equal)`` of two wide summaries, nulls equal to nulls.

    Groups found on one side only show up with the other side null; a null group meets a null group.
    """
    a = left.select(F.col(by).alias("_l"), *[F.col(m).alias(f"l_{m}") for m in metrics])
    b = right.select(F.col(by).alias("_r"), *[F.col(m).alias(f"r_{m}") for m in metrics])
    both = a.join(b, F.col("_l").eqNullSafe(F.col("_r")), "full_outer").withColumn(
        by, F.coalesce("_l", "_r")
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(m).alias("metric"),
                F.col(f"l_{m}").cast("decimal(38,6)").alias("raw"),
                F.col(f"r_{m}").cast("decimal(38,6)").alias("curated"),
            )
            for m in metrics
        ]
    )
    return (
        both.select(by, F.explode(entries).alias("e"))
        .select(by, "e.*")
        .withColumn("equal", F.col("raw").eqNullSafe(F.col("curated")))
    )


def reconcile_tolerance(
    left: DataFrame, right: DataFrame, keys: list[str], value: str, tolerance: str = "0.01"
) -> DataFrame:
    """``(keys…, left_value, right_value, verdict)`` with a verdict for each group.

    Verdicts: ``same``, ``different``, ``missing value``, ``left only``, ``right only``. The values
    are compared as decimals; null keys match null keys.
    """
    a = left.select(
        *[F.col(k).alias(f"_l_{k}") for k in keys], F.col(value).alias("left_value"),
        F.lit(True).alias("_in_left"),
    )
    b = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], F.col(value).alias("right_value"),
        F.lit(True).alias("_in_right"),
    )
    match = reduce(
        lambda x, y: x & y, [F.col(f"_l_{k}").eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    )
    verdict = (
        F.when(F.col("_in_right").isNull(), "left only")
        .when(F.col("_in_left").isNull(), "right only")
        .when(F.col("left_value").isNull() | F.col("right_value").isNull(), "missing value")
        .when(
            F.abs(F.col("left_value") - F.col("right_value"))
            <= F.lit(Decimal(tolerance)), "same"
        )
        .otherwise("different")
    )
    return a.join(b, match, "full_outer").select(
        *[F.coalesce(f"_l_{k}", f"_r_{k}").alias(k) for k in keys],
        "left_value", "right_value", verdict.alias("verdict"),
    )


def row_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """``(left_only, right_only)``: rows, with their copies, that one result has and the other lacks.

    One grouped pass over both sides; results are equal when both numbers are 0.
    """
    columns = left.columns
    signed = left.withColumn("_side", F.lit(1)).unionByName(
        right.select(*columns).withColumn("_side", F.lit(-1))
    )
    balance = signed.groupBy(*columns).agg(F.sum("_side").alias("d"))
    return balance.agg(
        F.coalesce(F.sum(F.greatest("d", F.lit(0))), F.lit(0)).cast("long").alias("left_only"),
        F.coalesce(F.sum(F.greatest(-F.col("d"), F.lit(0))), F.lit(0)).cast("long").alias("right_only"),
    )
