"""Quality profile and publication gate."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from claimworks.functions import quoted, total
from claimworks.operators.cleaning import DEFECTS
from claimworks.schema import (
    CLAIMS, KNOWN_REIMBURSEMENT_TYPES, LEGAL_PART_TYPES, RESERVED_BLANK_NAME, TOTAL_TYPE, UNKNOWN_CODE, TableSpec,
)
from claimworks.sources.archives import MALFORMED

CARE_MONTH = r"^(?:0?[1-9]|1[0-2])\z"
NULLS, SUM = "null__", "sum__"
# Types whose texts hold no semicolon and are never a lone minus sign.
PLAIN = ("bigint", "int", "smallint", "tinyint", "boolean", "date", "timestamp", "timestamp_ntz", "double", "float")
POLICY = "negatives, unknown codes and missing act counts are kept and described, never imputed"


def rule_counts(file_month: Column, spec: TableSpec = CLAIMS) -> dict[str, Column]:
    """Row tests behind the named counts; a test that is null does not count."""
    kind = F.col("PRS_REM_TYP")
    legal = F.when(
        kind.isin(*LEGAL_PART_TYPES), F.coalesce("PRS_REM_MNT", F.lit(0).cast("decimal(24,6)"))
    ).otherwise(F.lit(0).cast("decimal(24,6)"))
    return {
        "wrong_month": F.col(spec.month).isNull() | (F.col(spec.month) != file_month),
        "negative_reimbursement_rows": F.col("FLT_REM_MNT") < 0,
        "negative_expense_rows": F.col("FLT_PAI_MNT") < 0,
        "region_code_99_rows": F.col("BEN_RES_REG") == UNKNOWN_CODE,
        "age_code_99_rows": F.col("AGE_BEN_SNDS") == UNKNOWN_CODE,
        "missing_act_count_rows": F.col("PRS_ACT_NBR").isNull(),
        "unknown_reimbursement_type_rows": kind == UNKNOWN_CODE,
        "unexpected_reimbursement_type_rows": ~F.coalesce(kind, F.lit("")).isin(
            *KNOWN_REIMBURSEMENT_TYPES, UNKNOWN_CODE
        ),
        "unusual_care_month_rows": ~F.coalesce("SOI_MOI", F.lit("")).rlike(CARE_MONTH),
        "filtered_reimbursement_mismatch_rows": kind.isin(*KNOWN_REIMBURSEMENT_TYPES)
        & (F.coalesce("FLT_REM_MNT", F.lit(0).cast("decimal(24,6)")) != legal),
    }


def null_counts(columns: Sequence[str]) -> list[Column]:
    return [F.count_if(quoted(c).isNull()).alias(f"{NULLS}{c}") for c in columns]


def checksums(columns: Sequence[str]) -> list[Column]:
    """Exact sums; no rows or only nulls sum to 0."""
    zero = F.lit(0).cast(TOTAL_TYPE)
    return [F.coalesce(total(c), zero).alias(f"{SUM}{c}") for c in columns]


def profile(
    df: DataFrame,
    file_month: str | Column,
    by: str | None = None,
    spec: TableSpec = CLAIMS,
    columns: Sequence[str] | None = None,
    money: Sequence[str] | None = None,
) -> DataFrame:
    """All metrics in one scan, one wide row per group.

    Every metric combines on the map side, so the exchange carries one row per task and group
    however large a month is.
    """
    month = F.col(file_month) if isinstance(file_month, str) else file_month
    data = [c for c in df.columns if c not in (by, DEFECTS)] if columns is None else list(columns)
    metrics = profile_metrics(month, data, DEFECTS in df.columns, spec, money)
    return (df.groupBy(by) if by else df.groupBy()).agg(*metrics)


def profile_metrics(
    file_month: Column, columns: Sequence[str], defects: bool = False, spec: TableSpec = CLAIMS,
    money: Sequence[str] | None = None,
) -> list[Column]:
    """The aggregates of a profile, for a grouped pass or for an observation of a write."""
    metrics = [F.count(F.lit(1)).alias("rows")]
    if defects:
        damaged = [*[c for c in columns if c in spec.numeric], RESERVED_BLANK_NAME, MALFORMED]
        seen = [F.when(F.max(F.array_contains(DEFECTS, c)), F.lit(c)) for c in damaged]
        metrics += [
            F.count_if(F.col(DEFECTS).isNotNull()).alias("defect_rows"),
            F.array_sort(F.array_compact(F.array(*seen))).alias("defect_columns"),
        ]
    metrics += [F.count_if(test).alias(name) for name, test in rule_counts(file_month, spec).items()]
    return metrics + null_counts(columns) + checksums(spec.money if money is None else money)


def observed_write(rows: DataFrame, metrics: Sequence[Column], write: Callable[[DataFrame], None]) -> dict:
    """Write rows and return metrics of them by name, in one pass.

    ``write`` gets the rows and must not shuffle them. The metrics, aggregates as of
    :func:`profile_metrics`, are taken from the rows on their way into the files. They are exact under
    lost and repeated tasks: they belong to the tasks that write, and Spark adds up those of one
    successful attempt per part, as it commits the files of one. If the write fails, there are none.
    """
    seen = Observation()
    write(rows.observe(seen, *metrics))
    return seen.get


def blocking_rules(columns: Sequence[str], spec: TableSpec = CLAIMS) -> list[tuple[Column, Column]]:
    """``(test, message)`` over profile metrics, in the order messages are reported."""
    rules = [(F.col("rows") == 0, F.lit("no rows"))]
    if "defect_rows" in columns:
        rules.append(
            (F.col("defect_rows") > 0,
             F.concat(F.lit("unreadable values: "), F.array_join("defect_columns", ", ")))
        )
    rules.append((F.col("wrong_month") > 0, F.lit("month missing or not that of the file")))
    rules += [
        (F.col(f"{NULLS}{c}") > 0, F.lit(f"missing values in {c}")) for c in spec.never_null
    ]
    return rules + [
        (F.col("filtered_reimbursement_mismatch_rows") > 0,
         F.lit("filtered reimbursement differs from the legal part")),
        (F.col("unexpected_reimbursement_type_rows") > 0, F.lit("unexpected reimbursement type")),
    ]


def gate(profiles: DataFrame, spec: TableSpec = CLAIMS) -> DataFrame:
    """Add ``status`` and the ordered ``blocking_errors`` to profile rows."""
    found = [F.when(test, message) for test, message in blocking_rules(profiles.columns, spec)]
    errors = F.array_compact(F.array(*found))
    return profiles.withColumn("blocking_errors", errors).withColumn(
        "status", F.when(F.size("blocking_errors") > 0, "failed").otherwise("passed")
    )


def long_metrics(profiles: DataFrame, by: list[str], prefix: str, name: str) -> DataFrame:
    """Wide metrics of one family as ``(by…, name, value)`` rows."""
    family = [c for c in profiles.columns if c.startswith(prefix)]
    renamed = profiles.select(*by, *[quoted(c).alias(c[len(prefix):]) for c in family])
    return renamed.unpivot(by, [c[len(prefix):] for c in family], name, "value")


def row_text(df: DataFrame) -> Column:
    """A text that stands for a row; equal texts mean equal rows, nulls included.

    Each value is written with its length, and null as a sign no length starts with, so different
    rows cannot give the same text. Numbers, dates and truth values are short and hold no semicolon: they
    end with one instead, so their length need not be found. Both zeros of floating numbers are one
    value, as in a group.
    """
    parts = []
    for c, kind in df.dtypes:
        value = quoted(c)
        if kind in ("double", "float"):
            value = F.when(value == 0, F.lit(0).cast(kind)).otherwise(value)
        text = value.cast("string")
        if kind in PLAIN or kind.startswith("decimal"):
            parts += [F.coalesce(text, F.lit("-")), F.lit(";")]
        else:
            parts += [F.coalesce(F.concat(F.octet_length(text), F.lit(":"), text), F.lit("-"))]
    return F.concat(*parts)


def row_digest(df: DataFrame) -> Column:
    """SHA-256 of a row."""
    return F.unhex(F.sha2(row_text(df), 256))


def duplicate_excess(df: DataFrame, by: str | None = None) -> DataFrame:
    """``(by, rows, exact_duplicate_excess)`` of whole groups, nulls equal; nothing is removed.

    One scan. Rows travel as their digests, so the exchange carries 32 bytes a row instead of all
    columns. Copies are counted on the map side first, so a row copied very often does not fill one
    task.
    """
    keys = [by] if by else []
    groups = df.select(*keys, row_digest(df).alias("_digest")).groupBy(*keys, "_digest")
    counted = groups.agg(F.count(F.lit(1)).alias("_n"))
    return counted.groupBy(*keys).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("exact_duplicate_excess"),
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    """Rows without copies; nulls are equal to each other."""
    return df.dropDuplicates()
