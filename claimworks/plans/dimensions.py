"""Dimension tables from dictionary sheets, stored where the other jobs look for them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from claimworks.operators.dictionary import build_dimensions
from claimworks.sources.labels import LABEL_TABLE, checked_labels

VARIABLE_TABLE = "variables"


def write_dimensions(definition_rows: DataFrame, label_rows: DataFrame, root: str) -> None:
    """Write variable definitions and code labels as Parquet under ``references``.

    Both inputs are tables of numbered rows, ``(sheet, row_no, c0, c1, …)``; the last sheet in order
    wins. A null or repeated key stops the job before the labels are replaced.
    """
    folder = f"{root.rstrip('/')}/references"
    variables, labels = build_dimensions(definition_rows, label_rows)
    variables.write.mode("overwrite").parquet(f"{folder}/{VARIABLE_TABLE}")
    checked_labels(labels).write.mode("overwrite").parquet(f"{folder}/{LABEL_TABLE}")
