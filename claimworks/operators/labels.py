"""Label joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimworks.sources.labels import checked_labels

NO_LABEL = "Libellé non disponible"  # fixed value


def with_labels(
    totals: DataFrame,
    labels: DataFrame,
    variable: str,
    code: str,
    label: str,
    default: Column | None = None,
) -> DataFrame:
    """Add the label of a code; rows whose code has none keep a default text.

    Meant for totals, not for facts: joining after the aggregate leaves few rows to match. There is
    no broadcast hint. Spark broadcasts the labels when it has measured them to be small and
    otherwise joins by shuffle.
    """
    wanted = checked_labels(labels).where(F.col("variable") == variable).select(
        F.col("code").alias("_code"), F.col("libelle").alias("_label")
    )
    fallback = F.lit(NO_LABEL) if default is None else default
    return totals.join(wanted, totals[code] == wanted["_code"], "left").select(
        *[totals[c] for c in totals.columns], F.coalesce("_label", fallback).alias(label)
    )
