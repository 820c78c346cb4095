"""Are archives what their sidecars declare?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.sources.files import GZIP_MAGIC

ACCEPTED = "accepted"


def plain_path(column: str):
    """One spelling for local URIs, which readers write with one or three slashes."""
    return F.regexp_replace(column, r"^file:/+", "file:/")


def check_archives(facts: DataFrame, sidecars: DataFrame) -> DataFrame:
    """All archives and sidecars with a ``verdict``; the first broken rule is named.

    A declared length of 0 or null is not checked, a declared digest always is. Sidecars may have a
    ``sidecar_problem`` of their own.
    """
    if "sidecar_problem" not in sidecars.columns:
        sidecars = sidecars.withColumn("sidecar_problem", F.lit(None).cast("string"))
    found = facts.withColumn("_path", plain_path("path")).drop("path")
    declared = sidecars.withColumn("_path", plain_path("path")).drop("path")
    both = found.join(declared, "_path", "full_outer").withColumnRenamed("_path", "path")
    length = F.col("declared_bytes")
    verdict = (
        F.when(F.col("bytes").isNull(), "archive missing")
        .when(F.col("sidecar_problem").isNotNull(), F.col("sidecar_problem"))
        .when(F.col("declared_sha256").isNull(), "sidecar missing")
        .when(F.col("bytes") == 0, "empty archive")
        .when(F.col("magic") != GZIP_MAGIC, "not gzip")
        .when((length > 0) & (length != F.col("bytes")), "incomplete archive")
        .when(F.col("sha256") != F.col("declared_sha256"), "digest differs")
        .when(F.col("problem").isNotNull(), F.col("problem"))
        .otherwise(ACCEPTED)
    )
    return both.withColumn("verdict", verdict)


def fingerprints(facts: DataFrame, by: str) -> DataFrame:
    """``(by, fingerprint, bytes)``: one digest for the set of files of each group.

    A single file is its own fingerprint. Names do not count, so renamed parts stay the same.
    """
    digests = F.sort_array(F.collect_list("sha256"))
    return (
        facts.groupBy(by)
        .agg(digests.alias("d"), F.sum("bytes").alias("bytes"))
        .select(
            by,
            F.when(F.size("d") == 1, F.col("d")[0])
            .otherwise(F.sha2(F.concat_ws(",", "d"), 256)).alias("fingerprint"),
            "bytes",
        )
    )
