"""Label relation ``(variable, code, libelle)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks.sources.files import exists

LABELS_SCHEMA = "variable string, code string, libelle string"
LABELS_GLOB = "modalites*.json"
LABEL_TABLE = "labels"


def read_labels(spark: SparkSession, folder: str, glob: str = LABELS_GLOB) -> DataFrame:
    """Labels from the table a dimension build left, or else from JSON documents.

    A document is ``{variable: {code: label}}``. Without either there are no labels.
    """
    if exists(spark, f"{folder}/{LABEL_TABLE}"):
        return spark.read.schema(LABELS_SCHEMA).parquet(f"{folder}/{LABEL_TABLE}")
    if exists(spark, folder):
        return labels_from_json(spark.read.option("pathGlobFilter", glob).text(folder, wholetext=True), "value")
    return spark.createDataFrame([], LABELS_SCHEMA)


def labels_from_json(documents: DataFrame, column: str) -> DataFrame:
    """Unfold nested label documents, one row per variable and code."""
    nested = F.from_json(column, "map<string,map<string,string>>", {"mode": "FAILFAST"})
    return (
        documents.select(F.explode(nested).alias("variable", "codes"))
        .select("variable", F.explode("codes").alias("code", "libelle"))
    )


def checked_labels(labels: DataFrame) -> DataFrame:
    """The same labels, stopping the job when a key is null or given twice, for whichever variable.

    Spark has no primary keys; a repeated key would multiply rows in a label join. The key that comes
    back holds the check, so a filter on a variable comes after it.
    """
    key = F.concat_ws("/", "variable", "code")
    wrong = (F.col("n") > 1) | F.col("variable").isNull() | F.col("code").isNull()
    stop = F.raise_error(F.concat(F.lit("label key is null or repeated: "), key))
    return (
        labels.groupBy("variable", "code")
        .agg(F.count(F.lit(1)).alias("n"), F.max("libelle").alias("libelle"))
        .select(
            F.when(wrong, stop).otherwise(F.col("variable")).alias("variable"),
            "code", "libelle",
        )
    )
