"""A corpus from documents to a mix, one operator a stage.

Quality rules drop documents, near-duplicates leave one document of a group, test phrases are cut out,
secrets are masked, and the mix says how often each document is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks.llm import decontamination, mixing, quality, secret_scan, simhash
from claimworks.llm.tables import stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.judge(docs).where("kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return simhash.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of test phrases go from the texts; the documents stay."""
    found = decontamination.find_contamination(docs, table(spark, sf_dir, "benchmark"), cut=True)
    return _measured(stored(found, "contamination")).select(*docs.columns)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are masked; the documents stay."""
    return _measured(secret_scan.redact(docs)).select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, and how often."""
    return mixing.mix(docs).where("copies > 0")


def _measured(docs: DataFrame) -> DataFrame:
    """The number of characters follows the text."""
    return docs.withColumn("n_chars", F.length("text").cast("long"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("source_mix", source_mix),
]
ORACLE_SQL = None  # hashing, language models and searches are beyond SQL; tests use plain versions


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; each stage's result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
