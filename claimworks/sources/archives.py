"""Delimited archives: header contract and strict all-text read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimworks.schema import RESERVED_BLANK_NAME, RESERVED_NAMES, StructureError
from claimworks.sources.files import file_facts

MALFORMED = "_malformed"
# How this package writes comma-separated text: quotes are doubled, blanks kept, null is an empty cell
# and an empty text a quoted one. Readers use the same quoting.
CSV_TEXT = {
    "header": "true", "escape": '"', "nullValue": "", "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
EMPTY = "\x00\x00"
MONTH_IN_PATH = r"(?:A|month=)([0-9]{6})(?:\.csv|/)"


def header_problem(header: list[str] | None) -> str | None:
    """Why a header line cannot be read by name, or None.

    Spark resolves names without regard to case and would silently rename repeated ones.
    """
    if not header:
        return "empty file"
    folded = [name.lower() for name in header]
    if taken := [name for name in folded if name in RESERVED_NAMES]:
        return f"reserved column name {taken[0]}"
    if len(set(folded)) != len(folded):
        return "duplicate column names"
    return None


def text_schema(header: list[str]) -> T.StructType:
    """All-string schema in header order; the blank name gets the reserved one."""
    return T.StructType(
        [T.StructField(name or RESERVED_BLANK_NAME, T.StringType()) for name in header]
    )


def read_delimited(
    spark: SparkSession,
    paths: list[str],
    header: list[str],
    delimiter: str = ";",
    keep_malformed: bool = False,
) -> DataFrame:
    """Files sharing one header, every column text, empty cells null.

    Rows with too few or too many cells stop the job, or with ``keep_malformed`` arrive with the
    raw line in ``_malformed``. Parser-side pruning is off for this read because a pruned parser
    no longer counts cells.
    """
    problem = header_problem(header)
    if problem:
        raise StructureError(f"{problem}: {', '.join(paths[:3])}")
    schema = text_schema(header)
    options = {
        "sep": delimiter, "header": "true", "encoding": "UTF-8", "escape": '"',
        "columnPruning": "false", "mode": "FAILFAST",
    }
    if keep_malformed:
        schema = schema.add(MALFORMED, T.StringType())
        options |= {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}
    return spark.read.schema(schema).options(**options).csv(paths)


def read_archives(spark: SparkSession, paths: str | list[str], delimiter: str = ";") -> DataFrame:
    """Read archives of any mix of headers; columns are united by name.

    The headers come from one distributed pass over the files, and files with the same header are
    read together.
    """
    facts = file_facts(spark, paths, depth="header", delimiter=delimiter)
    groups = (
        facts.groupBy("header", "problem")
        .agg(F.sort_array(F.collect_list("path")).alias("paths"))
        .collect()
    )
    broken = [g for g in groups if g.problem or header_problem(g.header)]
    if broken:
        first = broken[0]
        raise StructureError(f"{first.problem or header_problem(first.header)}: {first.paths[0]}")
    frames = [
        read_delimited(spark, g.paths, g.header, delimiter)
        for g in sorted(groups, key=lambda g: g.paths[0])
    ]
    united = frames[0]
    for frame in frames[1:]:
        united = united.unionByName(frame, allowMissingColumns=True)
    return united


def read_typed_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Comma-separated file with a declared schema; anything that does not fit stops the job.

    Spark's reader takes a quoted empty cell for null as well, unless it has a name of its own; that
    name is turned back into the empty text here.
    """
    rows = (
        spark.read.schema(schema)
        .options(**CSV_TEXT, emptyValue=EMPTY, mode="FAILFAST", columnPruning="false")
        .csv(path)
    )
    texts = [c for c, kind in rows.dtypes if kind == "string"]
    return rows.withColumns({c: F.when(F.col(c) == EMPTY, "").otherwise(F.col(c)) for c in texts})
