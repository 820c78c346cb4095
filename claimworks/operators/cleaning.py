"""Text columns to typed columns, with nothing coerced silently."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimworks.functions import amount_text, quoted, strip_to_null, text_amount
from claimworks.schema import CLAIMS, RESERVED_BLANK_NAME, TableSpec, check_required
from claimworks.sources.archives import MALFORMED

DEFECTS = "_defects"


def clean(df: DataFrame, spec: TableSpec = CLAIMS) -> DataFrame:
    """Strip text, turn blanks to null and amounts to exact decimals; any defect stops the job.

    The unnamed trailing column must be null in every row. The checks are one filter over all of
    them, so they hold whichever columns are read later, and for a mere count.
    """
    typed, columns, defects = _typed(df, spec)
    if defects:
        found = [
            F.when(test, F.concat(F.lit(f"the column {name} holds something it must not: "), quoted(name)))
            for name, test in defects.items()
        ]
        some = reduce(lambda a, b: a | b, defects.values())
        stop = F.raise_error(F.coalesce(*found)).cast("boolean")
        # The row number keeps the optimiser from moving the filter below the prepared columns, which
        # would write out their expressions for every test.
        numbered = typed.withColumn("_row", F.monotonically_increasing_id())
        typed = numbered.where(F.when(some, stop).otherwise(F.col("_row") >= 0))
    return typed.select(*[column.alias(name) for name, column in columns.items()])


def clean_with_defects(df: DataFrame, spec: TableSpec = CLAIMS) -> DataFrame:
    """As :func:`clean`, but defects are named per row in ``_defects`` instead of stopping the job.

    One damaged month then blocks itself at the gate and not the other months of the batch. An
    entry is the column whose text is no exact amount, the reserved name when the unnamed column
    holds something, or ``_malformed`` for a row with the wrong number of cells.
    """
    typed, columns, defects = _typed(df, spec)
    some = reduce(lambda a, b: a | b, defects.values())
    names = F.array_compact(F.array(*[F.when(test, F.lit(c)) for c, test in defects.items()]))
    return typed.select(
        *[column.alias(name) for name, column in columns.items()],
        F.when(some, names).alias(DEFECTS),
    )


def _typed(
    df: DataFrame, spec: TableSpec
) -> tuple[DataFrame, dict[str, Column], dict[str, Column]]:
    """The table with prepared columns, its output columns and the tests for defects.

    Each amount is prepared, tested and cast once: the steps are projections of their own, which
    Spark does not merge because later steps use the earlier ones more than once.
    """
    check_required(df.columns, spec)
    numeric = [c for c in df.columns if c in spec.numeric]
    prepared = df.select("*", *[amount_text(c).alias(f"_text_{c}") for c in numeric])
    typed = prepared.select(
        "*", *[text_amount(F.col(f"_text_{c}")).alias(f"_amount_{c}") for c in numeric]
    )
    columns = {
        c: F.col(f"_amount_{c}") if c in numeric else strip_to_null(quoted(c))
        for c in df.columns if c not in (RESERVED_BLANK_NAME, MALFORMED)
    }
    defects = {
        c: F.col(f"_text_{c}").isNotNull() & F.col(f"_amount_{c}").isNull() for c in numeric
    }
    for c in (RESERVED_BLANK_NAME, MALFORMED):
        if c in df.columns:
            defects[c] = quoted(c).isNotNull()
    return typed, columns, defects
