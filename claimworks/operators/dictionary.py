"""Label dimensions from dictionary sheets given as tables of numbered rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimworks.functions import strip

# Rows a sheet block may hold; one task ranks one block.
BLOCK_ROWS = 1_000_000
INLINE_NAMES = 1_000
HEADER_ROWS = 4  # fixed value: title rows above the definitions


def forward_fill(
    df: DataFrame, sheet: str, row_no: str, value: Column, name: str, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Add ``name``: the latest non-null ``value`` at or above each row of its sheet.

    A sheet is cut into blocks of consecutive row numbers. Each block is filled on its own; the
    last value of each block, one row per block, is filled in turn and carried into the next
    blocks. So no task holds a whole sheet, even if one sheet holds most rows, and rows travel once:
    the fill and the carry use the same blocks. A null sheet is the sheet without a name.
    """
    block = F.col(row_no) - F.pmod(F.col(row_no), F.lit(block_rows))
    rows = df.withColumn("_value", value).withColumn("_block", block)
    named = F.coalesce(F.col(sheet).cast("string"), F.lit("")).alias("_sheet")
    rows = rows.select("*", named, F.col(sheet).isNull().alias("_none"))
    keys = ["_none", "_sheet", "_block"]
    inside = (
        Window.partitionBy(*keys).orderBy(row_no)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    above = (
        Window.partitionBy("_none", "_sheet").orderBy("_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        rows.where(F.col("_value").isNotNull()).groupBy(*keys)
        .agg(F.max_by("_value", row_no).alias("_last"))
    )
    blocks = rows.select(*keys).distinct().join(carried, keys, "left")
    carried = (
        blocks.withColumn("_carry", F.last("_last", ignorenulls=True).over(above))
        .where(F.col("_carry").isNotNull()).select(*keys, "_carry")
    )
    return (
        rows.withColumn("_here", F.last("_value", ignorenulls=True).over(inside))
        .join(carried, keys, "left")
        .select(*df.columns, F.coalesce("_here", "_carry").alias(name))
    )


def definitions(rows: DataFrame, sheet: str = "sheet") -> DataFrame:
    """Variable definitions: title rows and rows without a name left out, the last duplicate wins.

    Input ``(sheet, row_no, c0, c1, c2, c3)``, output ``(sheet, name, label, category, comment)``.
    """
    named = rows.where((F.col("row_no") > HEADER_ROWS) & (F.col("c0") != ""))
    return (
        named.groupBy(sheet, strip("c0").alias("name"))
        .agg(F.max_by(F.struct("c1", "c2", "c3"), "row_no").alias("d"))
        .select(
            sheet, "name", F.col("d.c1").alias("label"), F.col("d.c2").alias("category"),
            F.col("d.c3").alias("comment"),
        )
    )


def heading(rows: DataFrame, names: DataFrame) -> DataFrame:
    """``rows`` with ``_name``: the section a row opens, or null.

    A dictionary has a short list of names: up to ``INLINE_NAMES`` are put into the expression, so the
    rows need not travel; longer lists are joined, with the same result.
    """
    known = names.select(F.col("name").alias("_name")).where(F.col("name").isNotNull()).distinct()
    few = [r["_name"] for r in known.limit(INLINE_NAMES + 1).collect()]
    if len(few) > INLINE_NAMES:
        return rows.join(known, strip("c0") == F.col("_name"), "left")
    return rows.withColumn("_name", F.when(strip("c0").isin(few), strip("c0")))


def sections(
    rows: DataFrame, names: DataFrame, sheet: str = "sheet", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Code rows with the section they stand in: ``(sheet, row_no, variable, opened, code, label)``.

    A row whose first cell is a known name opens a section; ``opened`` is its row number. Rows above
    the first section and rows without a code are left out.
    """
    return _sections(heading(rows, names), sheet, block_rows)


def _sections(marked: DataFrame, sheet: str, block_rows: int) -> DataFrame:
    head = F.when(
        F.col("_name").isNotNull(), F.struct(F.col("_name").alias("name"), F.col("row_no").alias("at"))
    )
    filled = forward_fill(marked, sheet, "row_no", head, "_section", block_rows)
    return filled.where(
        F.col("_name").isNull() & F.col("_section").isNotNull() & F.col("c0").isNotNull()
    ).select(
        sheet, "row_no", F.col("_section.name").alias("variable"), F.col("_section.at").alias("opened"),
        strip("c0").alias("code"), strip(F.coalesce("c1", F.lit(""))).alias("label"),
    )


def latest_labels(
    rows: DataFrame, names: DataFrame, sheet: str = "sheet", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``(sheet, variable, code, libelle)``; a reopened section starts afresh, the last code wins.

    Of each code only the label of its latest opening and row is kept, by an aggregate that combines on
    the map side; the last opening of each variable comes from the heading rows alone.
    """
    marked = heading(rows, names)
    final = (
        marked.where(F.col("_name").isNotNull())
        .groupBy(F.col(sheet).alias("_s"), "_name").agg(F.max("row_no").alias("_final"))
    )
    newest = F.struct("opened", "row_no")
    codes = _sections(marked, sheet, block_rows).groupBy(sheet, "variable", "code").agg(
        F.max_by("label", newest).alias("libelle"), F.max("opened").alias("_opened")
    )
    return codes.join(
        final,
        F.col(sheet).eqNullSafe(F.col("_s")) & (F.col("variable") == F.col("_name"))
        & (F.col("_opened") == F.col("_final")),
        "left_semi",
    ).select(sheet, "variable", "code", "libelle")


def build_dimensions(
    definition_rows: DataFrame, label_rows: DataFrame, sheet: str = "sheet"
) -> tuple[DataFrame, DataFrame]:
    """Both dimension tables: variable definitions by name, and labels by variable and code.

    Where several sheets define the same name or code, the last sheet in order wins, a null sheet
    being the first.
    """
    defined = definitions(definition_rows, sheet)
    labelled = latest_labels(label_rows, defined, sheet)
    variables = defined.groupBy("name").agg(
        F.max_by(F.struct("label", "category", "comment"), _sheet_order(sheet)).alias("d")
    ).select("name", "d.*")
    labels = labelled.groupBy("variable", "code").agg(
        F.max_by("libelle", _sheet_order(sheet)).alias("libelle")
    )
    return variables, labels


def _sheet_order(sheet: str) -> Column:
    return F.struct(F.col(sheet).isNotNull(), F.col(sheet))
