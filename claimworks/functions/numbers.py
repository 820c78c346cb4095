"""Exact amounts: parsing, totals and display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimworks.functions.text import strip_to_null
from claimworks.schema import AMOUNT_TYPE, TOTAL_TYPE

# An optional sign, then at most 18 significant integer digits with at most 6 decimals. Whatever
# passes fits decimal(24,6) exactly, so the cast below can neither round nor overflow, whether or
# not the session runs in ANSI mode.
AMOUNT_PATTERN = r"^[+-]?(?:0*[0-9]{1,18}(?:\.[0-9]{0,6})?|\.[0-9]{1,6})\z"


def amount_text(column: Column | str) -> Column:
    """Stripped text with decimal commas as points."""
    return F.replace(strip_to_null(column), F.lit(","), F.lit("."))


def text_amount(text: Column) -> Column:
    """Prepared text to exact decimal; null for null and for anything that is no exact amount."""
    return F.when(text.rlike(AMOUNT_PATTERN), text).cast(AMOUNT_TYPE)


def total(column: Column | str) -> Column:
    """Exact sum in the widest decimal."""
    return F.sum(column).cast(TOTAL_TYPE)


def fr_number(column: Column, decimals: int = 0) -> Column:
    """French display of a number: space between thousands, decimal comma, half-even rounding."""
    return F.translate(F.format_number(column, decimals), ",.", " ,")
