"""Month keys such as ``202501``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from claimworks.schema import FIRST_SUPPORTED_YEAR


def month_key(timestamp: Column | str) -> Column:
    """Six-digit month of a date or timestamp."""
    return (F.year(timestamp) * 100 + F.month(timestamp)).cast("string")


def valid_month(column: Column, first_year: int = FIRST_SUPPORTED_YEAR) -> Column:
    """Six ASCII digits naming a calendar month of a supported year; null is not valid."""
    shape = column.rlike(r"^[0-9]{4}(?:0[1-9]|1[0-2])\z")
    year = F.when(shape, F.substring(column, 1, 4)).cast("int")
    return F.coalesce(shape & (year >= first_year), F.lit(False))


def utc_now() -> Column:
    """The time of the query in UTC, as text to the second."""
    utc = F.to_utc_timestamp(F.now(), F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")
