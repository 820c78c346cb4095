"""Column expressions: everything here maps columns to columns and stays in the JVM."""

from claimworks.functions.months import month_key, utc_now, valid_month
from claimworks.functions.numbers import amount_text, fr_number, text_amount, total
from claimworks.functions.text import quoted, strip, strip_to_null

__all__ = [
    "amount_text", "fr_number", "month_key", "quoted", "strip", "strip_to_null", "text_amount",
    "total", "utc_now", "valid_month",
]
