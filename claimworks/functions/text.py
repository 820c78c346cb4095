"""Text cleaning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points with the Unicode White_Space property.
UNICODE_WHITESPACE = "".join(
    map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)


def quoted(name: str) -> Column:
    """A column by its literal name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def strip(column: Column | str) -> Column:
    """Strip Unicode whitespace at both ends.

    ``trim`` alone would leave tabs and no-break spaces. Most values begin and end with a visible
    ASCII character; two comparisons settle those, and only the others pay for the character set.
    """
    text = F.col(column) if isinstance(column, str) else column
    last = F.substring(text, -1, 1)
    bare = text.between("!", "~\uffff") & last.between("!", "~")
    return F.when(bare, text).otherwise(F.btrim(text, F.lit(UNICODE_WHITESPACE)))


def strip_to_null(column: Column | str) -> Column:
    """Strip as :func:`strip`; nothing left means null."""
    return F.nullif(strip(column), F.lit(""))
