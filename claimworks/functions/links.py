"""Links in HTML pages."""

from __future__ import annotations

import html
import sys
from urllib.parse import urljoin

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The function below travels to the executors whole, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed value: what counts as a link target.
HREF_PATTERN = r"href=[\"']([^\"']+)"


def hrefs(page: Column | str) -> Column:
    """All link targets of a page as written, in page order."""
    return F.regexp_extract_all(page, F.lit(HREF_PATTERN), 1)


@F.pandas_udf(T.StringType())
def resolve_link(base: pd.Series, link: pd.Series) -> pd.Series:
    """Absolute address of a raw link: entities decoded, then resolved against the page address.

    The standard library knows all named entities and the relative-reference rules; Spark has no
    built-in for either. Null when the link is null or cannot be resolved.
    """

    def one(page_url: str | None, target: str | None) -> str | None:
        if target is None:
            return None
        try:
            return urljoin(page_url or "", html.unescape(target))
        except ValueError:
            return None

    return pd.Series([one(b, t) for b, t in zip(base, link)], index=link.index, dtype="object")


def host(url: Column) -> Column:
    """Host of an address in lower case; null when there is none."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))
