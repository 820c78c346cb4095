"""Catalogue pages: which archive does each page offer?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.functions.links import host, hrefs, resolve_link


def catalogue_links(pages: DataFrame, page_id: str, html: str) -> DataFrame:
    """Raw link targets ``(page_id, position, link)`` of all pages."""
    return pages.select(page_id, F.posexplode(hrefs(html)).alias("position", "link"))


def catalogue_match(
    pages: DataFrame, wanted: DataFrame, page_id: str, url: str, html: str, needle: str
) -> DataFrame:
    """Resolve each wanted file on its page: ``(wanted columns…, matches, resolved, verdict)``.

    A link matches when it contains the wanted text. Exactly one match on the host of the catalogue
    is ``ok``; the others are ``absent``, ``ambiguous`` or ``foreign host``. The page text is
    reduced to its links before the join, and links are filtered inside the row, so no pairs of
    links and wishes are ever made.
    """
    offers = pages.select(
        F.col(page_id).alias("_page"), F.col(url).alias("_url"), hrefs(html).alias("_links")
    )
    found = wanted.join(offers, wanted[page_id] == F.col("_page"), "left").withColumn(
        "_hits",
        F.filter(F.coalesce("_links", F.array().cast("array<string>")),
                 lambda link: F.contains(link, F.col(needle))),
    )
    resolved = found.withColumn("matches", F.size("_hits")).withColumn(
        "resolved",
        resolve_link(F.col("_url"), F.when(F.col("matches") == 1, F.get("_hits", F.lit(0)))),
    )
    verdict = (
        F.when(F.col("matches") == 0, "absent")
        .when(F.col("matches") > 1, "ambiguous")
        .when(host(F.col("resolved")).eqNullSafe(host(F.col("_url"))), "ok")
        .otherwise("foreign host")
    )
    return resolved.select(
        *[wanted[c] for c in wanted.columns], "matches", "resolved", verdict.alias("verdict")
    )
