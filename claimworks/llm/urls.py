"""URL filters as a temporal list join: every capture against the entries active when it was fetched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimworks.llm.tables import digest

PERIOD = 32  # days in a piece of an interval; pieces spread a pattern that many captures meet


def url_keys(url: str) -> Column:
    """All patterns that can match a URL: its host, the host's parent domains, and its path prefixes.

    A host is lowered and loses user, port and a final dot; a path counts by whole segments, without
    query and fragment. No keys for null and for what is not ``scheme://host``.
    """
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    host = F.regexp_replace(F.lower(F.regexp_replace(authority, r"^.*@", "")), r"\.?(:[0-9]*)?$", "")
    path = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    labels, steps = F.split(host, r"\."), F.array_remove(F.split(path, "/"), "")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    prefixes = F.when(F.size(steps) > 0, F.transform(
        F.sequence(F.lit(1), F.size(steps)),
        lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(steps, F.lit(1), i), "/")),
    )).otherwise(F.array().cast("array<string>"))
    none = F.array().cast("array<string>")
    return F.when(F.coalesce(host, F.lit("")) == "", none).otherwise(F.array_distinct(F.concat(domains, prefixes)))


def validity(entries: DataFrame) -> DataFrame:
    """``pattern, since, until`` from dated entries (pattern, day, listed).

    An entry holds from its day until the next entry of the pattern; ``until`` is null while it lasts.
    On one day a removal comes after a listing. Entries without pattern, day or sign are void.
    """
    whole = entries.select("pattern", F.col("day").cast("int"), "listed").dropna().distinct()
    order = Window.partitionBy("pattern").orderBy("day", F.col("listed").desc())
    spans = whole.withColumn("until", F.lead("day").over(order))
    return spans.where("listed and (until is null or until > day)").select(
        "pattern", F.col("day").alias("since"), "until"
    )


def filter_captures(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """``captures`` (url, day, any others) with ``n_entries``, ``pattern`` and ``blocked``.

    ``n_entries`` counts the entries active on the capture's day whose pattern is its host, a parent
    domain or a path prefix; ``pattern`` is the longest of them (the smallest text among equals). A
    null or unreadable URL or day meets no entry. Repeated rows stay; equal rows get equal results.
    Columns of these three names are replaced.

    Intervals are cut into periods and joined on pattern and period, so a pattern that a third of all
    captures meet is spread over periods, and its intervals stay few in each.
    """
    captures = captures.drop("n_entries", "pattern", "blocked")
    rows = captures.select("*", *digest("url", "day"))
    wanted = rows.select("__k1", "__k2", "url", F.col("day").cast("int").alias("day")).dropna().distinct()
    last = wanted.agg(F.max("day")).head()[0]
    keyed = wanted.select("__k1", "__k2", "day", F.explode(url_keys("url")).alias("pattern"))
    keyed = keyed.withColumn("period", F.floor(F.col("day") / PERIOD).cast("int"))
    spans = validity(entries).withColumn("until", F.coalesce("until", F.lit((last or 0) + 1)))
    first, final = F.floor(F.col("since") / PERIOD), F.floor((F.col("until") - 1) / PERIOD)
    pieces = spans.where("until > since").withColumn("period", F.explode(F.sequence(first.cast("int"), final.cast("int"))))
    met = keyed.join(pieces, ["pattern", "period"]).where("day >= since and day < until")
    found = met.groupBy("__k1", "__k2").agg(
        F.count(F.lit(1)).alias("n_entries"),
        F.min_by("pattern", F.struct(-F.length("pattern"), F.col("pattern"))).alias("pattern"),
    )
    return rows.join(found, ["__k1", "__k2"], "left").drop("__k1", "__k2").withColumn(
        "n_entries", F.coalesce("n_entries", F.lit(0).cast("long"))
    ).withColumn("blocked", F.col("n_entries") > 0)
