"""License scans: an exact set-similarity join of text blocks with license templates.

A block is a window of words. It may start anywhere; but a block that reaches the threshold still does so
when it is moved on to its first word of the template, so blocks start at words of templates only, and
near a word that the prefix filter asks for. A template is found where a block holds at least a share of
its distinct words. Words are
ordered by their frequency in all documents, rarest first. Then a block must hold one of a template's
first words (prefix filter), enough words (length filter), and enough words after the first common one
(positional filter) before the sets themselves are compared. All of it is DataFrame functions.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimworks.llm.tables import digest

WINDOW = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases that name a license, and notices as their publishers word them.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
     "in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
     "provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the \"Software\"), to deal in the Software without restriction"),
    ("mit", "Released under the MIT License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("reserved", "All rights reserved"),
)


def plain_words(text: str) -> Column:
    """Runs of letters, digits and characters beyond ASCII, with A-Z lowered."""
    lowered = F.translate(F.coalesce(F.col(text).cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, BREAKS), "")


def _literal(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words]).cast("array<string>")


def _template_sets(templates) -> list[tuple[str, list[str]]]:
    out = []
    for label, text in templates:
        spaced = "".join(c if c.isalnum() else " " for c in text.lower())
        out.append((label, sorted(set(spaced.split()))))
    return [(label, words) for label, words in out if words]


def _places(phrase: str) -> Column:
    """Word numbers at which a phrase starts; only texts that hold it are walked through."""
    parts = phrase.split()
    same = lambda i: reduce(
        lambda a, b: a & b, [F.get("words", i + k) == part for k, part in enumerate(parts)]
    )
    walk = F.filter(F.sequence(F.lit(0), F.size("words") - len(parts)), same)
    return F.when(F.col("line").contains(f" {phrase} "), walk).otherwise(F.array().cast("array<int>"))


def base_places(docs: DataFrame, phrases=PHRASES) -> DataFrame:
    """Per row of (doc_id, text): key, words, and the places of the phrases."""
    rows = docs.select(F.col("doc_id").cast("long"), *digest("doc_id", "text"), plain_words("text").alias("words"))
    rows = rows.withColumn("line", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))
    names = [f"__p{i}" for i in range(len(phrases))]
    rows = rows.select(
        "__k1", "__k2", "doc_id", F.size("words").cast("long").alias("n_words"),
        *[_places(p).alias(n) for n, (p, _) in zip(names, phrases, strict=True)],
    )
    labels = F.array(*[F.when(F.size(n) > 0, F.lit(label)) for n, (_, label) in zip(names, phrases, strict=True)])
    return rows.withColumn("places", F.concat(*names)).withColumn(
        "base_labels", F.array_sort(F.array_distinct(F.array_compact(labels)))
    ).drop(*names)


def word_frequencies(docs: DataFrame, words: list[str]) -> dict[str, int]:
    """In how many documents each of some given words stands."""
    held = docs.select(F.explode(F.array_intersect(plain_words("text"), _literal(words))).alias("word"))
    return {r["word"]: r["count"] for r in held.groupBy("word").count().collect()}


def matching_blocks(
    docs: DataFrame, templates=TEMPLATES, threshold: float = 0.8, window: int = WINDOW
) -> DataFrame:
    """``__k1, __k2, block, template, label, containment`` of blocks that reach the threshold.

    ``docs`` has doc_id and text; ``block`` is the word, from 0, that a block starts with. Of all windows
    of a text, the best for each template is among the blocks. A template that needs more distinct words
    than a window has is refused.
    """
    spark = docs.sparkSession
    sets = _template_sets(templates)
    known = sorted({w for _, words in sets for w in words})
    often = word_frequencies(docs, known)
    order = sorted(known, key=lambda w: (often.get(w, 0), w))
    rank = {w: i + 1 for i, w in enumerate(order)}
    rows, prefixes = [], set()
    for number, (label, words) in enumerate(sets):
        ranks = sorted(rank[w] for w in words)
        need = math.ceil(threshold * len(ranks) - 1e-9)
        if need > window:
            raise ValueError(f"a template of {label} needs {need} words, more than a window of {window}")
        for place, first in enumerate(ranks[: len(ranks) - need + 1]):
            prefixes.add(order[first - 1])
            rows.append((first, place, number, label, need, ranks))
    index = spark.createDataFrame(
        rows, "rank int, place int, template int, label string, need int, ranks array<int>"
    )

    rare, known_words = _literal(sorted(prefixes)), _literal(order)
    texts = docs.select(*digest("doc_id", "text"), plain_words("text").alias("words"))
    texts = texts.where(F.arrays_overlap("words", rare)).distinct()
    at_rare = F.filter(
        F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.array_contains(rare, F.get("words", i))
    )
    near = lambda p: F.filter(
        F.sequence(F.greatest(F.lit(0), p - (window - 1)), p), lambda i: F.array_contains(known_words, F.get("words", i))
    )
    starts = F.array_distinct(F.flatten(F.transform(at_rare, near)))
    windows = F.transform(
        starts, lambda i: F.struct(i.alias("block"), F.slice("words", i + 1, F.lit(window)).alias("words"))
    )
    blocks = texts.select("__k1", "__k2", F.inline(windows))
    numbers = F.transform(
        F.array_intersect("words", _literal(order)), lambda w: F.array_position(_literal(order), w).cast("int")
    )
    blocks = blocks.select("__k1", "__k2", "block", F.array_sort(numbers).alias("held"))
    probes = blocks.select("*", F.posexplode("held").alias("at", "rank"))
    # The templates are a fixed list, so their index is small whatever the documents.
    first = probes.join(F.broadcast(index), "rank").groupBy("__k1", "__k2", "block", "template").agg(
        F.min("at").alias("at"), F.min("place").alias("place"), F.first("held").alias("held"),
        F.first("label").alias("label"), F.first("need").alias("need"), F.first("ranks").alias("ranks"),
    )
    reach = F.least(F.size("ranks") - F.col("place"), F.size("held") - F.col("at"))
    near = first.where((F.size("held") >= F.col("need")) & (reach >= F.col("need")))
    shared = F.size(F.array_intersect("held", "ranks"))
    return near.where(shared >= F.col("need")).select(
        "__k1", "__k2", "block", "template", "label", (shared / F.size("ranks")).alias("containment")
    )


def scan(docs: DataFrame, threshold: float = 0.8, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): words, phrase places, labels and a score.

    ``places`` are the word numbers of all phrases, ``base_labels`` and ``labels`` sorted arrays, the
    latter with the labels of matching blocks; ``score`` is 1 where a phrase stands, else the best
    containment found, else 0. Null and empty texts have no words and no labels. Rows of equal doc_id
    and text get equal results; other columns are not read; an empty table gives no rows.
    """
    rows = base_places(docs)
    found = matching_blocks(docs, threshold=threshold, window=window).groupBy("__k1", "__k2").agg(
        F.collect_set("label").alias("found"), F.max("containment").alias("best")
    )
    none = F.array().cast("array<string>")
    return rows.join(found, ["__k1", "__k2"], "left").select(
        "doc_id", "n_words", "places", "base_labels",
        F.array_sort(F.array_distinct(F.concat("base_labels", F.coalesce("found", none)))).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
