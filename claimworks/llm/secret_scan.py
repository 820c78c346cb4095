"""Secret scans: patterns, and strings that look drawn at random, all in DataFrame functions.

Two character Markov models, one of random strings and one of ordinary identifiers, are trained from
labelled samples. A candidate string is a secret when the log likelihood ratio per character step is
above a threshold; else its stretches with as much evidence as a shortest secret are. The models are one
table over a fixed alphabet, whatever the samples.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "markov")
# What the kinds look like, and the characters the models know.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"  # a run shorter than that holds no match
LEAST = 20  # characters of a random-looking string
REST = 6  # and of what a pattern's match leaves of one
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{LEAST},}}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STEMS = (
    "account address amount archive article author balance batch before bottom bucket buffer button cache "
    "category change channel client cluster column comment company config connection content context counter "
    "country create current customer database default delete description device directory document domain "
    "download element encoding engine entry error event example export factory feature field filter folder "
    "format function gateway handler header height identifier image import index information input instance "
    "interface invoice item language layout length library license listener location logger manager market "
    "measure member message method model module monitor network number object option order output package "
    "parameter parser partner password payment person policy position prefix process product profile project "
    "property provider publish quality query reader record reference region register release report request "
    "response result return sample schedule schema section security select server service session setting "
    "simple source standard state status storage string struct summary support system table target template "
    "thread timestamp token transaction transfer update upload validate value version view warning window "
    "writer arbeit bildung einstellung gesellschaft verbindung verwaltung wissenschaft zeitung administration "
    "connaissance developpement environnement gouvernement organisation ciudad conocimiento desarrollo "
    "educacion informacion organizacion universidad"
).split()


SPAN = "array<struct<start:int,rank:int,end:int,value:string>>"


def pattern_spans(text: Column, kind: str, pattern: str, group: int = 0) -> Column:
    """All matches of a pattern as ``start, rank, end, value``, in characters; the end is exclusive.

    Matches and the gaps between them come from the same engine, so their lengths give the places.
    ``value`` is a group of the match, ``rank`` the kind's place in ``KINDS``.
    """
    none, rank = F.array().cast(SPAN), F.lit(KINDS.index(kind) + 1)
    parts = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("values"),
    )
    begin = F.struct(F.lit(0).alias("at"), none.alias("all"))

    def placed(p):
        def add(acc, i):
            start = acc["at"] + F.length(F.get(p["gaps"], i))
            end = start + F.length(F.get(p["found"], i))
            span = F.struct(
                start.alias("start"), rank.alias("rank"), end.alias("end"), F.get(p["values"], i).alias("value")
            )
            return F.struct(end.alias("at"), F.concat(acc["all"], F.array(span)).alias("all"))

        return F.aggregate(F.sequence(F.lit(0), F.size(p["found"]) - 1), begin, add, lambda acc: acc["all"])

    return F.when(F.regexp_like(text, F.lit(pattern)), _let(parts, placed)).otherwise(none)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once; in a lambda, an expression is worked out at every use."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def labelled_samples(spark: SparkSession, n: int = 4000) -> DataFrame:
    """``value, random``: n strings of each label made by rule, from digests and from common stems."""
    rows = spark.range(n).withColumn("digest", F.sha2(F.col("id").cast("string"), 512))
    raw = F.unhex("digest")
    random = rows.select(
        F.when(F.col("id") % 3 == 0, F.substring("digest", 1, 40))
        .when(F.col("id") % 3 == 1, F.substring(F.base64(raw), 1, 40))
        .otherwise(F.upper(F.translate(F.substring(F.base64(raw), 1, 32), "+/=", "")))
        .alias("value"),
        F.lit(True).alias("random"),
    )
    stems = F.array(*[F.lit(s) for s in STEMS])
    number = lambda k: F.conv(F.substring("digest", 8 * k + 1, 7), 16, 10).cast("long")
    stem = lambda k: F.get(stems, F.pmod(number(k), F.lit(len(STEMS))).cast("int"))
    place = F.pmod(number(4), F.lit(len(ALPHABET))).cast("int")
    repeated = F.substr(F.lit(ALPHABET), place + 1, F.lit(1))  # rules and filler such as "------"
    ordinary = rows.select(
        F.when(F.col("id") % 5 == 0, F.concat_ws("_", stem(0), stem(1), stem(2)))
        .when(F.col("id") % 5 == 1, F.concat(stem(0), F.initcap(stem(1)), F.initcap(stem(2))))
        .when(F.col("id") % 5 == 2, F.concat_ws("-", stem(0), stem(1), stem(2)))
        .when(F.col("id") % 5 == 3, F.repeat(repeated, F.lit(24)))
        .otherwise(F.concat(stem(0), stem(1), stem(2), F.pmod(number(3), F.lit(100)).cast("string")))
        .alias("value"),
        F.lit(False).alias("random"),
    )
    return random.unionByName(ordinary)


def _place(text: Column, i) -> Column:
    """Place of a text's i-th character in the alphabet, from 1; 0 for other characters."""
    return F.position(F.substr(text, i, F.lit(1)), F.lit(ALPHABET))


def train(samples: DataFrame, smooth: float = 0.5) -> list[float]:
    """Log likelihood ratios of all character steps, as a table over the alphabet's pairs.

    Spark counts the steps of the samples (value, random); nulls and characters outside the alphabet
    are passed over. The table has as many entries as the alphabet squared.
    """
    size, value = len(ALPHABET), F.col("value")
    pairs = F.transform(
        F.sequence(F.lit(1), F.length(value) - 1),
        lambda i: F.struct(_place(value, i).alias("a"), _place(value, i + 1).alias("b")),
    )
    steps = samples.where(F.length(value) > 1).select("random", F.inline(pairs))
    n = np.full((2, size, size), smooth)
    for row in steps.where("a > 0 and b > 0").groupBy("random", "a", "b").count().collect():
        n[int(row["random"]), row["a"] - 1, row["b"] - 1] += row["count"]
    logs = np.log(n / n.sum(axis=2, keepdims=True))
    return (logs[1] - logs[0]).ravel().tolist()


def _steps(value: Column, table: list[float]) -> Column:
    """The log likelihood ratios of a string's character steps; others than the alphabet's say nothing.

    The characters are numbered once, so the work grows with the string's length and not its square.
    """
    ratios = F.split(F.lit(" ".join(f"{x:.6f}" for x in table)), " ").cast("array<double>")
    places = F.transform(F.split(value, ""), lambda c: F.when(c == "", 0).otherwise(F.position(c, F.lit(ALPHABET))))

    def steps(p):
        def step(i):
            a, b = F.get(p, i - 1), F.get(p, i)
            return F.when((a > 0) & (b > 0), F.get(ratios, (a - 1) * len(ALPHABET) + b - 1)).otherwise(F.lit(0.0))

        none = F.array().cast("array<double>")
        return F.when(F.size(p) > 1, F.transform(F.sequence(F.lit(1), F.size(p) - 1), step)).otherwise(none)

    return _let(places, steps)


def likelihood_ratio(value: Column, table: list[float]) -> Column:
    """Mean log likelihood ratio of a string's character steps."""
    return _let(_steps(value, table), lambda steps: _mean(steps, F.length(value) - 1))


def _mean(steps: Column, n: Column) -> Column:
    return F.when(n > 0, F.aggregate(steps, F.lit(0.0), lambda t, x: t + x) / n).otherwise(F.lit(0.0))


STRETCH = "array<struct<low:int,high:int>>"


def _stretches(value: Column, steps: Column, threshold: float, least: Column) -> Column:
    """``low, high`` of the stretches of a string whose sum of ratios above the threshold is greatest.

    A stretch ends where the sum is used up, or has lost what makes a shortest secret. It counts when
    its ratios sum to at least that. Its ends move to the nearest separator, outwards when that takes
    in no more of the word there than the stretch already holds, else inwards.
    """
    none = F.array().cast(STRETCH)
    need = F.lit(threshold) * (least - 1)

    def closed(acc):
        found = F.struct(acc["low"].alias("low"), (acc["stop"] + 1).alias("high"))
        enough = acc["best"] + F.lit(threshold) * (acc["stop"] + 1 - acc["low"]) >= need
        return F.when((acc["best"] > 0) & enough, F.concat(acc["all"], F.array(found))).otherwise(acc["all"])

    def add(acc, i):
        total = acc["sum"] + F.get(steps, i - 1) - F.lit(threshold)
        ends, higher = (total <= 0) | (total < acc["best"] - need), total > acc["best"]
        return F.struct(
            F.when(ends, F.lit(0.0)).otherwise(total).alias("sum"),
            F.when(ends, i + 1).otherwise(acc["low"]).alias("low"),
            F.when(ends, F.lit(0.0)).when(higher, total).otherwise(acc["best"]).alias("best"),
            F.when(ends | higher, i).otherwise(acc["stop"]).alias("stop"),
            F.when(ends, closed(acc)).otherwise(acc["all"]).alias("all"),
        )

    begin = F.struct(
        F.lit(0.0).alias("sum"), F.lit(1).alias("low"), F.lit(0.0).alias("best"), F.lit(0).alias("stop"), none.alias("all")
    )
    found = F.aggregate(F.sequence(F.lit(1), F.length(value) - 1), begin, add, closed)
    size = lambda text, pattern: F.length(F.regexp_extract(text, pattern, 0))

    def moved(s):
        inner = F.substr(value, s["low"], s["high"] - s["low"] + 1)
        head, tail = size(inner, "^[A-Za-z0-9]*"), size(inner, "[A-Za-z0-9]*$")
        before = size(F.substr(value, F.lit(1), s["low"] - 1), "[A-Za-z0-9]*$")
        after = size(F.substr(value, s["high"] + 1, F.length(value)), "^[A-Za-z0-9]*")
        alone = head == F.length(inner)
        return F.struct(
            F.when(alone | (before <= head), s["low"] - before).otherwise(s["low"] + head + 1).alias("low"),
            F.when(alone | (after <= tail), s["high"] + after).otherwise(s["high"] - tail - 1).alias("high"),
        )

    return F.filter(F.transform(found, moved), lambda s: s["high"] - s["low"] + 1 >= least)


def _pieces(span: Column, base: Column) -> Column:
    """``low, high`` of the characters of a span that lie in none of the sorted base spans."""
    cuts = F.filter(base, lambda b: (span["start"] < b["end"]) & (b["start"] < span["end"]))
    piece = lambda low, high: F.array(F.struct(low.alias("low"), high.alias("high")))

    def cut(acc, b):
        more = F.concat(acc["all"], piece(acc["at"], b["start"]))
        rest = F.when(b["start"] > acc["at"], more).otherwise(acc["all"])
        return F.struct(F.greatest(acc["at"], b["end"]).alias("at"), rest.alias("all"))

    def last(acc):
        return F.when(acc["at"] < span["end"], F.concat(acc["all"], piece(acc["at"], span["end"]))).otherwise(acc["all"])

    begin = F.struct(span["start"].alias("at"), F.array().cast(STRETCH).alias("all"))
    return F.aggregate(cuts, begin, cut, last)


def _random_spans(text: Column, base: Column, table: list[float], threshold: float) -> Column:
    """Spans of the random-looking strings, without what patterns have matched of them."""
    rank = F.lit(KINDS.index("markov") + 1)

    def of_piece(span, piece):
        value = F.substr(text, piece["low"] + 1, piece["high"] - piece["low"])
        return _let(value, lambda v: _let(_steps(v, table), lambda steps: found(span, piece, v, steps)))

    def found(span, piece, value, steps):
        least = F.when(F.length(value) == F.length(span["value"]), F.lit(LEAST)).otherwise(F.lit(REST))
        whole = F.array(F.struct(F.lit(1).alias("low"), F.length(value).alias("high")))
        random = _mean(steps, F.length(value) - 1) >= threshold
        spans = F.when(F.length(value) < least, F.array().cast(STRETCH)).when(random, whole).otherwise(
            _stretches(value, steps, threshold, least)
        )
        return F.transform(spans, lambda s: F.struct(
            (piece["low"] + s["low"] - 1).alias("start"), rank.alias("rank"), (piece["low"] + s["high"]).alias("end"),
            F.substr(value, s["low"], s["high"] - s["low"] + 1).alias("value"),
        ))

    of_span = lambda span: F.flatten(F.transform(_pieces(span, base), lambda p: of_piece(span, p)))
    return F.flatten(F.transform(pattern_spans(text, "markov", CANDIDATE), of_span))


def find_secrets(docs: DataFrame, table: list[float] | None = None, threshold: float = 0.6) -> DataFrame:
    """``docs`` (text, any others) with one more column ``secrets``: spans by start and kind.

    A span has ``start, rank, end, value``, in characters; ``KINDS[rank - 1]`` is its kind. Matches of
    a kind do not overlap, those of different kinds may. A random-looking string is one of 20 or more
    characters whose mean log likelihood ratio reaches the threshold, or the stretches of a longer one
    that would. What patterns match of it is left to them; the rest is judged from 6 characters on. Null
    and empty texts hold none. All columns stay; one called ``secrets`` is replaced. Rows are judged one by
    one, so repeated rows have the same spans and an empty table none; a run of any length is scored
    character by character, in time that grows with its length.
    """
    if table is None:
        table = train(labelled_samples(docs.sparkSession))
    docs = docs.drop("secrets")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    longer = lambda spans, n: F.filter(spans, lambda s: F.length(s["value"]) >= n)
    base = F.concat(
        longer(pattern_spans(text, "assign", ASSIGN, 2), 12),
        longer(pattern_spans(text, "access", ACCESS), 18),
        pattern_spans(text, "hex", HEX),
    )
    held = "base"
    while held in docs.columns:
        held += "_"
    odd = _random_spans(text, F.col(held), table, threshold)
    return docs.withColumn(held, F.array_sort(base)).withColumn("secrets", F.array_sort(F.concat(held, odd))).drop(held)


def redact(docs: DataFrame, mark: str = "[SECRET]", **options) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by a mark; overlapping spans get one mark.

    Texts without secrets stay as they are, null texts too; all other columns stay.
    """
    found = find_secrets(docs, **options)
    n = F.size("secrets")
    starts, ends = F.col("secrets.start"), F.col("secrets.end")
    before = lambda i: F.when(i > 0, F.array_max(F.slice(ends, F.lit(1), i))).otherwise(F.lit(0))

    def piece(i):
        low, high = before(i), F.get(starts, i)
        kept = F.concat(F.substr(F.col("text"), low + 1, high - low), F.lit(mark))
        return F.when((i == 0) | (high >= low), kept).otherwise(F.lit(""))

    pieces = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), piece), "")
    rest = F.substr(F.col("text"), F.array_max(ends) + 1, F.length("text"))
    cleaned = F.when(n > 0, F.concat(pieces, rest)).otherwise(F.col("text"))
    return found.withColumn("text", cleaned).drop("secrets")
