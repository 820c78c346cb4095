"""Mixing sources to target weights: subset-sum budget fitting on exact length counts.

A source's target is whole passes over all its documents and a remaining budget. The budget is spent
on document counts per exact length: a proportional share of every length first, then the rest by
bounded-knapsack dynamic programming over what is left of each length; where that misses, fixed documents
are exchanged until no choice comes nearer. Which documents of a length are
taken is decided by a seeded order. Only counts per (source, length, slice of the order) are gathered;
a source's histogram has at most as many entries as it has different lengths.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimworks.llm.tables import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

EXACT = 1 << 16  # words that the dynamic programme fits; larger budgets are spent greedily down to it


def word_count(text: str):
    """Number of blank-separated words; a null text has none."""
    blanks = F.translate(F.coalesce(F.col(text), F.lit("")), "\t\n\x0b\x0c\r", "     ")
    trimmed = F.trim(blanks)
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, " +"))).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``none, name, source_size, target`` for rows of (none, name, size): null sources have ``none`` set.

    Sources by code point, null last, take the weights in turn and share ``share`` times all words. A
    target stops at ``most`` times its source's words; the excess is shared by weight until none is
    above. The driver sees one sum per step; steps end when no further source stops.
    """
    per = stored(sizes.groupBy("none", "name").agg(F.sum("size").alias("source_size")), "sources")
    ranked = stored(_ranked(per), "ranked")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("rank", F.lit(len(weights))).cast("int") + 1)
    ranked = ranked.withColumn("weight", weight).withColumn("limit", most * F.col("source_size"))
    budget = share * (ranked.agg(F.sum("source_size")).head()[0] or 0)
    # Sources stop in order of limit per weight, so a level says who has stopped: limit <= level * weight.
    level, stopped = 0.0, -1
    while True:
        full = F.col("limit") <= F.lit(level) * F.col("weight")
        n, spent, rest = ranked.agg(
            F.sum(full.cast("long")), F.sum(F.when(full, F.col("limit"))), F.sum(F.when(~full, F.col("weight")))
        ).head()
        if n is None or n == stopped or not rest:
            break
        stopped, level = n, max(0.0, budget - (spent or 0.0)) / rest
    return ranked.select(
        "none", "name", "source_size", F.least("limit", F.lit(level) * F.col("weight")).alias("target")
    )


def _ranked(sources: DataFrame) -> DataFrame:
    """Adds the rank by code point, nulls last, without bringing all sources to one task."""
    order = ["none", "name"]
    dealt = stored(
        sources.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()),
        "dealt",
    )
    counts = {r["__part"]: r["n"] for r in dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, total = {}, 0
    for part in sorted(counts):
        before[part], total = total, total + counts[part]
    base = F.create_map(*[F.lit(x) for pair in before.items() for x in pair]) if before else None
    within = F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1
    rank = within if base is None else within + F.element_at(base, F.col("__part"))
    return dealt.withColumn("rank", rank).drop("__part")


def fit_counts(length: np.ndarray, n: np.ndarray, budget: float, exact: int = EXACT) -> np.ndarray:
    """How many documents of each length to take, so that their words come nearest the budget."""
    order = np.argsort(-length)
    size, have = length[order].astype(np.int64), n[order].astype(np.int64)
    total = int((size * have).sum())
    budget = int(round(min(max(budget, 0), total)))
    if not total:
        return np.zeros(len(length), np.int64)
    take = np.array([int(c) * budget // total for c in have], np.int64)
    rest = budget - int((size * take).sum())
    for i in range(len(size)):
        if rest <= exact or size[i] == 0:
            break
        more = min(int(have[i] - take[i]), rest // int(size[i]))
        take[i] += more
        rest -= more * int(size[i])
    left = have - take
    if rest <= exact:
        take += _knapsack(size, left, rest)
    elif (fits := np.flatnonzero((left > 0) & (size > 0))).size:
        least = fits[-1]  # all lengths within reach are used up: one more if that is nearer
        take[least] += int(size[least]) - rest < rest
    out = np.empty(len(length), np.int64)
    out[order] = take
    return out


def _knapsack(size, left, goal) -> np.ndarray:
    """Counts whose sum is nearest the goal, from bounded numbers of each size.

    Sums are a bit set; each size enters in powers of two. ``made_by`` keeps the item that first
    reached a sum, so the items of a sum are found by walking back.
    """
    out = np.zeros(len(size), np.int64)
    if goal <= 0:
        return out
    top = 2 * goal
    mask, reach = (1 << (top + 1)) - 1, 1
    made_by = np.full(top + 1, -1, np.int64)
    items = []
    for i in np.flatnonzero((left > 0) & (size > 0) & (size <= top))[::-1].tolist():
        rest, chunk = min(int(left[i]), top // int(size[i])), 1
        while rest > 0 and not reach >> goal & 1:
            part = min(chunk, rest)
            weight = part * int(size[i])
            new = (reach << weight) & mask & ~reach
            if new:
                raw = np.frombuffer(new.to_bytes(top // 8 + 1, "little"), np.uint8)
                made_by[np.flatnonzero(np.unpackbits(raw, bitorder="little")[: top + 1])] = len(items)
                items.append((i, part, weight))
                reach |= new
            rest, chunk = rest - part, chunk * 2
        if reach >> goal & 1:
            break
    at = next(x for d in range(goal + 1) for x in (goal - d, goal + d) if reach >> x & 1)
    while at:
        i, part, weight = items[made_by[at]]
        out[i] += part
        at -= weight
    return out


def nearest_counts(length: np.ndarray, n: np.ndarray, budget: float) -> np.ndarray:
    """As ``fit_counts``, and no other choice of documents comes nearer the budget.

    Where the fit misses, documents are exchanged: a few of some lengths first, then ever more, in the
    end all of all lengths. A miss that the lengths' common divisor forces is known to be least.
    """
    take = fit_counts(length, n, budget)
    size, have = length.astype(np.int64), n.astype(np.int64)
    used = np.flatnonzero((size > 0) & (have > 0))
    if not used.size:
        return take
    goal = int(round(min(max(budget, 0), int((size * have).sum()))))
    step = int(np.gcd.reduce(size[used]))
    least = min(goal % step, -goal % step)
    free, wide = 1, min(8, used.size)
    while abs(goal - int((size * take).sum())) > least:
        some = used[np.linspace(0, used.size - 1, wide).astype(np.int64)]
        low = np.maximum(take[some] - free, 0)
        high = np.minimum(take[some] + free, have[some])
        kept = int((size * take).sum()) - int((size[some] * (take[some] - low)).sum())
        miss = abs(goal - int((size * take).sum()))
        better = _exchange(size[some], high - low, goal - kept, miss, least)
        if better is not None:
            take[some] = low + better
        if wide == used.size and (low == 0).all() and (high == have[some]).all():
            break
        free, wide = 2 * free, min(2 * wide, used.size)
    return take


def _exchange(size, have, goal, miss, least):
    """Counts whose sum is nearest the goal if it is nearer than ``miss``; any found at ``least`` will do.

    Sums that can no longer come nearer are dropped, so only those about the goal are held.
    """
    items = []
    for i in np.argsort(-size).tolist():
        rest, chunk = int(have[i]), 1
        while rest > 0:
            items.append((i, min(chunk, rest)))
            rest, chunk = rest - items[-1][1], chunk * 2
    left = sum(int(size[i]) * part for i, part in items)
    sums, made, found = np.zeros(1, np.int64), [], None
    if abs(goal) < miss:
        found, miss = 0, abs(goal)
    for i, part in items:
        weight = int(size[i]) * part
        left -= weight
        new = sums + weight
        new = np.setdiff1d(new[new < goal + miss], sums, assume_unique=True)
        made.append(new)
        sums = np.union1d(sums, new)
        if new.size:
            nearest = int(new[np.abs(new - goal).argmin()])
            if abs(nearest - goal) < miss:
                found, miss = nearest, abs(nearest - goal)
        if miss <= least:
            break
        sums = sums[(sums < goal + miss) & (sums > goal - miss - left)]
    if found is None:
        return None
    out = np.zeros(len(size), np.int64)
    for (i, part), new in reversed(list(zip(items, made, strict=False))):
        at = np.searchsorted(new, found)
        if at < len(new) and new[at] == found:
            out[i] += part
            found -= int(size[i]) * part
    return out


def mix(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: int = 17
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, source): ``doc_id, source, size, source_size, target, copies``.

    ``copies`` says how often the mix takes the document, 0 to ``most``; a source's taken words come
    as near its target as whole documents allow. Null and empty texts have size 0 and are never taken
    beyond the whole passes; a null source is a source. Rows with equal doc_id, source and size are
    ordered among themselves, so equal rows stay apart and reruns agree. Empty table, no rows. Other
    columns are not read.
    """
    rows = docs.select(
        F.col("doc_id").cast("long"), word_count("text").alias("size"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("name"), F.col("source").isNull().alias("none"),
        F.xxhash64(F.lit(seed), "doc_id", "source", F.xxhash64("text")).alias("order"),
    )
    rows = stored(rows.withColumn("slice", F.shiftrightunsigned("order", 54).cast("int")), "sizes")
    targets = stored(source_targets(rows.select("none", "name", "size"), weights, share, most), "targets")

    slices = rows.groupBy("none", "name", "size", "slice").agg(F.count(F.lit(1)).alias("n"))
    slices = stored(slices, "slices")
    lengths = slices.groupBy("none", "name", "size").agg(F.sum("n").alias("n"))

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        whole, target = int(frame["source_size"].iloc[0]), float(frame["target"].iloc[0])
        passes = min(int(target // whole), most) if whole else 0
        rest = 0.0 if passes >= most else target - passes * whole
        frame["chosen"] = nearest_counts(frame["size"].to_numpy(), frame["n"].to_numpy(), rest)
        frame["passes"] = passes
        return frame[["none", "name", "size", "source_size", "target", "passes", "chosen"]]

    schema = "none boolean, name string, size long, source_size long, target double, passes long, chosen long"
    known = lengths.join(targets, ["none", "name"])
    plan = stored(known.groupBy("none", "name").applyInPandas(fit, schema), "plan")
    earlier = Window.partitionBy("none", "name", "size").orderBy("slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    need = F.greatest(F.lit(0), F.least(F.col("chosen") - F.col("before"), F.col("n")))
    cuts = slices.withColumn("before", before).join(plan, ["none", "name", "size"]).withColumn("need", need)
    joined = rows.join(cuts.drop("before", "chosen"), ["none", "name", "size", "slice"])
    cut = (F.col("need") > 0) & (F.col("need") < F.col("n"))
    place = F.row_number().over(
        Window.partitionBy("none", "name", "size", "slice").orderBy("order", "doc_id")
    )
    whole = joined.where(~cut).withColumn("copies", F.col("passes") + (F.col("need") > 0).cast("long"))
    split = joined.where(cut).withColumn("copies", F.col("passes") + (place <= F.col("need")).cast("long"))
    return whole.unionByName(split).select(
        "doc_id", F.when(~F.col("none"), F.col("name")).alias("source"), "size", "source_size", "target", "copies"
    )
