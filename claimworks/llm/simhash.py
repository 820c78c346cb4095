"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most 2r bits have a common neighbour at most r bits from either. So
every distinct fingerprint emits all values within r bits, the values are shuffled, and fingerprints
that meet at a value are verified and linked. Around one value lie at most as many fingerprints as the
ball has members, whatever the data; copies were merged before.
"""

from __future__ import annotations

import itertools
import sys

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from claimworks.llm import arrays as A
from claimworks.llm.components import components
from claimworks.llm.tables import digest, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLICE = 1 << 20  # bytes of text worked on at a time
BITS = 64


def fingerprints(
    docs: DataFrame, keep: list[str], shingle: int = 3, seed: int = 42, name: str = "fp"
) -> DataFrame:
    """The columns ``keep`` of ``docs`` and ``name``, the SimHash of ``text``'s words, as a signed long.

    A-Z are lowered; words are what stands between blanks. Each shingle of ``shingle`` words, repeats
    included, votes with its XXH64; a bit is set when more than half of the votes have it. A text of
    fewer words is one shingle; one without words, or null, has the fingerprint zero.
    """
    kept = [F.col(f"`{c}`") for c in keep]
    rows = docs.select(*kept, *([] if "text" in keep else ["text"]))
    place = rows.columns.index("text")

    def run(batches):
        for batch in batches:
            data, offsets = A.texts(batch.column(place))
            data = A.lower_ascii(data)
            out = np.zeros(batch.num_rows, np.uint64)
            cut = np.unique(np.searchsorted(offsets[:-1], np.arange(0, len(data) + 1, SLICE)))
            for low, high in itertools.pairwise([*cut.tolist(), batch.num_rows]):
                at = offsets[low : high + 1]
                out[low:high] = _votes(data[at[0] : at[-1]], at - at[0], shingle, seed)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(out.view(np.int64))], [*keep, name]
            )

    schema = StructType([*rows.select(*kept).schema, StructField(name, LongType())])
    return rows.mapInArrow(run, schema)


def _votes(data, offsets, shingle, seed) -> np.ndarray:
    starts, ends, first = A.words(data, offsets, A.SPACE)
    out = np.zeros(len(offsets) - 1, np.uint64)
    # One blank between words, so that a shingle is one slice.
    size = ends - starts + 1
    joined = np.full(int(size.sum()), 32, np.uint8)
    begin = np.cumsum(size) - size
    source = np.arange(len(joined)) - np.repeat(begin - starts, size)
    inside = source < np.repeat(ends, size)
    joined[inside] = data[source[inside]]
    text, stop = joined.tobytes(), begin + size - 1
    digest = xxhash.xxh64_intdigest
    for doc in range(len(out)):
        a, b = int(first[doc]), int(first[doc + 1])
        if a == b:
            continue
        width = min(shingle, b - a)
        spans = zip(begin[a : b - width + 1].tolist(), stop[a + width - 1 : b].tolist(), strict=True)
        votes = np.fromiter((digest(text[x:y], seed) for x, y in spans), np.uint64, b - a - width + 1)
        total = np.zeros(BITS, np.int64)
        for i in range(0, len(votes), 1 << 14):
            rows = votes[i : i + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8)
            total += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        set_bits = np.flatnonzero(2 * total > len(votes)).astype(np.uint64)
        out[doc] = np.bitwise_or.reduce(np.uint64(1) << set_bits) if len(set_bits) else 0
    return out


def links(fps: DataFrame, distance: int = 2) -> DataFrame:
    """All pairs ``a < b`` of distinct fingerprints (column ``fp``) at most ``distance`` bits apart."""
    met = _met(fps, distance).groupBy("value").agg(F.sort_array(F.collect_set("fp")).alias("all"))
    first = met.where(F.size("all") > 1).select("all", F.explode("all").alias("a"))
    pairs = first.select("a", F.explode(F.filter("all", lambda b: b > F.col("a"))).alias("b"))
    return pairs.where(_differ("a", "b") <= distance).distinct()


def _met(fps: DataFrame, distance: int) -> DataFrame:
    """Every distinct fingerprint with all values within half the distance, rounded up."""
    radius = (distance + 1) // 2
    masks = [
        sum(1 << b for b in bits) for r in range(radius + 1) for bits in itertools.combinations(range(BITS), r)
    ]
    signed = [m - (1 << BITS) if m >= 1 << (BITS - 1) else m for m in masks]
    ball = F.array(*[F.lit(m).cast("long") for m in signed])
    # As many parts as a shuffle has: the few bytes of fingerprints become many rows here.
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = fps.select("fp").distinct().repartition(parts)
    return spread.select("fp", F.explode(ball).alias("mask")).select(
        F.col("fp").bitwiseXOR(F.col("mask")).alias("value"), "fp"
    )


def _differ(a: str, b: str):
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def roots(fps: DataFrame, distance: int = 2) -> DataFrame:
    """``fp, root``: every distinct fingerprint with the one that stands for its component."""
    nodes = fps.select("fp").distinct()
    label = components(links(nodes, distance)).withColumnRenamed("node", "fp")
    return nodes.join(label, "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): ``doc_id, fp, component_id``.

    Documents are linked when their fingerprints differ in at most ``distance`` bits; a component's id
    is its smallest doc_id. Rows of one fingerprint are one node, so copies cost nothing. A null doc_id
    is a document like any other and never the smallest id unless the component has no other; a
    repeated row belongs to its twin's component. Other columns are not read. Empty table, no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    rows = stored(fingerprints(rows, ["doc_id"], shingle), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least")).join(roots(rows, distance), "fp")
    smallest = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = nodes.select("fp", "root").join(smallest, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """``docs`` with one document of each component: the smallest doc_id, then the smallest digest.

    A null doc_id comes last; of fully equal rows one stays. All columns stay. Only keys are compared
    to find the documents that stay: first those of equal fingerprints, then those of a component, by
    aggregates that combine before the shuffle.
    """
    keys, none = ["__k1", "__k2"], F.col("doc_id").isNull()
    rows = docs.select("*", *digest("doc_id", "text"))
    rows = stored(fingerprints(rows, rows.columns, shingle, name="__fp"), "fingerprints")
    fps = rows.select(F.col("__fp").alias("fp"), none.alias("none"), "doc_id", *keys)
    first = F.struct("none", "doc_id", *keys)
    best = fps.groupBy("fp").agg(F.min(first).alias("best"))
    best = best.join(roots(fps, distance), "fp").groupBy("root").agg(F.min("best").alias("best"))
    return rows.join(best.select("best.__k1", "best.__k2"), keys).dropDuplicates(keys).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
