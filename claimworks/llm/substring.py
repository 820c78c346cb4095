"""Substring dedup by fixed-block anchors.

Reference blocks are the non-overlapping blocks of ``window // 2`` words of every document; any window
holds one of them whole. Every rolling window of block length is a probe. A block that also stands
elsewhere marks its places, the hits are extended to all windows around them, and of equal windows all
but the earliest go; runs of such windows are the maximal exact repeats.

Documents are grouped by ranges of ``doc_id``, so "earlier" between groups is a comparison of group
numbers. Two rounds go through the shuffle: block and probe keys (48 bits, checked later), then the
windows around hits (96 bits). Both send a key once per group, with the number of groups as the only
factor on a passage that everybody shares.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.llm import arrays as A
from claimworks.llm import rounds as R

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(R)

U64 = np.uint64
RESULT = "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept_text string"
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ("kept_text", pa.string()),
])


def drop_repeated_windows(
    docs: DataFrame, window: int = 20, group_bytes: int = 4 << 20, bucket_bytes: int = 16 << 20
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): words, removed words, removed runs and the kept text.

    A word goes when a window of ``window`` words that covers it also starts earlier: in a smaller
    doc_id, or earlier in the same document. Windows are judged on the input. Other columns of
    ``docs`` are not read. A null or empty text has no words and an empty kept text; a null doc_id
    comes before all others; rows of one doc_id are ordered by their text, so of fully equal rows one
    stays. An empty table gives no rows. ``group_bytes`` of text are held by one task at a time;
    all rows of one doc_id, and a single text however long, share a task.
    """
    groups, buckets = R.counts(R.text_bytes(docs, "text"), group_bytes, bucket_bytes)
    docs = _by_range(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), groups)
    probes = R.ask(docs, lambda t: _probes(t, window, buckets))
    hits = R.answer(probes, _shared_blocks)
    windows = R.ask_again(docs, hits, lambda t, bits: _windows(t, bits, window, buckets))
    earlier = R.answer(windows, _seen_before)
    return R.finish(
        docs, [hits, earlier], lambda t, bits, seen: _kept(t, bits, seen, window), RESULT, _ARROW
    )


def _by_range(docs: DataFrame, groups: int) -> DataFrame:
    """Adds the group number, ascending with doc_id; at most one bound per group comes to the driver."""
    cut = [i / groups for i in range(1, groups)]
    found = docs.agg(F.percentile_approx("doc_id", F.array(*map(F.lit, cut)), 100 * groups).alias("b")).head()["b"] if cut else []
    bounds = np.array(sorted(set(found or [])), np.int64)

    @F.pandas_udf("int")
    def number(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, ids.to_numpy(np.int64), "left").astype(np.int32))

    low = F.lit(-(1 << 63)).cast("long")
    return docs.withColumn(R.GROUP, number(F.coalesce("doc_id", low)))


def _sorted(table: pa.Table) -> pa.Table:
    order = pc.sort_indices(
        table.select(["doc_id", "text"]), [("doc_id", "ascending"), ("text", "ascending")], null_placement="at_start"
    )
    return table.take(order)


class _Group:
    """Words and window hashes of a group's documents, in order."""

    def __init__(self, table: pa.Table, window: int):
        self.table, self.window, self.block = _sorted(table), window, (window + 1) // 2
        self.data, self.offsets = A.texts(self.table.column("text"))
        self.starts, self.ends, self.first = A.words(self.data, self.offsets, A.SPACE)
        n = len(self.starts)
        self.doc = A.segment_of(self.first, n)
        self.left = self.first[1:][self.doc] - np.arange(n)  # words to the end of the document
        self.spans = A.Spans(A.word_hashes(self.data, self.starts, self.ends), A.BASE ^ 0x5A5A0)

    def blocks(self):
        """``(places, keys)`` of all probes."""
        at = np.flatnonzero(self.left >= self.block)
        return at, A.mix(self.spans.at(at, self.block)) >> U64(16)

    def windows(self, hits: np.ndarray):
        """``(places, first hash, second hash)`` of the windows around hits."""
        n = len(self.starts)
        before = np.concatenate(([0], np.cumsum(hits)))
        at = np.flatnonzero(self.left >= self.window)
        at = at[before[np.minimum(at + self.window - self.block + 1, n)] > before[at]]
        second = A.Spans(A.word_hashes(self.data, self.starts, self.ends, 7), A.BASE ^ 0x33CC4)
        return at, A.mix(self.spans.at(at, self.window)), A.mix(second.at(at, self.window)) >> U64(32)


def by_bucket(keys: np.ndarray, bits: int, buckets: int):
    """Slices of ascending keys; the bucket is a range of the key's leading bits."""
    top = (keys >> U64(bits - 20)).astype(np.int64) * buckets >> 20
    edges = np.searchsorted(top, np.arange(buckets + 1))
    return [(b, slice(edges[b], edges[b + 1])) for b in range(buckets) if edges[b + 1] > edges[b]]


def _grouped_blocks(group: _Group):
    at, keys = group.blocks()
    kept, back, n = np.unique(keys, return_inverse=True, return_counts=True)
    return at, kept, back, n


def _probes(table, window, buckets):
    group = _Group(table, window)
    at, keys, back, n = _grouped_blocks(group)
    anchor = np.zeros(len(keys), bool)
    in_doc = at - group.first[group.doc[at]]
    anchor[back[in_doc % group.block == 0]] = True
    marked = keys << U64(2) | anchor.astype(U64) << U64(1) | (n > 1).astype(U64)
    for bucket, part in by_bucket(keys, 48, buckets):
        yield bucket, A.pack(marked[part])


def _shared_blocks(groups, bodies):
    """For each key sent: stands a reference block here, and the key in two places?"""
    parts = [A.unpack(b) for b in bodies]
    every = np.concatenate(parts)
    _, back, n = np.unique(every >> U64(2), return_inverse=True, return_counts=True)
    anchor, twice = np.zeros(len(n), bool), n > 1
    anchor[back[(every & U64(2)) > 0]] = True
    twice[back[(every & U64(1)) > 0]] = True
    return split((anchor & twice)[back], [len(p) for p in parts])


def split(flags: np.ndarray, sizes: list[int]) -> list[bytes]:
    """Flags of several messages as one packed body each."""
    edges = np.cumsum(sizes)[:-1]
    return [len(f).to_bytes(8, "little") + np.packbits(f).tobytes() for f in np.split(flags, edges)]


def flags_of(bodies: list[bytes]) -> np.ndarray:
    made = [
        np.unpackbits(np.frombuffer(b, np.uint8, offset=8), count=int.from_bytes(b[:8], "little"))
        for b in bodies
    ]
    return np.concatenate(made).astype(bool) if made else np.zeros(0, bool)


def _candidates(table, bits, window):
    """The group and its windows around hits, with the distinct windows in ascending order."""
    group = _Group(table, window)
    at, _, back, _ = _grouped_blocks(group)
    hits = np.zeros(len(group.starts), bool)
    hits[at] = flags_of(bits)[back] if len(at) else False
    at, one, two = group.windows(hits)
    order = np.lexsort((at, two, one))
    new = np.ones(len(order), bool)
    a, b = one[order], two[order]
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    back = np.empty(len(order), np.int64)
    back[order] = np.cumsum(new) - 1
    lead = order[new]  # the earliest place of each distinct window
    return group, at, back, lead, one[lead], two[lead]


def _windows(table, bits, window, buckets):
    _, _, _, _, one, two = _candidates(table, bits, window)
    for bucket, part in by_bucket(one, 64, buckets):
        packed = A.pack(one[part])
        yield bucket, len(packed).to_bytes(8, "little") + packed + two[part].astype("<u4").tobytes()


def _seen_before(groups, bodies):
    """For each window sent: does an earlier group hold it?"""
    ones, twos = [], []
    for body in bodies:
        size = int.from_bytes(body[:8], "little")
        ones.append(A.unpack(body[8 : 8 + size]))
        twos.append(np.frombuffer(body, "<u4", offset=8 + size))
    one, two = np.concatenate(ones), np.concatenate(twos)
    owner = np.repeat(np.arange(len(groups)), [len(x) for x in ones])  # groups are ascending
    order = np.lexsort((owner, two, one))
    a, b = one[order], two[order]
    later = np.zeros(len(order), bool)
    later[1:] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    flags = np.empty(len(order), bool)
    flags[order] = later
    return split(flags, [len(x) for x in ones])


def _kept(table, bits, seen, window):
    group, at, back, lead, _, _ = _candidates(table, bits, window)
    repeated = np.ones(len(at), bool)
    repeated[lead] = False
    if len(at):
        repeated |= flags_of(seen)[back]
    n = len(group.starts)
    gone = A.covered(n, at[repeated], window)
    keep = ~gone
    # Kept words and one separator after each but the document's last kept word.
    steps = np.zeros(len(group.data) + 1, np.int64)
    steps[group.starts[keep]] += 1
    steps[group.ends[keep]] -= 1
    chosen = np.cumsum(steps[:-1]) > 0
    data = group.data.copy()
    kept_doc = group.doc[keep]
    tail = np.ones(len(kept_doc), bool)
    tail[:-1] = kept_doc[1:] != kept_doc[:-1]
    gaps = group.ends[keep][~tail]
    data[gaps] = 32
    chosen[gaps] = True
    sizes = np.concatenate(([0], np.cumsum(chosen)))[group.offsets]
    out = pa.LargeStringArray.from_buffers(
        len(group.offsets) - 1, pa.py_buffer(sizes.astype(np.int64).tobytes()), pa.py_buffer(data[chosen].tobytes())
    )
    n_words = np.diff(group.first)
    removed = np.diff(np.concatenate(([0], np.cumsum(gone)))[group.first])
    spans = doc_runs(gone, group.first, group.doc)
    return pa.table({
        "doc_id": group.table.column("doc_id"), "n_words": n_words, "n_removed": removed, "spans": spans,
        "kept_text": out.cast(pa.string()),
    })


def doc_runs(flags: np.ndarray, first: np.ndarray, doc: np.ndarray) -> pa.Array:
    """Runs of marked places, cut at document borders and counted from the document's start."""
    start, end = flags.copy(), flags.copy()
    start[1:] &= ~flags[:-1] | (doc[1:] != doc[:-1])
    end[:-1] &= ~flags[1:] | (doc[1:] != doc[:-1])
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    base = first[doc[starts]] if len(starts) else starts
    edges = np.searchsorted(starts, first).astype(np.int32)
    return pa.ListArray.from_arrays(
        edges, pa.StructArray.from_arrays([pa.array(starts - base), pa.array(ends - base)], ["start", "end"])
    )
