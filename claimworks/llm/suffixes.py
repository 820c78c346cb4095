"""Suffix-array dedup of bytes: suffixes are sorted by mergesort with hash comparisons.

Two suffixes are compared by their longest common extension, found by binary search over prefix
polynomial hashes, so a comparison takes a logarithm of the length. Neighbours in sorted order that
agree on ``length`` bytes are repeats, and are then compared byte by byte.

Sorting every suffix of the corpus would move each byte hundreds of times. So suffixes meet by a
landmark first: the smallest hashed ``landmark``-byte string inside a suffix's first ``length`` bytes.
Equal strings have equal landmarks at equal distance, so only suffixes of one landmark and distance are
sorted together, and landmarks that stand once (most of them) need no sorting. Consecutive suffixes of
a landmark travel as one piece of text, once per group of documents and distinct piece.
"""

from __future__ import annotations

import itertools
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.llm import arrays as A
from claimworks.llm import rounds as R
from claimworks.llm.substring import by_bucket, doc_runs, flags_of, split

cloudpickle.register_pickle_by_value(sys.modules[__name__])

U64 = np.uint64
PLACE = 28  # bits for a place in a group of documents
CHUNK = 1 << 20  # bytes of pieces sorted at a time
RESULT = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ("kept", pa.binary()),
])


def drop_repeated_bytes(
    docs: DataFrame, length: int = 200, group_bytes: int = 2 << 20, bucket_bytes: int = 16 << 20
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): bytes, removed bytes, removed runs and the kept bytes.

    A byte goes when it is covered by a string of ``length`` bytes that also starts anywhere else, in
    the same document or another; strings never cross documents and are judged on the input. Other
    columns are not read. A null text is empty; empty and short texts stay as they are; doc_id may be
    null or repeated, a repeated row is another document. An empty table gives no rows. Kept bytes may
    end inside a character, so they are binary. One group of ``group_bytes`` is held at a time, more
    where a single text is longer (up to 256 MB).
    """
    if length < 2:
        raise ValueError("length must be at least 2")
    groups, buckets = R.counts(R.text_bytes(docs, "text"), group_bytes, bucket_bytes)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    docs = docs.withColumn(
        R.GROUP, F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int")
    )
    landmarks = R.ask(docs, lambda t: _landmarks(t, length, buckets))
    shared = R.answer(landmarks, _shared)
    pieces = R.ask_again(docs, shared, lambda t, bits: _pieces(t, bits, length, buckets))
    repeats = R.answer(pieces, lambda groups, bodies: _repeats(bodies, length))
    return R.finish(
        docs, [shared, repeats], lambda t, bits, found: _kept(t, bits, found, length), RESULT, _ARROW
    )


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


class _Group:
    """The landmarks of a group's documents; ``low:high + 1`` are the suffixes of one landmark."""

    def __init__(self, table: pa.Table, length: int):
        self.table = table
        self.data, self.offsets = A.texts(table.column("text"))
        n, mark = len(self.data), max(1, length // 3)
        if n >= 1 << PLACE:
            raise ValueError("a group of documents is too large; lower group_bytes")
        none = np.zeros(0, np.int64)
        self.low = self.high = self.mark = none
        self.key = np.zeros(0, U64)
        self.spans = A.Spans(A.byte_values(3)[self.data])
        if n < length:
            return
        hashes = A.mix(self.spans.rolling(mark))
        places = np.arange(len(hashes), dtype=U64)
        low_bits = U64((1 << PLACE) - 1)
        least = sliding_min((hashes & ~low_bits) | places, length - mark + 1)
        at = (least & low_bits).astype(np.int64)
        ends = np.repeat(self.offsets[1:], np.diff(self.offsets))[: len(at)]
        whole = np.arange(len(at)) + length <= ends
        new = whole.copy()
        new[1:] &= ~whole[:-1] | (at[1:] != at[:-1])
        last = whole.copy()
        last[:-1] &= ~whole[1:] | (at[1:] != at[:-1])
        self.low, self.high = np.flatnonzero(new), np.flatnonzero(last)
        self.mark = at[self.low]
        self.key = A.mix(hashes[self.mark])  # the smallest hashes, spread again over all buckets

    def keys(self):
        return np.unique(self.key, return_inverse=True, return_counts=True)


def _landmarks(table, length, buckets):
    keys, _, n = _Group(table, length).keys()
    packed = (keys >> U64(1)) << U64(1) | (n > 1).astype(U64)
    # Keys that differ in the last bit only share an entry, with the flag for two places.
    kept, back = np.unique(packed >> U64(1), return_inverse=True)
    twice = np.bincount(back, minlength=len(kept)) > 1
    twice[back[(packed & U64(1)) > 0]] = True
    for bucket, part in by_bucket(kept, 63, buckets):
        yield bucket, A.pack(kept[part] << U64(1) | twice[part].astype(U64))


def _shared(groups, bodies):
    """For each landmark sent: does it stand in two places?"""
    parts = [A.unpack(b) for b in bodies]
    every = np.concatenate(parts)
    _, back, n = np.unique(every >> U64(1), return_inverse=True, return_counts=True)
    twice = n > 1
    twice[back[(every & U64(1)) > 0]] = True
    return split(twice[back], [len(p) for p in parts])


class _Pieces:
    """The distinct pieces of text around shared landmarks, in an order set by their content."""

    def __init__(self, table, bits, length):
        self.group = group = _Group(table, length)
        kept, back = np.unique(group.key >> U64(1), return_inverse=True)
        shared = flags_of(bits)[back] if len(kept) else np.zeros(0, bool)
        self.low, self.high = group.low[shared], group.high[shared]
        key, left = group.key[shared], group.mark[shared] - self.low
        size = self.high - self.low + length
        one = A.mix(group.spans.at(self.low, size))
        two = A.mix(A.Spans(A.byte_values(11)[group.data]).at(self.low, size))
        order = np.lexsort((left, size, two, one, key))
        new = np.ones(len(order), bool)
        if len(order):
            new[1:] = False
            for x in (key, one, two, size, left):
                y = x[order]
                new[1:] |= y[1:] != y[:-1]
        number = np.cumsum(new) - 1
        self.back = np.empty(len(order), np.int64)
        self.back[order] = number
        lead = order[new]
        self.count = np.bincount(number, minlength=len(lead))
        self.key, self.left, self.size, self.start = key[lead], left[lead], size[lead], self.low[lead]


def _gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of several spans, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _pieces(table, bits, length, buckets):
    pieces = _Pieces(table, bits, length)
    for bucket, part in by_bucket(pieces.key, 64, buckets):
        head = np.stack([
            pieces.left[part], pieces.size[part] - length + 1, np.minimum(pieces.count[part], 2)
        ]).astype("<u4")
        keys = A.pack(pieces.key[part])
        text = pieces.group.data[_gather(pieces.start[part], pieces.size[part])].tobytes()
        sizes = np.array([head.shape[1], len(keys), len(text)], "<u8").tobytes()
        yield bucket, sizes + head.tobytes() + keys + pa.compress(text, codec="zstd", asbytes=True)


def _open(body: bytes):
    n, keys, text = (int(x) for x in np.frombuffer(body, "<u8", 3))
    head = np.frombuffer(body, "<u4", 3 * n, 24).reshape(3, n).astype(np.int64)
    at = 24 + 12 * n
    raw = pa.decompress(body[at + keys :], decompressed_size=text, codec="zstd", asbytes=True)
    return A.unpack(body[at : at + keys]), head, np.frombuffer(raw, np.uint8)


def _repeats(bodies, length):
    """For each piece sent: which of its suffixes agree on ``length`` bytes with another's?

    Pieces are worked on in ranges of landmarks, each with about ``CHUNK`` bytes of text.
    """
    opened = [_open(b) for b in bodies]
    key = np.concatenate([k for k, _, _ in opened])
    left, width, count = np.concatenate([h for _, h, _ in opened], axis=1)
    text = np.concatenate([t for _, _, t in opened])
    sizes = [int(h[1].sum()) for _, h, _ in opened]
    del opened
    size = width + length - 1
    start = np.cumsum(size) - size
    flags_at = np.cumsum(width) - width
    flags = np.zeros(int(width.sum()), bool)
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    edge = np.flatnonzero(np.concatenate(([True], sorted_key[1:] != sorted_key[:-1])))
    before = np.cumsum(size[order]) - size[order]
    cut = edge[np.unique(before[edge] // CHUNK, return_index=True)[1]]
    for low, high in itertools.pairwise([*cut.tolist(), len(order)]):
        own = order[low:high]
        part = text[_gather(start[own], size[own])]
        flags[_gather(flags_at[own], width[own])] = _sorted_repeats(
            part, key[own], left[own], width[own], count[own], length
        )
    return split(flags, sizes)


def _sorted_repeats(text, key, left, width, count, length) -> np.ndarray:
    """Flags of all suffixes of some landmarks' pieces, which lie in ``text`` one after another."""
    size = width + length - 1
    start = np.cumsum(size) - size
    two = A.mix(A.Spans(A.byte_values(11)[text]).at(start, size))
    spans = A.Spans(A.byte_values(5)[text])
    one = A.mix(spans.at(start, size))
    order = np.lexsort((two, one, width, left, key))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for x in (key, left, width, one, two):
        y = x[order]
        new[1:] |= y[1:] != y[:-1]
    number = np.cumsum(new) - 1
    back = np.empty(len(order), np.int64)
    back[order] = number
    lead = order[new]
    copies = np.bincount(back, weights=count, minlength=len(lead)) > 1
    flags_at = np.cumsum(width[lead]) - width[lead]
    flags = np.repeat(copies, width[lead])

    # Suffixes of landmarks with several distinct pieces, laid out by landmark and distance.
    _, which, n = np.unique(key[lead], return_inverse=True, return_counts=True)
    several = np.flatnonzero(n[which] > 1)
    w = width[lead][several]
    step = _gather(np.zeros(len(w), np.int64), w)
    piece = np.repeat(several, w)
    place = start[lead][piece] + step
    far = int(left.max(initial=0)) + 1
    cell = which[piece] * far + left[lead][piece] - step
    order = np.argsort(cell, kind="stable")
    cell, place, slot = cell[order], place[order], (flags_at[piece] + step)[order]
    edge = np.flatnonzero(np.concatenate((np.ones(min(1, len(cell)), bool), cell[1:] != cell[:-1])))
    sizes = np.diff(np.append(edge, len(cell)))
    full = np.repeat(sizes > 1, sizes)
    place, slot, sizes = place[full], slot[full], sizes[sizes > 1]
    if len(place):
        first = np.repeat(np.cumsum(sizes) - sizes, sizes)
        in_order = sort_suffixes(text, spans, place, first, np.repeat(sizes, sizes), length)
        place, slot = place[in_order], slot[in_order]
        same = np.flatnonzero(first[1:] == first[:-1])
        same = same[common(spans, place[same], place[same + 1], length) >= length]
        same = same[_equal(text, place[same], place[same + 1], length)]
        flags[slot[same]] = True
        flags[slot[same + 1]] = True
    return flags[_gather(flags_at[back], width)]


def common(spans: A.Spans, x: np.ndarray, y: np.ndarray, limit: int) -> np.ndarray:
    """Longest common extension, up to a limit: binary search over prefix hashes."""
    got = np.zeros(len(x), np.int64)
    for bit in reversed(range(int(limit).bit_length())):
        step = np.minimum(1 << bit, limit - got)
        got += np.where(spans.at(x + got, step) == spans.at(y + got, step), step, 0)
    return got


def sort_suffixes(text, spans, place, first, size, limit) -> np.ndarray:
    """Bottom-up mergesort inside cells; all merges of a level run as one array operation.

    ``first`` and ``size`` give each suffix its cell. Each suffix finds its rank in the sibling run by
    binary search; equal suffixes keep their order.
    """
    order = np.arange(len(place))
    run = 1
    while run < size.max(initial=0):
        at = np.flatnonzero(size > run)
        own, cell, most = order[at], first[at], size[at]
        j = at - cell
        odd = (j // run) % 2 == 1
        base = (j // run ^ 1) * run
        low, high = np.minimum(base, most), np.minimum(base + run, most)
        begin = low.copy()
        x = place[own]
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            y = place[order[cell[open_] + middle]]
            z = x[open_]
            shared = common(spans, y, z, limit)
            whole = shared >= limit
            differ = np.where(whole, 0, shared)
            before = np.where(whole, odd[open_], text[y + differ] < text[z + differ])
            low[open_] = np.where(before, middle + 1, low[open_])
            high[open_] = np.where(before, high[open_], middle)
        merged = order.copy()
        merged[cell + j // (2 * run) * (2 * run) + j % run + (low - begin)] = own
        order = merged
        run *= 2
    return order


def _equal(text, x, y, length) -> np.ndarray:
    """Byte by byte, in blocks."""
    if not len(x):
        return np.zeros(0, bool)
    views = np.lib.stride_tricks.sliding_window_view(text, length)
    blocks = [slice(i, i + 16384) for i in range(0, len(x), 16384)]
    return np.concatenate([(views[x[b]] == views[y[b]]).all(axis=1) for b in blocks])


def _kept(table, bits, found, length):
    pieces = _Pieces(table, bits, length)
    group = pieces.group
    width = pieces.size - length + 1
    flags = flags_of(found)
    at = np.cumsum(width) - width
    own = width[pieces.back]
    hit = flags[_gather(at[pieces.back], own)] if len(flags) else np.zeros(0, bool)
    gone = A.covered(len(group.data), _gather(pieces.low, own)[hit], length)
    sizes = np.concatenate(([0], np.cumsum(~gone)))[group.offsets]
    kept = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), table.num_rows,
        [None, pa.py_buffer(sizes.astype(np.int64).tobytes()), pa.py_buffer(group.data[~gone].tobytes())],
    )
    doc = np.repeat(np.arange(table.num_rows), np.diff(group.offsets))
    n_bytes = np.diff(group.offsets)
    return pa.table({
        "doc_id": table.column("doc_id"), "n_bytes": n_bytes, "n_removed": n_bytes - np.diff(sizes),
        "spans": doc_runs(gone, group.offsets, doc), "kept": kept.cast(pa.binary()),
    })
