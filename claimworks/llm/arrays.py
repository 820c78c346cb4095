"""Text columns as numpy arrays: words, rolling hashes and compact sorted key lists.

All hashes are 64-bit words under wrap-around arithmetic. A span hash compares equal for equal spans
wherever they stand, so rolling windows cost three array operations. Worker functions travel by value.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def texts(column) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a text column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Truth table over byte values for inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


SPACE = byte_set((0x20, 0x20), (0x09, 0x0D))
BREAK = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))  # for lower-cased text


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A copy with the letters A-Z in lower case."""
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def words(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray):
    """``(starts, ends, first)`` of all words; words of document d are ``first[d]:first[d + 1]``."""
    inside = ~breaks[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    filled = offsets[1:] > offsets[:-1]
    at = offsets[:-1][filled]
    start[at] = inside[at]
    last = offsets[1:][filled] - 1
    end[last] = inside[last]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``base ** i`` and its inverse for i < n, kept by the worker between groups."""
    if base not in _POWERS or len(_POWERS[base][0]) < n:
        size = max(n, 1 << 16)
        pair = []
        for value in (base, pow(base, -1, 1 << 64)):
            steps = np.full(size, value, U64)
            steps[0] = 1
            pair.append(np.cumprod(steps))
        _POWERS[base] = tuple(pair)
    return _POWERS[base]


class Spans:
    """Prefix polynomial hashes of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray, base: int = BASE):
        up, self.down = powers(base, len(values) + 1)
        self.prefix = np.zeros(len(values) + 1, U64)
        np.cumsum(values * up[: len(values)], out=self.prefix[1:])

    def at(self, start: np.ndarray, length) -> np.ndarray:
        return (self.prefix[start + length] - self.prefix[start]) * self.down[start]

    def rolling(self, length: int) -> np.ndarray:
        """Hash of every window of a length."""
        n = len(self.prefix) - length
        if n <= 0:
            return np.zeros(0, U64)
        return (self.prefix[length:] - self.prefix[:n]) * self.down[:n]


def byte_values(salt: int) -> np.ndarray:
    """A random-looking 64-bit value for each byte."""
    return mix(np.arange(1, 257, dtype=U64) * U64(0xD1342543DE82EF95) + U64(salt))


def word_hashes(data, starts, ends, salt: int = 1) -> np.ndarray:
    spans = Spans(byte_values(salt)[data])
    return mix(spans.at(starts, ends - starts) + (ends - starts).astype(U64) * U64(salt * 2 + 1))


def segment_of(first: np.ndarray, n: int) -> np.ndarray:
    """The document of each of n words, from the documents' first words."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))[:n]


def pack(values: np.ndarray) -> bytes:
    """Ascending 64-bit values in little space: differences, byte planes, zstd."""
    steps = np.diff(values, prepend=U64(0)).astype("<u8")
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(body: bytes) -> np.ndarray:
    n = int.from_bytes(body[:8], "little")
    raw = pa.decompress(body[8:], decompressed_size=8 * n, codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel().astype(U64))


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return edges[::2], edges[1::2]


def covered(n: int, starts: np.ndarray, lengths) -> np.ndarray:
    """Which of n places lie in any of the spans."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + lengths, -1)
    return np.cumsum(steps[:-1]) > 0
