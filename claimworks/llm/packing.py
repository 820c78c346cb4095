"""Packing of tokenised texts into sequences of near-equal length by multiway differencing.

Texts are tokenised where they lie, and every task packs its own documents in lots of bounded size, so
nothing is shuffled or stored. Of a document, whole sequences are cut off first; what remains of all
documents of a lot is dealt by the Karmarkar-Karp method: partial partitions are merged two by two,
those with the greatest differences first, largest parts on smallest, until one partition is left. Its
parts are the sequences. The number of parts starts at the least that can hold the tokens and rises
whenever a part exceeds the capacity. Where remainders are too coarse for that they are halved.
"""

from __future__ import annotations

import heapq
import os
import sys
import types
from array import array
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimworks.llm.arrays import byte_set
from claimworks.llm.rounds import text_bytes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CAPACITY = 2048  # ids of a sequence
END = 1  # id that ends a document
SLACK = 0.004  # sequences beyond the least number, as a share, before remainders are halved
LOT_IDS = 1 << 21  # ids of the documents that a task packs at once
PART_BYTES = 16 << 20  # text of a task, where the table's own parts are smaller
OUT_ROWS = 512
KNOWN_UNITS = 700_000  # tokenised units that a worker remembers, twice
KNOWN_BYTES = 48 << 20  # and their bytes
TEXT_BYTES = 1 << 18  # text that is split at once
CUT = b"\xff"  # between units and between texts; in no UTF-8 text
KEPT = "claimworks_encoders"  # a module of the worker that holds its encoders


def pack(
    docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, end: int = END, lot_ids: int = LOT_IDS,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Pieces of documents, each with its place in a sequence.

    One row per piece: ``doc_id``, ``start`` (the document's ids before it), ``length``, ``ids``
    (little-endian unsigned 32-bit, as bytes), ``doc_tokens``, ``sequence_id`` and ``offset`` (gapless
    from 0 in each sequence). ``tokenizer`` is a vocabulary file of the ``tokenizers`` library that every
    executor can read; strings of its special tokens are ordinary text. Every document ends with ``end``.

    Each lot takes the least number of sequences that hold its ids, 0.4 % more and one at most; padding
    is what they leave free. A null text is empty and becomes one piece, the end id alone. Null and
    repeated ``doc_id`` are packed row by row. Ties of length go by place in the lot. An empty table
    gives no rows. Other columns are not read. A text lies in one worker's memory with its ids (about
    four times its bytes); its whole sequences make no others wait. A lost task is run again over the
    same rows and gives the same pieces.
    """
    parts = text_bytes(docs, "text") // part_bytes + 1
    rows = docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text")).coalesce(parts)
    rows = rows.withColumn("part", F.spark_partition_id())
    schema = T.StructType([rows.schema["doc_id"]]).add("start", "long").add("length", "long").add(
        "ids", "binary"
    ).add("doc_tokens", "long").add("sequence_id", "long").add("offset", "long")

    def run(batches):
        lot, size, first = [], 0, 0
        encoder = kind = part = None
        for batch in batches:
            encoder = encoder or _encoder(tokenizer)
            kind, part = batch.schema.field("doc_id").type, batch.column("part")[0].as_py()
            for at, stop in _spans(batch.column("text")):
                some = batch.slice(at, stop - at)
                coded = encoder.ids_of([t or b"" for t in some.column("text").to_pylist()])
                for doc_id, ids in zip(some.column("doc_id").to_pylist(), coded, strict=True):
                    lot.append((doc_id, ids + end.to_bytes(4, "little")))
                    size += len(ids) // 4 + 1
                    if size >= lot_ids:
                        made, first = _pieces(lot, capacity, first)
                        yield from _batches(lot, made, part, kind)
                        lot, size = [], 0
        if lot:
            made, _ = _pieces(lot, capacity, first)
            yield from _batches(lot, made, part, kind)

    return rows.mapInArrow(run, schema)


def _spans(texts: pa.Array):
    """Runs of rows that hold about ``TEXT_BYTES`` of text each."""
    at, size = 0, 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        if size and size + n > TEXT_BYTES:
            yield at, i
            at, size = i, 0
        size += n + 1
    if at < len(texts):
        yield at, len(texts)


def _batches(lot: list, made: list, part: int, kind: pa.DataType):
    """Arrow rows for pieces ``(document, start, length, sequence, offset)``."""
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    for at in range(0, len(made), OUT_ROWS):
        some = made[at : at + OUT_ROWS]
        yield pa.record_batch([
            pa.array([lot[d][0] for d, *_ in some], kind),
            pa.array([s for _, s, *_ in some], pa.int64()),
            pa.array([n for _, _, n, *_ in some], pa.int64()),
            pa.array([lot[d][1][4 * s : 4 * (s + n)] for d, s, n, *_ in some], pa.binary()),
            pa.array([len(lot[d][1]) // 4 for d, *_ in some], pa.int64()),
            pa.array([part << 40 | q for *_, q, _ in some], pa.int64()),
            pa.array([o for *_, o in some], pa.int64()),
        ], names=names)


def _pieces(lot: list, capacity: int, first: int) -> tuple[list, int]:
    """All pieces of a lot, sequences numbered from ``first``, and the next free number."""
    made, rest = [], []
    for d, (_, ids) in enumerate(lot):
        n = len(ids) // 4
        whole = n - n % capacity
        for start in range(0, whole, capacity):
            made.append((d, start, capacity, first, 0))
            first += 1
        if whole < n:
            rest.append((d, whole, n - whole))
    for members in windows(rest, capacity):
        offset = 0
        for d, start, n in _joined(members):
            made.append((d, start, n, first, offset))
            offset += n
        first += 1
    return made, first


def _joined(members: list):
    """Pieces that follow each other in one document as one, in order."""
    members = sorted(members)
    d, start, n = members[0]
    for d2, start2, n2 in members[1:]:
        if d2 == d and start2 == start + n:
            n += n2
        else:
            yield d, start, n
            d, start, n = d2, start2, n2
    yield d, start, n


def windows(pieces: list, capacity: int, slack: float = SLACK) -> list[list]:
    """Pieces ``(document, start, length)`` dealt to near-equal windows within the capacity.

    The least number of windows is tried first and raised by one while any exceeds the capacity. Beyond
    the slack pieces are cut in half and the trial starts anew; pieces of one id fit in the least number.
    """
    total = sum(n for *_, n in pieces)
    if not total:
        return []
    least = -(-total // capacity)
    most = least + 1 + int(least * slack)
    limit = capacity
    while True:
        cut = [
            (d, at, min(limit, start + n - at)) for d, start, n in pieces for at in range(start, start + n, limit)
        ]
        sizes = np.array([n for *_, n in cut], np.int64)
        for k in range(max(least, 1), most + 1):
            part = differencing(sizes, k)
            load = np.bincount(part, weights=sizes, minlength=k)
            if load.max() <= capacity:
                dealt = [[] for _ in range(k)]
                for piece, p in zip(cut, part.tolist(), strict=True):
                    dealt[p].append(piece)
                return [members for members in dealt if members]
            if load.max() > capacity * (1 + 4 * slack) and limit > 1:
                break  # far too coarse: one more window will not do
        limit = max(limit // 2, 1)


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """The part of each item in a partition into k parts by the largest differencing method.

    A partial partition is its nonempty parts, greatest first: sums (less their common minimum once all k
    are there) and the ends of linked lists of items. The two with the greatest spread are merged, the
    greatest part of one on the smallest of the other.
    """
    n = len(sizes)
    order = np.argsort(-sizes, kind="stable")
    following = np.full(n, -1, np.int64)
    heap, made = [], 0
    for made, at in enumerate(range(0, n, k)):
        # merging single items by greatest difference fills one partial partition after the other
        block = order[at : at + k]
        heapq.heappush(heap, _partial(sizes[block], block, block, k, made))
    while len(heap) > 1:
        made += 1
        _, _, sums, heads, tails = heapq.heappop(heap)
        _, _, sums2, heads2, tails2 = heapq.heappop(heap)
        over = max(len(sums) + len(sums2) - k, 0)
        a, b = len(sums) - over, len(sums2) - over
        following[tails[a:]] = heads2[b:][::-1]
        sums = np.concatenate((sums[:a], sums2[:b], sums[a:] + sums2[b:][::-1]))
        heads = np.concatenate((heads[:a], heads2[:b], heads[a:]))
        tails = np.concatenate((tails[:a], tails2[:b], tails2[b:][::-1]))
        by = np.argsort(-sums, kind="stable")
        heapq.heappush(heap, _partial(sums[by], heads[by], tails[by], k, made))
    part = np.zeros(n, np.int64)
    heads = heap[0][3]
    at, label = heads.copy(), np.arange(len(heads))
    while len(at):
        part[at] = label
        at = following[at]
        label, at = label[at >= 0], at[at >= 0]
    return part


def _partial(sums, heads, tails, k: int, made: int) -> tuple:
    if len(sums) == k:
        sums = sums - sums[-1]
    return (-int(sums[0]), made, sums, heads, tails)


def _encoder(path: str) -> Encoder:
    """The encoder of a worker. Tasks get this module by value, each anew; what they learn outlives them."""
    kept = vars(sys.modules.setdefault(KEPT, types.ModuleType(KEPT)))
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


class Encoder:
    """Ids of texts; each distinct unit between certain token boundaries is tokenised once.

    The byte-level scheme splits texts into words, numbers, signs and blanks before it merges bytes. No
    token crosses the places where texts are cut here, and none depends on what lies beyond: before a
    space that follows a visible character, between a letter and one of ``.,;:!?``, and between a single
    line feed that follows a visible character and a letter. What counts as visible or as a letter is
    certain in every version of Unicode: ASCII, the letters of Latin-1, visible up to U+07FF.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        if not str(self.tokenizer.pre_tokenizer).startswith("ByteLevel(add_prefix_space=False"):
            raise ValueError(f"{path}: not a byte-level vocabulary")
        self.known: dict[bytes, bytes] = {b"": b""}
        self.older: dict[bytes, bytes] = {}
        self.held = 0

    def ids(self, text: str) -> bytes:
        return self.ids_of([text.encode()])[0]

    def ids_of(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text, given in UTF-8, as little-endian unsigned 32-bit numbers."""
        units, firsts = _units(texts)
        codes = list(map(self.known.get, units))
        if None in codes:
            missing = [i for i, code in enumerate(codes) if code is None]
            self._learn({units[i]: None for i in missing})
            for i in missing:
                codes[i] = self.known[units[i]]
            if len(self.known) > KNOWN_UNITS or self.held > KNOWN_BYTES:  # what is not met for long is forgotten
                self.older, self.known, self.held = self.known, {b"": b""}, 0
        codes = iter(codes)
        return [b"".join(islice(codes, n)) for n in np.diff(firsts).tolist()]

    def _learn(self, units: dict) -> None:
        new = []
        for unit in units:
            code = self.older.get(unit)
            if code is None:
                new.append(unit)
            else:
                self.known[unit] = code
        self.held += sum(map(len, units))
        coded = self.tokenizer.encode_batch_fast([u.decode() for u in new], add_special_tokens=False)
        self.known.update(zip(new, (array("I", c.ids).tobytes() for c in coded), strict=True))


def _units(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The units of all texts, and the number of each text's first unit, then that of all units."""
    data = CUT.join(texts)
    x = np.frombuffer(b"\0\0\0" + data, np.uint8)  # places before the text are neither visible nor letters
    two = (x >= 128) & _shifted((x >= 0xC3) & (x <= 0xDF))  # ends of two-byte characters, none of them blank
    latin = (x >= 128) & _shifted(x == 0xC3) & (x != 0x97) & (x != 0xB7)
    visible = _VISIBLE[x] | two
    cut = (x == 32) & _shifted(visible)
    cut |= _STOPS[x] & _shifted(_LETTERS[x] | latin)
    cut |= _LETTERS[x] & _shifted((x == 10) & _shifted(visible))
    at = np.flatnonzero(cut[3:])
    with_cuts = np.full(len(data) + len(at), CUT[0], np.uint8)
    kept = np.ones(len(with_cuts), bool)
    kept[at + np.arange(len(at))] = False
    with_cuts[kept] = x[3:]
    starts = np.cumsum([0, *[len(t) + 1 for t in texts]])
    firsts = np.searchsorted(at, starts) + np.arange(len(starts))
    return with_cuts.tobytes().split(CUT), firsts


def _shifted(flags: np.ndarray) -> np.ndarray:
    """Each place's flag is that of the place before."""
    out = np.zeros(len(flags), bool)
    out[1:] = flags[:-1]
    return out


_VISIBLE = byte_set((0x21, 0x7E))
_LETTERS = byte_set((0x41, 0x5A), (0x61, 0x7A))
_STOPS = np.isin(np.arange(256), list(b".,;:!?"))
