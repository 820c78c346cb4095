"""Benchmark decontamination with an FM-index per training shard.

A shard's words become numbers over the test phrases' vocabulary, with zero for all other words and for
document borders. The suffix order of the shard gives its Burrows-Wheeler transform, held as a wavelet
matrix. All phrases are searched backward at once, two ranks a step; places come from sampled suffix
positions by walking back to the next sample. The windows found are merged into removal spans.
"""

from __future__ import annotations

import itertools
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from claimworks.llm import arrays as A
from claimworks.llm.substring import doc_runs
from claimworks.llm.tables import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHARD = 1 << 20  # bytes of text in an index
SAMPLE = 8
COLUMN = "contamination"
RESULT = "struct<n_words:long,items:array<string>,spans:array<struct<start:long,end:long>>>"


class WaveletMatrix:
    """Rank of any symbol in a sequence, one bit level at a time."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.bits = max(1, int(top).bit_length())
        self.ones, self.zeros = [], []
        for bit in reversed(range(self.bits)):
            level = (symbols >> bit & 1).astype(bool)
            self.ones.append(np.concatenate(([0], np.cumsum(level, dtype=np.int32))).astype(np.int32))
            self.zeros.append(int(len(level) - level.sum()))
            symbols = np.concatenate((symbols[~level], symbols[level]))

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        low, high = np.zeros(len(place), np.int64), place.astype(np.int64)
        for k, bit in enumerate(reversed(range(self.bits))):
            one = (symbol >> bit & 1).astype(bool)
            ones, zeros = self.ones[k], self.zeros[k]
            low, high = (np.where(one, zeros + ones[x], x - ones[x]) for x in (low, high))
        return high - low

    def access(self, place: np.ndarray) -> np.ndarray:
        symbol, at = np.zeros(len(place), np.int64), place.astype(np.int64)
        for ones, zeros in zip(self.ones, self.zeros, strict=True):
            one = ones[at + 1] > ones[at]
            symbol = symbol << 1 | one
            at = np.where(one, zeros + ones[at], at - ones[at])
        return symbol


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; only suffixes that still tie are sorted again."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(n, np.int64)
    s = symbols[order]
    head = np.concatenate(([True], s[1:] != s[:-1]))
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    step = 1
    while not head.all():
        open_ = ~(head & np.concatenate((head[1:], [True])))
        at = np.flatnonzero(open_)
        who = order[at]
        after = np.where(who + step < n, rank[np.minimum(who + step, n - 1)] + 1, 0)
        own = rank[who]
        again = np.lexsort((after, own))
        order[at] = who[again]
        own, after = own[again], after[again]
        head[at] |= np.concatenate(([True], (own[1:] != own[:-1]) | (after[1:] != after[:-1])))
        rank[order[at]] = np.maximum.accumulate(np.where(head[at], at, 0))
        step *= 2
    return order


class FmIndex:
    """Index of a shard's symbols; 0 is kept for the end of the text."""

    def __init__(self, symbols: np.ndarray, top: int):
        symbols = np.append(symbols, 0)
        order = suffix_order(symbols)
        self.n = len(symbols)
        self.tree = WaveletMatrix(symbols[order - 1], top)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=top + 1))))
        self.marked = order % SAMPLE == 0
        self.rank_marked = np.cumsum(self.marked) - self.marked
        self.sampled = order[self.marked]

    def search(self, phrases: np.ndarray, lengths: np.ndarray):
        """Suffix ranges of phrases: rows of symbols, set flush right."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        for column in reversed(range(phrases.shape[1])):
            live = np.flatnonzero((lengths >= phrases.shape[1] - column) & (low < high))
            if not len(live):
                break
            symbol = phrases[live, column]
            low[live] = self.before[symbol] + self.tree.rank(symbol, low[live])
            high[live] = self.before[symbol] + self.tree.rank(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of suffix ranks."""
        out, walked = np.empty(len(rows), np.int64), 0
        open_, at = np.arange(len(rows)), rows
        while len(open_):
            found = self.marked[at]
            out[open_[found]] = self.sampled[self.rank_marked[at[found]]] + walked
            open_, at = open_[~found], at[~found]
            symbol = self.tree.access(at)
            at = self.before[symbol] + self.tree.rank(symbol, at)
            walked += 1
        return out


class Phrases:
    """The distinct windows of a block of test items, with the items of each.

    Word symbols start at 2; 1 stands for any other word and for a document's end.
    """

    def __init__(self, items: list[tuple[str, str]], window: int):
        data, offsets = A.texts(pa.array([t for _, t in items], pa.string()))
        data = A.lower_ascii(data)
        starts, ends, first = A.words(data, offsets, A.BREAK)
        self.keys, numbers = np.unique(A.word_hashes(data, starts, ends), return_inverse=True)
        numbers = numbers + 2
        found: dict[tuple, set] = {}
        for (item, _), a, b in zip(items, first[:-1].tolist(), first[1:].tolist(), strict=True):
            width = min(window, b - a)
            for s in range(a, b - width + 1) if width else ():
                found.setdefault(tuple(numbers[s : s + width].tolist()), set()).add(item)
        self.items = [sorted(x) for x in found.values()]
        self.lengths = np.array([len(p) for p in found], np.int64)
        self.rows = np.zeros((len(found), window), np.int64)
        for i, phrase in enumerate(found):
            self.rows[i, window - len(phrase) :] = phrase

    def symbols(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.ones(len(keys), np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at + 2, 1)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 8 << 20, cut: bool = False
) -> DataFrame:
    """``docs`` with one more column, ``contamination``: ``n_words``, ``items`` and removal ``spans``.

    ``benchmark`` has item_id and text. Words are runs of letters, digits and bytes beyond ASCII, with
    A-Z lowered. A test item's windows are its ``window`` consecutive words; an item of fewer words is
    one window, one without words none. ``items`` are the ids, as sorted text, of items with a window
    in the document; ``spans`` are the words hit, as merged ranges. Null texts have no words. A null
    item_id goes by an empty name; repeated items count once. An empty benchmark finds nothing. All
    columns of ``docs`` stay; one that is called ``contamination`` is replaced. With ``cut`` the words
    hit are cut out of ``text`` in the same pass, up to the word behind; other texts stay byte for byte.

    Test items come to the tasks in blocks of about ``block_bytes``, a longer item being a block of its
    own; each block passes over all documents.
    """
    docs = docs.drop(COLUMN)
    blocks = _blocks(benchmark, block_bytes)
    out, block = docs, next(blocks, [])
    for more in blocks:
        out = stored(_search(out, Phrases(block, window), False), "contamination")
        block = more
    return _search(out, Phrases(block, window), cut)


def _blocks(benchmark: DataFrame, block_bytes: int):
    """Blocks of test items, streamed through the driver; none exceeds the bound by more than an item."""
    rows = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    block, size = [], 0
    for row in rows.toLocalIterator():
        block.append((row["item_id"], row["text"]))
        size += len(row["text"])
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def _search(docs: DataFrame, phrases: Phrases, cut: bool) -> DataFrame:
    """One pass of a block of phrases over all documents; earlier findings are merged."""
    kept = [c for c in docs.columns if c != COLUMN]
    again = COLUMN in docs.columns
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            data, offsets = A.texts(table.column(at))
            edges = np.unique(np.searchsorted(offsets[:-1], np.arange(0, len(data) + 1, SHARD)))
            for low, high in itertools.pairwise([*edges.tolist(), table.num_rows]):
                part = table.slice(low, high - low)
                before = part.column(len(kept)).combine_chunks() if again else None
                places = offsets[low : high + 1]
                found = _shard(data[places[0] : places[-1]], places - places[0], phrases, before)
                columns = [part.column(i).combine_chunks() for i in range(len(kept))]
                if cut:
                    columns[at] = _cut(columns[at], found)
                yield pa.RecordBatch.from_arrays([*columns, found], [*kept, COLUMN])

    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).schema.add(COLUMN, DataType.fromDDL(RESULT))
    return docs.mapInArrow(run, schema)


def _shard(data, offsets, phrases: Phrases, before) -> pa.Array:
    """Findings of one shard, as an array of structs."""
    data = A.lower_ascii(data)
    starts, ends, first = A.words(data, offsets, A.BREAK)
    n, docs = len(starts), len(offsets) - 1
    doc = A.segment_of(first, n)
    hit = np.zeros(n, bool)
    items: list[set] = [set() for _ in range(docs)]
    if n and len(phrases.rows):
        word, pairs = _occurrences(A.word_hashes(data, starts, ends), first, doc, phrases)
        hit = A.covered(n, word, phrases.lengths[pairs])
        both = np.unique(np.stack([doc[word], pairs]), axis=1)
        for d, p in both.T.tolist():
            items[d].update(phrases.items[p])
    if before is not None:
        for d, old in enumerate(before.to_pylist()):
            items[d].update(old["items"])
            for span in old["spans"]:
                hit[first[d] + span["start"] : first[d] + span["end"]] = True
    return pa.StructArray.from_arrays(
        [
            pa.array(np.diff(first)), pa.array([sorted(x) for x in items], pa.list_(pa.string())),
            doc_runs(hit, first, doc),
        ],
        ["n_words", "items", "spans"],
    )


def _occurrences(keys, first, doc, phrases):
    """``(first words, phrases)`` of all occurrences in a shard."""
    symbols = phrases.symbols(keys)
    # Document ends count as an unknown word; a run of known words shorter than any phrase holds none.
    line = np.insert(symbols, first[1:], 1)
    word = np.arange(len(line)) - np.searchsorted(first[1:] + np.arange(len(first) - 1), np.arange(len(line)))
    begin, end = A.runs(line > 1)
    long_ = end - begin >= phrases.lengths.min()
    keep = A.covered(len(line), begin[long_], (end - begin + 1)[long_])
    line, word = line[keep], word[keep]
    if not len(line):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    index = FmIndex(line, len(phrases.keys) + 1)
    low, high = index.search(phrases.rows, phrases.lengths)
    n = high - low
    rows = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)
    return word[index.locate(rows)], np.repeat(np.arange(len(n)), n)


def _cut(texts: pa.Array, found: pa.StructArray) -> pa.Array:
    """The texts without the words hit; a span goes up to the start of the word behind it."""
    spans = found.field("spans")
    hit = np.flatnonzero(np.asarray(pc.list_value_length(spans)) > 0).tolist()
    if not hit:
        return texts
    out = texts.to_pylist()
    for row in hit:
        data, offsets = A.texts(pa.array([out[row]], pa.string()))
        starts, _, _ = A.words(A.lower_ascii(data), offsets, A.BREAK)
        edges = np.append(starts, len(data))
        marks = np.array([(edges[s["start"]], edges[s["end"]]) for s in spans[row].as_py()])
        out[row] = data[~A.covered(len(data), marks[:, 0], marks[:, 1] - marks[:, 0])].tobytes().decode()
    return pa.array(out, texts.type)
