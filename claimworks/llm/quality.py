"""Quality rules: counts per text, and perplexity bands of a smoothed n-gram model of words.

Each language has a modified Kneser-Ney model of word pairs. Its tables grow with the corpus and are
never gathered: texts lie in groups by content, groups send their pairs and words to hash buckets, and
buckets answer with what the whole corpus holds (``rounds.py``). Of each pair one group is the owner;
owners add up what pairs say of their words, so a word, however common, is one entry per group. Pairs
and words that no other text holds count as unseen when a text is scored, else a text unlike all others
would look certain to itself. Pairs are counted in a job of their own, whose shuffle files go when the
answers are stored; texts travel compressed, those of a task and a group together.

Unseen words are spelled by a model of three symbols per language. Symbols are the bytes of the text,
those beyond ASCII folded to 32; only this base is bounded by the alphabet and sent to the tasks, as
sorted arrays of hashed n-grams with their log probabilities.
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
from claimworks.llm.substring import by_bucket
from claimworks.llm.tables import digest, small_batches, stored
from claimworks.session import settings

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(R)

U64 = np.uint64
SLICE = 1 << 20  # bytes of text worked on at a time
SYMBOLS = 128
BLOCK = 64  # bytes that are told to be of the text's language or of another
FOREIGN = 0.3  # nats a byte by which another language spells a foreign block better
QUOTED = 0.25  # share of a text that may be foreign and then goes unscored
BIN = 0.001  # width of a step of log perplexity in the statistics of a language
LEAST_TEXTS = 100  # texts of about one length that make a statistic of their own
RECENT = 1 << 16  # digests by which a task knows its copies
HELD = 64 << 20  # bytes of text that a task packs at a time
TEXT_LEVEL = 6  # of zstd, for texts that travel
FREED = {"spark__sql__classic__shuffleDependency__fileCleanup__enabled": "true"}  # shuffle files go with their job
SIGNS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
COLUMN = "quality"
KEYS = ("__k1", "__k2")
RESULT = (
    "struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,"
    "language:string,log_perplexity:double,letter_perplexity:double>"
)
SCORED = f"{KEYS[0]} long, {KEYS[1]} long, {COLUMN} {RESULT}"
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_QUALITY = pa.struct([
    *((c, pa.int64()) for c in _COUNTS), ("language", pa.string()), ("log_perplexity", pa.float64()),
    ("letter_perplexity", pa.float64()),
])
_SCORED = pa.schema([(KEYS[0], pa.int64()), (KEYS[1], pa.int64()), (COLUMN, _QUALITY)])


def numbered(codes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """``(first place of each distinct code, number of each place's code)``, codes ascending below ``2**bits``."""
    n = len(codes)
    shift = n.bit_length()
    if bits + shift <= 64:  # one plain sort of code and place together
        both = np.sort(codes.astype(U64) << U64(shift) | np.arange(n, dtype=U64))
        place, code = (both & U64((1 << shift) - 1)).astype(np.int64), both >> U64(shift)
    else:
        place = np.argsort(codes, kind="stable")
        code = codes[place]
    new = np.ones(n, bool)
    new[1:] = code[1:] != code[:-1]
    number = np.empty(n, np.int64)
    number[place] = np.cumsum(new) - 1
    return place[new], number


def text_counts(data: np.ndarray, offsets: np.ndarray, found=None) -> dict[str, np.ndarray]:
    """Counts for each text: words, their code points, signs, repeated lines, repeated 3-word windows.

    ``found`` are starts, ends, first and hashes of the words where they are known.
    """
    if found is None:
        found = A.words(data, offsets, A.SPACE)
        found = (*found, A.word_hashes(data, *found[:2]))
    starts, ends, first, hashes = found
    per_doc = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[offsets])
    n, docs = len(starts), len(offsets) - 1
    doc = A.segment_of(first, n)

    words = A.Spans(hashes)
    at = np.flatnonzero(first[1:][doc] - np.arange(n) >= 3)
    window = A.mix(A.mix(words.at(at, 3)) + doc[at].astype(np.uint64))
    _, back, times = np.unique(window, return_inverse=True, return_counts=True)
    repeated = A.covered(n, at[times[back] > 1], 3)

    breaks = np.flatnonzero(data == 10)
    begin = np.sort(np.concatenate((offsets[:-1], breaks + 1)))
    begin = begin[begin < len(data)]
    owner = np.searchsorted(offsets, begin, "right") - 1
    begin, index = np.unique(begin, return_index=True)  # a break at a text's end, or empty texts
    owner = owner[index]
    end = np.minimum(offsets[owner + 1], np.append(begin[1:], len(data)))
    end = end - ((end > begin) & (data[np.maximum(end - 1, 0)] == 10))
    filled = np.searchsorted(starts, end) > np.searchsorted(starts, begin)
    begin, end, owner = begin[filled], end[filled], owner[filled]
    lines = A.Spans(A.byte_values(9)[data]).at(begin, end - begin)
    key = A.mix(A.mix(lines + (end - begin).astype(np.uint64)) + owner.astype(np.uint64))
    _, earliest = np.unique(key, return_index=True)
    later = np.ones(len(key), bool)
    later[earliest] = False
    return {
        "n_words": np.diff(first),
        "word_chars": per_doc(((data & 0xC0) != 0x80) & ~A.SPACE[data]),
        "n_symbols": per_doc(SIGNS[data]),
        "n_dup_lines": np.bincount(owner[later], minlength=docs),
        "n_repeat_words": np.diff(np.concatenate(([0], np.cumsum(repeated)))[first]),
    }


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The trigram that ends at each byte; a text begins after two zero symbols."""
    s = np.where(data < SYMBOLS, data, data & 31).astype(np.int32)
    one, two = np.zeros(len(s), np.int32), np.zeros(len(s), np.int32)
    one[1:], two[2:] = s[:-1], s[:-2]
    begin = offsets[:-1][offsets[1:] > offsets[:-1]]
    one[begin], two[begin] = 0, 0
    next_ = begin[np.isin(begin + 1, begin, invert=True) & (begin + 1 < len(s))] + 1
    two[next_] = 0
    return two << 14 | one << 7 | s


def _slices(column):
    """``(low, high, bytes, offsets)`` of consecutive rows with about ``SLICE`` bytes."""
    yield from _cut(*A.texts(column))


def _cut(data: np.ndarray, offsets: np.ndarray):
    cut = np.unique(np.searchsorted(offsets[:-1], np.arange(0, len(data) + 1, SLICE)))
    for low, high in itertools.pairwise([*cut.tolist(), len(offsets) - 1]):
        at = offsets[low : high + 1]
        yield low, high, data[at[0] : at[-1]], at - at[0]


def _language_numbers(column, languages) -> np.ndarray:
    number = {name: i for i, name in enumerate(languages)}
    return np.array([number.get(x, len(languages)) for x in column.to_pylist()], np.int64)


def count_grams(docs: DataFrame, languages: tuple[str, ...]) -> DataFrame:
    """``gram, n`` over all texts; a gram holds the language's number and three symbols."""

    def run(batches):
        grown, size = [], 0
        for batch in batches:
            number = _language_numbers(batch.column(1), languages)
            for low, high, data, offsets in _slices(batch.column(0)):
                codes = grams(data, offsets) | np.repeat(number[low:high], np.diff(offsets)) << 21
                grown.append(np.unique(codes, return_counts=True))
                size += len(grown[-1][0])
                if size > 1 << 21:
                    grown = [_added(grown)]
                    size = len(grown[0][0])
        if grown:
            codes, n = _added(grown)
            for i in range(0, len(codes), 1 << 16):
                part = slice(i, i + (1 << 16))
                yield pa.RecordBatch.from_arrays([pa.array(codes[part]), pa.array(n[part])], ["gram", "n"])

    rows = docs.select(F.col("text").cast("string"), F.col("lang").cast("string"))
    return rows.mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _added(counts):
    codes, back = np.unique(np.concatenate([c for c, _ in counts]), return_inverse=True)
    total = np.zeros(len(codes), np.int64)
    np.add.at(total, back, np.concatenate([n for _, n in counts]))
    return codes, total


class KneserNey:
    """Modified Kneser-Ney probabilities of one language's trigrams.

    The texts that are scored are those that were counted. A trigram that stands once in the corpus
    stands in the scored text itself, so it is scored as one never seen, by backing off; else a text
    unlike all others would look certain to itself.
    """

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        lower, kinds = np.unique(codes & 0x3FFF, return_counts=True)  # distinct symbols before a pair
        single, pairs = np.unique(lower & 0x7F, return_counts=True)
        uniform = np.full(SYMBOLS, 1.0 / SYMBOLS)
        one, _ = _smoothed(single, pairs, np.zeros(len(single), np.int64), uniform[single])
        rest = _rest(pairs, np.zeros(len(single), np.int64))
        base = uniform * (rest[1][0] if len(single) else 1.0)
        base[single] = one
        two, back2 = _smoothed(lower, kinds, lower >> 7, base[lower & 0x7F])
        at = np.searchsorted(lower, codes & 0x3FFF)
        three, back3 = _smoothed(codes, counts, codes >> 7, two[at])
        self.unigram = np.log(base).astype(np.float32)
        often = counts > 1
        known = np.isin(back3[0], codes[often] >> 7)
        self.keys, self.values = self._sorted(
            (3, codes[often], three[often]), (2, lower, two), (13, back3[0][known], back3[1][known]), (12, *back2)
        )

    @staticmethod
    def _key(kind: int, codes: np.ndarray) -> np.ndarray:
        return A.mix(codes.astype(np.uint64) + np.uint64(kind << 32))

    def _sorted(self, *parts):
        keys = np.concatenate([self._key(kind, codes) for kind, codes, _ in parts])
        values = np.log(np.concatenate([p for _, _, p in parts])).astype(np.float32)
        order = np.argsort(keys)
        return keys[order], values[order]

    def _look(self, kind: int, codes: np.ndarray):
        keys = self._key(kind, codes)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] == keys, self.values[at]

    def log_probability(self, codes: np.ndarray) -> np.ndarray:
        """Of the last symbol of each trigram; what was never seen backs off."""
        if not len(self.keys):
            return np.full(len(codes), -np.log(SYMBOLS), np.float32)
        seen, value = self._look(3, codes)
        out = np.where(seen, value, np.float32(0))
        rare = np.flatnonzero(~seen)
        if len(rare):
            known, weight = self._look(13, codes[rare] >> 7)
            out[rare] += np.where(known, weight, np.float32(0))
            seen, value = self._look(2, codes[rare] & 0x3FFF)
            out[rare] += np.where(seen, value, np.float32(0))
            rare = rare[~seen]
            known, weight = self._look(12, codes[rare] >> 7 & 0x7F)
            out[rare] += np.where(known, weight, np.float32(0)) + self.unigram[codes[rare] & 0x7F]
        return out


def _discounts(counts: np.ndarray) -> np.ndarray:
    """Discounts for counts of 1, 2 and more, from the counts of counts."""
    return _discount(*np.bincount(np.minimum(counts, 5), minlength=6)[1:5])


def _discount(*times) -> np.ndarray:
    """Discounts from how many n-grams stand once to four times; plain ones where these lack."""
    n = np.array(times, float)
    if not n.all():
        return np.array([0.0, 0.5, 0.75, 0.9])
    y = n[0] / (n[0] + 2 * n[1])
    found = [k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)]
    return np.array([0.0, *(min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), found, strict=True))])


def _rest(counts, context):
    """``(contexts, mass left to lower orders)``."""
    known, back = np.unique(context, return_inverse=True)
    taken = _discounts(counts)[np.minimum(counts, 3)]
    total = np.bincount(back, counts, len(known))
    return known, np.bincount(back, taken, len(known)) / np.maximum(total, 1)


def _smoothed(codes, counts, context, below):
    """Discounted probabilities mixed with those of the lower order, and the contexts' weights."""
    known, back = np.unique(context, return_inverse=True)
    total = np.bincount(back, counts, len(known))[back] if len(codes) else np.zeros(0)
    weights = _rest(counts, context)
    own = (counts - _discounts(counts)[np.minimum(counts, 3)]) / np.maximum(total, 1)
    return own + weights[1][back] * below, weights


def fit(docs: DataFrame, languages: tuple[str, ...]) -> list[KneserNey]:
    """One model per language and one for all other and unnamed languages, from all documents."""
    with small_batches(docs.sparkSession):
        table = count_grams(docs, languages).toArrow()
    codes, n = table.column("gram").to_numpy(), table.column("n").to_numpy()
    order = np.argsort(codes)
    codes, n = codes[order], n[order]
    edges = np.searchsorted(codes, np.arange(len(languages) + 2) << 21)
    return [
        KneserNey(codes[a:b] & ((1 << 21) - 1), n[a:b]) for a, b in itertools.pairwise(edges.tolist())
    ]


def score(docs: DataFrame, models: list[KneserNey], languages: tuple[str, ...], group_bytes: int, bucket_bytes: int):
    """``__k1, __k2, quality`` for each distinct (text, lang) of ``docs``: counts and log perplexities.

    ``log_perplexity`` is that of the words, in nats a word; ``letter_perplexity`` that of the spelling,
    in nats a byte. Both are those of the text's own language; quoted foreign passages go unscored.
    """
    groups, buckets = R.counts(R.text_bytes(docs, "text"), group_bytes, bucket_bytes)
    rows = docs.select(
        F.pmod(F.col(KEYS[0]), F.lit(groups)).cast("int").alias(R.GROUP),
        F.col("text").cast("string"), F.col("lang").cast("string"), *KEYS,
    )
    # A copy that many rows share leaves a task once, so that its group stays small.
    rows = rows.mapInArrow(lambda batches: _packed_texts(_without_copies(batches)), f"{R.GROUP} int, {R.BODY} binary")
    asked = R.ask(rows, lambda t: _ask_totals(_Texts(_texts_of(t), languages), buckets))
    totals = stored(R.answer(asked, _totals), "pair_totals")
    shares = R.ask_again(
        rows, totals, lambda t, bodies: _ask_words(_Texts(_texts_of(t), languages), bodies, buckets)
    )
    about = R.answer(shares, _sums)
    return R.finish(
        rows, [totals, about], lambda t, one, two: _Texts(_texts_of(t), languages).scored(one, two, models),
        SCORED, _SCORED,
    )


def _packed_texts(batches):
    """Rows of one group in one body; a task holds about ``HELD`` bytes of text before it sends them."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= HELD:
            yield from _sent(held)
            held, size = [], 0
    if size:
        yield from _sent(held)


def _sent(batches):
    rows = pa.Table.from_batches(batches)
    group = rows.column(R.GROUP).to_numpy()
    order = np.argsort(group, kind="stable")
    edges = np.flatnonzero(np.diff(group[order], prepend=-1, append=-1))
    rows = rows.drop_columns([R.GROUP])
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=TEXT_LEVEL))
    for low, high in itertools.pairwise(edges.tolist()):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, rows.schema, options=options) as out:
            out.write_table(rows.take(order[low:high]).combine_chunks())
        body = pa.array([sink.getvalue().to_pybytes()], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array([group[order[low]]], pa.int32()), body], [R.GROUP, R.BODY])


def _texts_of(table: pa.Table) -> pa.Table:
    """The rows that were sent to a group."""
    return pa.concat_tables(pa.ipc.open_stream(body.as_buffer()).read_all() for body in table.column(R.BODY))


def _without_copies(batches):
    seen = set()
    for batch in batches:
        keep = []
        for key in zip(*(batch.column(k).to_pylist() for k in KEYS), strict=True):
            keep.append(key not in seen)
            seen.add(key)
            if len(seen) > RECENT:
                seen = {key}
        yield batch.filter(pa.array(keep, pa.bool_()))


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers in little space: byte planes, zstd."""
    planes = np.stack([c.astype("<u8") for c in columns]).view(np.uint8).reshape(len(columns), -1, 8)
    body = np.ascontiguousarray(planes.transpose(0, 2, 1)).tobytes()
    return len(columns[0]).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def _unpacked(body: bytes, columns: int) -> np.ndarray:
    n = int.from_bytes(body[:8], "little")
    raw = pa.decompress(body[8:], decompressed_size=8 * n * columns, codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(columns, 8, n)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<u8").reshape(columns, n).astype(np.int64)


def _sparse(values: np.ndarray) -> bytes:
    """Whole numbers that are mostly zero: which are not, and those."""
    some = values != 0
    body = pa.compress(np.packbits(some).tobytes(), codec="zstd", asbytes=True)
    return b"".join((len(values).to_bytes(8, "little"), len(body).to_bytes(8, "little"), body, _packed(values[some])))


def _whole(body: bytes) -> np.ndarray:
    n, cut = int.from_bytes(body[:8], "little"), 16 + int.from_bytes(body[8:16], "little")
    bits = pa.decompress(body[16:cut], decompressed_size=-(-n // 8), codec="zstd", asbytes=True)
    out = np.zeros(n, np.int64)
    out[np.unpackbits(np.frombuffer(bits, np.uint8), count=n) > 0] = _unpacked(body[cut:], 1)[0]
    return out


def _keyed(keys: np.ndarray) -> bytes:
    packed = A.pack(keys)
    return len(packed).to_bytes(8, "little") + packed


def _cut_keys(body: bytes) -> tuple[np.ndarray, bytes]:
    cut = 8 + int.from_bytes(body[:8], "little")
    return A.unpack(body[8:cut]), body[cut:]


def _message(keys: np.ndarray, *columns: np.ndarray) -> bytes:
    return _keyed(keys) + _packed(*columns)


def _opened(bodies: list[bytes], columns: int):
    """``(keys, columns, sizes)`` of several messages in a row."""
    keys, rest = [], []
    for body in bodies:
        key, values = _cut_keys(body)
        keys.append(key)
        rest.append(_unpacked(values, columns))
    return np.concatenate(keys), np.concatenate(rest, axis=1), [len(k) for k in keys]


def _answers(bodies: list[bytes], columns: int) -> np.ndarray:
    parts = [_unpacked(b, columns) for b in bodies]
    return np.concatenate(parts, axis=1) if parts else np.zeros((columns, 0), np.int64)


def _ask_totals(texts: _Texts, buckets: int):
    for bucket, part in by_bucket(texts.pairs, 48, buckets):
        yield bucket, _keyed(texts.pairs[part]) + _sparse(texts.times[part] - 1)


def _totals(groups, bodies):
    """For each pair sent: 0 where no other group has it, else how often others do, and is this group the first?"""
    found = [_cut_keys(body) for body in bodies]
    keys, sizes = np.concatenate([k for k, _ in found]), [len(k) for k, _ in found]
    times = np.concatenate([_whole(rest) for _, rest in found]) + 1
    order, first = _sorted_by_sender(keys, sizes)
    owned = np.zeros(len(keys), np.int64)
    owned[order[first]] = 1
    total = np.empty(len(keys), np.int64)
    total[order] = np.repeat(np.add.reduceat(times[order], first), np.diff(first, append=len(keys)))
    told = np.where(total > times, total - times << 1 | owned, 0)
    return [_sparse(x) for x in np.split(told, np.cumsum(sizes)[:-1])]


def _sorted_by_sender(keys: np.ndarray, sizes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """``(order, first)``: keys of 48 bits ascending, equal ones by message; where each run of them begins."""
    if len(sizes) <= 1 << 16:
        sender = np.repeat(np.arange(len(sizes), dtype=U64), sizes)
        order = np.argsort(keys << U64(16) | sender)  # all different, so any sort gives the same
    else:
        order = np.argsort(keys, kind="stable")
    return order, np.flatnonzero(np.diff(keys[order], prepend=U64(1 << 63)))


def _ask_words(texts: _Texts, bodies, buckets: int):
    """Every bucket is asked, since each tells how many words of a language it holds."""
    shares = texts.shares(*texts.totals(bodies))
    parts = dict(by_bucket(texts.names, 48, buckets))
    for bucket in range(buckets):
        part = parts.get(bucket, slice(0, 0))
        yield bucket, _message(texts.names[part], *shares[:, part], texts.kind[part])


def _sums(groups, bodies):
    """For each word sent, the sums over all groups; and the number of different words by language."""
    keys, (*shares, kind), sizes = _opened(bodies, FIELDS + 1)
    order, first = _sorted_by_sender(keys, sizes)
    sums, times = [], np.diff(first, append=len(keys))
    for s in shares:
        sums.append(np.empty(len(keys), np.int64))
        sums[-1][order] = np.repeat(np.add.reduceat(s[order], first) if len(keys) else s, times)
    words = _packed(np.bincount(kind[order[first]], minlength=1))
    edges = np.cumsum(sizes)[:-1]
    return [
        len(words).to_bytes(8, "little") + words + _packed(*parts)
        for parts in zip(*(np.split(s, edges) for s in sums), strict=True)
    ]


def _told(bodies: list[bytes], languages: int) -> tuple[np.ndarray, np.ndarray]:
    """``(sums of each name, different words of each language)`` from the answers of all buckets."""
    words, rest = np.zeros(languages + 1, np.int64), []
    for body in bodies:
        cut = 8 + int.from_bytes(body[:8], "little")
        (of_bucket,) = _unpacked(body[8:cut], 1)
        words[: len(of_bucket)] += of_bucket
        rest.append(body[cut:])
    return _answers(rest, FIELDS), words[1:]


FIELDS = 6  # of a word: tokens before another, pairs it begins seen once, twice, more often, words before it, tokens
# Of a language: pairs, those seen once, twice, three and four times.


def _inside(keys: np.ndarray) -> np.ndarray:
    return A.mix(keys) >> U64(16)


class _Texts:
    """The distinct texts of a group with their words, pairs of words and languages."""

    def __init__(self, table: pa.Table, languages: tuple[str, ...]):
        one, two = (table.column(k).to_numpy() for k in KEYS)
        order = np.lexsort((two, one))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(one[order]) != 0) | (np.diff(two[order]) != 0)
        self.table, self.languages = table.take(order[new]), languages
        self.data, self.offsets = A.texts(self.table.column("text"))
        self.number = _language_numbers(self.table.column("lang"), languages)
        found = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, U64)]
        parts = [[part] for part in found]
        for low, _, data, offsets in _cut(self.data, self.offsets):  # of the size that caches hold
            starts, ends, first = A.words(data, offsets, A.SPACE)
            at, before = self.offsets[low], parts[2][-1][-1]
            for part, more in zip(parts, (starts + at, ends + at, first[1:] + before, A.word_hashes(data, starts, ends)), strict=True):
                part.append(more)
        small = np.int32 if len(self.data) < 1 << 30 else np.int64  # of the columns with a place for each word
        self.starts, self.ends = (np.concatenate(part).astype(small) for part in parts[:2])
        self.first, self.hashes = (np.concatenate(part) for part in parts[2:])
        del parts
        n = len(self.starts)
        self.doc = A.segment_of(self.first, n).astype(small)
        salt = A.mix(np.arange(1, len(languages) + 2, dtype=U64))
        word = A.mix(self.hashes + salt[self.number][self.doc])
        self.begins = self.first[:-1][np.diff(self.first) > 0]
        spoken = self.number[self.doc[self.begins]]

        # Names are words, the beginnings of texts, and one for all of a language.
        present = np.unique(self.number)
        extra = np.concatenate((_inside(salt[present]), _inside(A.mix(present.astype(U64) + U64(1)) + U64(5))))
        self.names, back = np.unique(np.concatenate((_inside(word), extra)), return_inverse=True)
        self.name, opening = back[:n].astype(small), np.zeros(len(salt), np.int64)
        opening[present] = back[n : n + len(present)]
        self.whole = np.zeros(len(salt), np.int64)
        self.whole[present] = back[n + len(present) :]
        del back
        self.context = np.concatenate((np.zeros(1, small), self.name[:-1]))[:n]
        self.context[self.begins] = opening[spoken]  # stands for the beginning of a text
        self.language = np.zeros(len(self.names), np.int64)  # of each name
        self.language[opening[present]] = present
        self.language[self.whole[present]] = present
        self.language[self.name] = self.number[self.doc]
        self.kind = np.zeros(len(self.names), np.int64)  # 0, or of a word the number of its language from 1
        self.kind[self.name] = self.language[self.name] + 1

        bits = len(self.names).bit_length()
        lead, back = numbered(self.context.astype(np.int64) << bits | self.name, 2 * bits)
        before = word[lead - 1]
        opens = np.zeros(n, bool)
        opens[self.begins] = True
        opens = opens[lead]
        before[opens] = salt[self.number[self.doc[lead[opens]]]]
        self.pairs, again = np.unique(_inside(before * U64(A.BASE) + word[lead]), return_inverse=True)
        self.pair = again.astype(small)[back]
        self.lead = np.empty(len(self.pairs), np.int64)
        self.lead[again[::-1]] = lead[::-1]
        self.times = np.bincount(self.pair, minlength=len(self.pairs))

    def totals(self, bodies: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """``(number of each pair in the corpus, is this group its owner)``."""
        told = np.concatenate([np.zeros(0, np.int64), *map(_whole, bodies)])
        if len(told) != len(self.pairs):
            raise ValueError("the documents changed while their pairs of words were counted")
        return self.times + (told >> 1), (told == 0) | (told & 1 > 0)

    def shares(self, total: np.ndarray, owned: np.ndarray) -> np.ndarray:
        """What the pairs that this group owns, and its words, say of each name."""
        size = len(self.names)
        at, many = self.lead[owned], total[owned]  # an owned pair's place
        context = self.context[at]
        whole = self.whole[self.language[self.name[at]]]
        out = np.empty((FIELDS, size), np.int64)
        out[0] = np.bincount(context, many, size)
        out[1], out[2] = (np.bincount(context[many == k], minlength=size) for k in (1, 2))
        out[3] = np.bincount(context[many >= 3], minlength=size)
        out[4] = np.bincount(self.name[at], minlength=size)
        out[5] = np.bincount(self.name, minlength=size)
        out[0] += np.bincount(whole, minlength=size)
        for k in (1, 2, 3, 4):
            out[k] += np.bincount(whole[many == k], minlength=size)
        return out

    def _own(self, codes: np.ndarray, size: int) -> np.ndarray:
        """How often each place's code stands in the place's text."""
        bits = size.bit_length()
        _, back = numbered(self.doc.astype(np.int64) << bits | codes, bits + len(self.offsets).bit_length())
        return np.bincount(back)[back]

    def word_logs(self, total: np.ndarray, sums: np.ndarray, words: np.ndarray, spelled: np.ndarray) -> np.ndarray:
        """Log probability of each word after the one before it."""
        name, n = self.name, len(self.starts)
        known = sums[5, name] > self._own(name, len(self.names))
        seen = total[self.pair] > self._own(self.pair, len(self.pairs))
        whole = sums[:, self.whole]
        cuts = np.stack([_discount(*whole[1:5, i]) for i in range(len(self.whole))], axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.log(whole[0] + words)
            unseen = np.log(words) - scale
            cut = cuts[:, self.language]
            held = np.maximum(sums[0], 1)
            rest = np.log((cut[1] * sums[1] + cut[2] * sums[2] + cut[3] * sums[3]) / held)
            lower = np.log(sums[4]) - scale[self.language]
            at = self.lead
            kept = np.log(
                (total - cuts[np.minimum(total, 3), self.language[name[at]]]) / held[self.context[at]]
            )
            told = np.concatenate(([False], known[:-1]))[:n]  # the word before is known elsewhere
            told[self.begins] = True
            out = np.empty(n)
            for low in range(0, n, 1 << 17):  # as much as caches hold
                part = slice(low, low + (1 << 17))
                word, pair, context = name[part], self.pair[part], self.context[part]
                base = unseen[self.language[word]] + spelled[part]
                some = np.flatnonzero(known[part])
                base[some] = np.logaddexp(lower[word[some]], base[some])
                base = np.where(told[part], rest[context] + base, base)
                some = np.flatnonzero(told[part] & seen[part])
                base[some] = np.logaddexp(kept[pair[some]], base[some])
                out[part] = base
        return out

    def spelling(self, models: list[KneserNey]):
        """Log probability of each word's bytes, whether the word is judged, and of each text nats a byte.

        The letters are those of the text's own language. A block is foreign when another named language
        spells it better by ``FOREIGN`` nats a byte. Foreign blocks, with the block on either side, are a
        quotation while they are no more than ``QUOTED`` of the text; its words are not judged.
        """
        parts = [(low, high, offsets, grams(data, offsets)) for low, high, data, offsets in _cut(self.data, self.offsets)]
        place = np.zeros(1 << 21, np.int32)
        for *_, codes in parts:
            place[codes] = 1
        known = np.flatnonzero(place)
        place[known] = np.arange(len(known))
        present = set(self.number.tolist())
        used = [i for i, m in enumerate(models) if i in present or (i < len(self.languages) and len(m.keys))]
        tables = {i: models[i].log_probability(known) for i in used}
        found = [self._spelled(low, high, offsets, place[codes], tables) for low, high, offsets, codes in parts]
        return tuple(np.concatenate(column) for column in zip(*found, strict=True))

    def _spelled(self, low: int, high: int, offsets: np.ndarray, at: np.ndarray, tables: dict):
        """As ``spelling``, for the texts ``low:high`` with the place of each byte's trigram in the tables."""
        number, size, n = self.number[low:high], np.diff(offsets), offsets[-1]
        words = slice(self.first[low], self.first[high])
        if not n:
            return np.zeros(0), np.zeros(0, bool), np.zeros(high - low)
        blocks = -(-size // BLOCK)
        doc = np.repeat(np.arange(high - low), blocks)
        begin = (np.arange(len(doc)) - (np.cumsum(blocks) - blocks)[doc]) * BLOCK + offsets[:-1][doc]
        length = np.diff(np.append(begin, n))
        letters = np.zeros(n, np.float32)
        own, other = np.zeros(len(begin)), np.full(len(begin), -np.inf)
        for i, table in tables.items():
            values, mine = table[at], number[doc] == i
            sums = np.add.reduceat(values, begin, dtype=np.float64)
            own[mine] = sums[mine]
            if mine.any():
                np.copyto(letters, values, where=np.repeat(number == i, size))
            if i < len(self.languages):
                other[~mine] = np.maximum(other, sums)[~mine]
        foreign = (number[doc] < len(self.languages)) & (other - own > FOREIGN * length)
        same = doc[1:] == doc[:-1]
        edge = np.zeros(len(begin), bool)  # beside a foreign block, so it may hold a passage's ends
        edge[1:] |= foreign[:-1] & same
        edge[:-1] |= foreign[1:] & same
        foreign |= edge
        share = np.bincount(doc, foreign * length, len(size)) / np.maximum(size, 1)
        foreign &= share[doc] <= QUOTED
        quoted = np.repeat(foreign, length)
        run = np.concatenate(([0], np.cumsum(letters, dtype=np.float64)))
        base = self.offsets[low]
        starts = self.starts[words] - base
        ends = np.minimum(self.ends[words] + 1 - base, offsets[1:][self.doc[words] - low])  # with the blank behind it
        letters[quoted] = 0
        scored = np.bincount(doc, length * ~foreign, high - low)
        sums = np.bincount(doc, np.add.reduceat(letters, begin, dtype=np.float64), high - low)
        return run[ends] - run[starts], ~quoted[starts], -sums / np.maximum(scored, 1)

    def scored(self, totals, sums, models: list[KneserNey]) -> pa.Table:
        parts = []
        for low, high, data, offsets in _cut(self.data, self.offsets):
            words, at = slice(self.first[low], self.first[high]), self.offsets[low]
            found = (
                self.starts[words] - at, self.ends[words] - at, self.first[low : high + 1] - self.first[low], self.hashes[words],
            )
            parts.append(text_counts(data, offsets, found))
        counts = {c: np.concatenate([part[c] for part in parts]) for c in _COUNTS}
        size, words = np.diff(self.offsets), np.diff(self.first)
        spelled, judged, letter = self.spelling(models)
        word = self.word_logs(self.totals(totals)[0], *_told(sums, len(self.languages) + 1), spelled)
        level = -np.bincount(self.doc, word * judged, len(size)) / np.maximum(np.bincount(self.doc, judged, len(size)), 1)
        names = [*self.languages, None]
        fields = [pa.array(counts[c]) for c in _COUNTS]
        fields += [pa.array([names[i] for i in self.number], pa.string()), pa.array(level, mask=words == 0)]
        fields.append(pa.array(letter, mask=size == 0))
        found = pa.StructArray.from_arrays(fields, fields=list(_QUALITY))
        return pa.table([*(self.table.column(k) for k in KEYS), found], schema=_SCORED)


def base_failed(least_words: int = 50, repeated_percent: int = 50):
    """The plain rule: too few words, or too many of them in repeated windows."""
    n, again = F.col(f"{COLUMN}.n_words"), F.col(f"{COLUMN}.n_repeat_words")
    return (n < least_words) | (100 * again > repeated_percent * n)


def bands(scored: DataFrame, field: str) -> dict:
    """``(language, size class) -> (lower quartile, median, upper quartile)`` of a log perplexity.

    A size class is the whole binary logarithm of the number of words, since short texts differ more;
    a class of few texts takes in its neighbours. Only texts that pass the plain rule count, each
    distinct text once. The driver sees a histogram of steps of ``BIN`` per language and class.
    """
    value = F.col(f"{COLUMN}.{field}")
    rows = scored.where(~base_failed() & value.isNotNull())
    found = rows.groupBy(
        F.col(f"{COLUMN}.language").alias("language"), _size_class().alias("size"), F.floor(value / BIN).alias("step")
    ).count().collect()
    out = {}
    for name in {r["language"] for r in found}:
        steps = np.array(sorted((r["step"], r["count"], r["size"]) for r in found if r["language"] == name))
        for size in np.unique(steps[:, 2]).tolist():
            away = np.abs(steps[:, 2] - size)
            reach = next(k for k in range(64) if steps[away <= k, 1].sum() >= LEAST_TEXTS or k >= away.max())
            near = steps[away <= reach]
            out[name, size] = tuple(_quantile(near[:, 0], near[:, 1], q) * BIN for q in (0.25, 0.5, 0.75))
    return out


def _size_class():
    return F.floor(F.log2(F.greatest(F.col(f"{COLUMN}.n_words"), F.lit(1)))).cast("int")


def _quantile(values, counts, share: float) -> float:
    return float(values[np.searchsorted(np.cumsum(counts), counts.sum() * share)])


QUARTILE = 0.6745  # standard deviations from the median to a quartile


def _within(field: str, edges: dict):
    """Whether a log perplexity lies between the edges of its language and size class."""
    value, inside = F.col(f"{COLUMN}.{field}"), F.lit(False)
    for (name, size), (low, high) in sorted(edges.items(), key=str):
        mine = F.col(f"{COLUMN}.language").eqNullSafe(F.lit(name)) & (_size_class() == size)
        inside = inside | (mine & value.between(low, high))
    return F.coalesce(inside, F.lit(False))


def judge(
    docs: DataFrame, languages: tuple[str, ...] = ("de", "en", "es", "fr"), spread: float = 4.0,
    group_bytes: int = 8 << 20, bucket_bytes: int = 32 << 20,
) -> DataFrame:
    """``docs`` (text, lang, any others) with ``quality``, ``base_failed`` and ``kept``.

    A document is kept when the plain rule passes, the log perplexity of its words is not above its
    language's band and that of its letters lies within. Bands reach ``spread`` robust deviations from the
    median of the language's texts of about that length. Foreign passages go unscored up to a quarter of
    a document; with more, all of it is scored by its own language. Documents of other or no language share a model
    and a band. Null texts are empty: they have no words, no perplexity, and fail. Rows of one text and
    language are counted once and judged alike; ``group_bytes`` of texts are held by one task at a time.
    Columns called ``quality``, ``base_failed`` or ``kept`` are replaced. Empty table, no rows.
    """
    rows = docs.drop("base_failed", "kept", COLUMN)
    keyed = rows.select("*", *digest("text", "lang"))
    with settings(docs.sparkSession, **FREED):
        models = fit(rows, languages)
        scored = stored(score(keyed, models, languages, group_bytes, bucket_bytes), "scored")
    words, letters = {}, {}
    for key, (_, middle, high) in bands(scored, "log_perplexity").items():
        words[key] = (0.0, middle + spread * (high - middle + BIN) / QUARTILE)
    for key, (low, middle, high) in bands(scored, "letter_perplexity").items():
        down, up = (spread * (x + BIN) / QUARTILE for x in (middle - low, high - middle))
        letters[key] = (middle - down, middle + up)
    inside = _within("log_perplexity", words) & _within("letter_perplexity", letters)
    failed = base_failed()
    judged = scored.withColumn("base_failed", failed).withColumn("kept", ~failed & inside)
    return keyed.join(judged, list(KEYS), "left").select(*rows.columns, COLUMN, "base_failed", "kept")
