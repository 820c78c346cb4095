"""Phrase mining by stripes: each prefix keys a counter of next words.

Round m reads all texts and makes, per task, one stripe for each prefix of m words: how often each next
word follows, and how often none that matters does. Stripes of a prefix are merged element by element.
One structure thus gives the phrases of m + 1 words with their counts, the totals of the prefixes, and,
as phrases carry their counts to the two phrases one word shorter, what longer phrases take up.

A phrase can reach the least count only if both phrases one word shorter do. So a round counts next
words only where a bit table of the frequent phrases of the round before allows it. The table has a
fixed size; where it errs, a phrase too many is counted, and its exact count drops it.

Words are 64-bit hashes of language and word. All distinct words are counted as text first, and if two
share a hash, another seed is taken: within a corpus hashes then stand for words exactly.
"""

from __future__ import annotations

import itertools
import sys
import uuid
from array import array
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimworks.llm.arrays import U64, mix
from claimworks.llm.tables import small_batches, stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LONGEST = 4  # words of a phrase
LEAST = 30  # occurrences
COVERED = (100, 80)  # dropped where a longer phrase has 80 of 100 occurrences
SCALE = 2_000_000
TOP = 2_000  # phrases reported per language
SALTS = 64  # parts of a language that are ranked apart first
BUCKET_WORDS = 1_500_000  # occurrences per group of prefixes
HOT = 1_000_000  # the stripes under a first word as frequent as this are dealt over many buckets
SLICES = 64
TABLE_BITS = 27  # of a bit table of frequent phrases: 16 MB, whatever the corpus
SLICE_BITS = 21
CHUNK_WORDS = 2_500_000  # words whose stripes a task makes at once
WORD_ROWS = 300_000
BREAK = b"\xff"  # in no UTF-8 text
_LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_STOPS = b".,;:!?\n\x0b\x0c\r"
CLEAN = bytes.maketrans(_LOWER[0] + _STOPS, _LOWER[1] + BREAK * len(_STOPS))
STRIPE = "bucket int, first long, rest array<long>, next array<long>, n array<int>"
ENTRY = "words array<long>, n long, total boolean, key long"
STEP = U64(0x9E3779B97F4A7C15)


def mine(
    docs: DataFrame, *, least: int = LEAST, top: int = TOP, longest: int = LONGEST, bucket_words: int = BUCKET_WORDS,
    hot: int = HOT, table_bits: int = TABLE_BITS, chunk_words: int = CHUNK_WORDS,
) -> DataFrame:
    """The best phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    ``a`` counts a phrase, ``l`` and ``r`` its two parts at the cut of the lowest score
    ``floor(2000000 a / (l + r))``, the first of equal ones; ``n`` counts the language's words. Phrases
    inside a longer one with 80 % of their occurrences are dropped. Ranks go by score, count and phrase
    (bytes), so there are no ties.

    Texts are lower-cased (A-Z), cut at ``.,;:!?`` and line ends, and split at spaces and tabs; a null
    text has no words, a null language is ``und``. Texts of any length are read whole, repeated rows count
    every time, ids and other columns are not read. An empty table gives no rows. Products are decimal.
    Stripes travel under the first word of their prefix, one row per task and word; those under very
    frequent words are dealt over many buckets. A lost task is run again over the same rows; every round's counts are stored.
    """
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    words, seed = _words(rows)
    counted = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).head()["n"]
    buckets = counted // bucket_words + 1
    frequent = words.where(F.col("n") >= least).select(F.array("h").alias("words"), "n", F.col("h").alias("key"))
    found = []
    sliced = _Bits.of(frequent.where(F.col("n") >= hot), table_bits)
    for size in range(1, longest):
        allowed = _Bits.of(frequent, table_bits)
        with small_batches(rows.sparkSession):
            stripes = rows.mapInArrow(_striper(size, seed, allowed, sliced, buckets, chunk_words), STRIPE)
            merged = stored(stripes.groupBy("bucket").applyInArrow(_merge, ENTRY), f"stripes{size}")
        found.append(merged)
        frequent = merged.where(~F.col("total") & (F.col("n") >= least))
    return _ranked(_scored(found, least), words, top)


def _words(rows: DataFrame) -> tuple[DataFrame, int]:
    """``lang, word, h, n`` for all distinct words, under the first seed that gives no two one hash."""
    for seed in itertools.count(1):
        with small_batches(rows.sparkSession):
            counted = rows.mapInArrow(_counter(seed), "lang string, word string, h long, n long")
            words = stored(counted.groupBy("lang", "word", "h").agg(F.sum("n").alias("n")), "words")
        clashes = words.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where("k > 1 OR h = 0")
        if clashes.isEmpty():
            return words, seed


def word_hash(lang: str, word: bytes, seed: int) -> int:
    """XXH64 of language and word, as a signed number."""
    h = xxhash.xxh64_intdigest(lang.encode() + BREAK + word, seed)
    return h - (1 << 64) if h >> 63 else h


def tokens(texts: list) -> list[bytes]:
    """The words of texts, with a break between pieces and between texts."""
    joined = "\n".join(t for t in texts if t).encode()
    return joined.translate(CLEAN).replace(BREAK, b" " + BREAK + b" ").split()


def _by_lang(batch: pa.RecordBatch) -> dict[str, list]:
    texts: dict[str, list] = {}
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
        texts.setdefault(lang, []).append(text)
    return texts


def _counter(seed: int):
    def rows(counts: dict):
        for lang, counter in counts.items():
            counter.pop(BREAK, None)
            if counter:
                words = list(counter)
                yield pa.record_batch([
                    pa.array([lang] * len(words)), pa.array(words, pa.binary()).cast(pa.string()),
                    pa.array([word_hash(lang, w, seed) for w in words], pa.int64()),
                    pa.array(list(counter.values()), pa.int64()),
                ], names=["lang", "word", "h", "n"])

    def run(batches):
        counts: dict[str, Counter] = {}
        for batch in batches:
            for lang, texts in _by_lang(batch).items():
                counts.setdefault(lang, Counter()).update(tokens(texts))
            if sum(map(len, counts.values())) > WORD_ROWS:
                yield from rows(counts)
                counts = {}
        yield from rows(counts)

    return run


class _Bits:
    """A set of 64-bit keys as a bit table of fixed size, in compressed slices; it may hold too much."""

    _open: dict = {}

    def __init__(self, bits: int, slices: list):
        self.bits, self.slices, self.name = bits, slices, uuid.uuid4().hex

    @classmethod
    def of(cls, keys: DataFrame, bits: int) -> _Bits:
        low = min(SLICE_BITS, bits)
        place = F.shiftrightunsigned("key", 64 - bits)
        placed = keys.select(
            F.shiftright(place, low).cast("int").alias("slice"), place.bitwiseAND((1 << low) - 1).alias("place")
        ).distinct()

        def fill(table: pa.Table) -> pa.Table:
            flags = np.zeros(1 << low, bool)
            flags[table.column("place").to_numpy()] = True
            body = pa.compress(np.packbits(flags).tobytes(), codec="zstd", asbytes=True)
            return pa.table([table.column("slice")[:1], pa.array([body], pa.binary())], names=["slice", "body"])

        made = placed.groupBy("slice").applyInArrow(fill, "slice int, body binary").collect()
        return cls(bits, [(r["slice"], bytes(r["body"])) for r in made])

    def has(self, keys: np.ndarray) -> np.ndarray:
        if self.name not in self._open:
            self._open.clear() if len(self._open) > 3 else None
            low = min(SLICE_BITS, self.bits)
            size = max((1 << low) // 8, 1)
            table = np.zeros(size << (self.bits - low), np.uint8)
            for at, body in self.slices:
                raw = pa.decompress(body, decompressed_size=size, codec="zstd", asbytes=True)
                table[at * size : (at + 1) * size] = np.frombuffer(raw, np.uint8)
            self._open[self.name] = table
        place = keys >> U64(64 - self.bits)
        return (self._open[self.name][place >> U64(3)] >> (U64(7) - (place & U64(7))).astype(np.uint8)) & 1 > 0


def _striper(size: int, seed: int, allowed: _Bits, sliced: _Bits, buckets: int, chunk_words: int):
    """Stripes of all prefixes of ``size`` words in a task's texts."""

    def run(batches):
        parts, held, known, hashes, number = [], 0, {}, array("q", [0]), itertools.count(1)
        for batch in batches:
            for lang, texts in _by_lang(batch).items():
                found = tokens(texts)
                if lang not in known:
                    known[lang] = defaultdict(number.__next__, {BREAK: 0})
                table = known[lang]
                before = len(table)
                parts += [np.fromiter(map(table.__getitem__, found), np.int64, len(found)), np.zeros(1, np.int64)]
                hashes.extend(word_hash(lang, word, seed) for word in itertools.islice(table, before, None))
                held += len(found)
            if held >= chunk_words or len(hashes) > 2 * WORD_ROWS:
                yield from _stripes(np.concatenate(parts), np.array(hashes).view(U64), size, allowed, sliced, buckets)
                parts, held = [], 0
                if len(hashes) > WORD_ROWS:
                    known, hashes, number = {}, array("q", [0]), itertools.count(1)
        if held:
            yield from _stripes(np.concatenate(parts), np.array(hashes).view(U64), size, allowed, sliced, buckets)

    return run


def phrase_key(words: list) -> np.ndarray:
    """One 64-bit key per phrase, from the hashes of its words (arrays of equal length)."""
    key = words[0]
    for word in words[1:]:
        key = mix(key * STEP + word)
    return key


def _stripes(words: np.ndarray, hashes: np.ndarray, size: int, allowed: _Bits, sliced: _Bits, buckets: int):
    """Arrow rows ``bucket, first, rest, next, n``: the stripes of all prefixes with one first word.

    ``words`` are numbers of words, 0 for breaks, and ``hashes`` the hashes by number. ``rest`` holds the
    other words of each entry's prefix; ``next`` 0 stands for breaks and words that do not matter.
    """
    n = len(words) - size  # the last word of all is a break
    if n <= 0:
        return
    at = np.flatnonzero(np.logical_and.reduce([words[i : i + n] != 0 for i in range(size)]))
    at = at[allowed.has(phrase_key([hashes[words[at + i]] for i in range(size)]))]
    if not len(at):
        return
    ok = np.zeros(n + 1, bool)
    ok[at] = True
    following = np.where(ok[at + 1], words[at + size], 0)
    del ok
    v = np.int64(len(hashes))
    group, pairs = words[at], []
    for i in range(1, size):
        distinct, group = np.unique(group * v + words[at + i], return_inverse=True)
        pairs.append(distinct)
    code = np.sort(group * v + following)
    del group, following, at
    starts = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
    count = np.diff(starts, append=len(code))
    word, following = np.divmod(code[starts], v)
    others = []
    for distinct in reversed(pairs):
        word, other = np.divmod(distinct[word], v)
        others.insert(0, hashes[other])
    head, following = hashes[word], hashes[following]
    second = others[0] if others else following
    deal = np.where(sliced.has(head), mix(second ^ STEP) % U64(SLICES), U64(0))
    bucket = (((mix(head ^ STEP) >> U64(1)) + deal) % U64(buckets)).astype(np.int64)
    order = np.argsort(word * np.int64(buckets) + bucket, kind="stable")  # in runs already, one for each word
    word, bucket, count = head[order], bucket[order].astype(np.int32), count[order].astype(np.int32)
    following = following[order].view(np.int64)
    rest = np.stack([o[order] for o in others], axis=1).ravel().view(np.int64) if others else np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate(([True], (word[1:] != word[:-1]) | (bucket[1:] != bucket[:-1]))))
    ends = np.append(starts, len(order)).astype(np.int32)
    step = 2_000
    for a in range(0, len(starts), step):
        b = min(a + step, len(starts))
        lo, hi = ends[a], ends[b]
        offsets = ends[a : b + 1] - lo
        yield pa.record_batch([
            pa.array(bucket[starts[a:b]]), pa.array(word[starts[a:b]].view(np.int64)),
            pa.ListArray.from_arrays(pa.array(offsets * (size - 1)), pa.array(rest[lo * (size - 1) : hi * (size - 1)])),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(following[lo:hi])),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(count[lo:hi])),
        ], names=["bucket", "first", "rest", "next", "n"])


def _merge(table: pa.Table) -> pa.Table:
    """All stripes of a bucket added element by element: extensions and prefix totals."""
    flat = lambda name: np.concatenate([c.flatten().to_numpy() for c in table.column(name).chunks])
    lengths = np.concatenate([c.value_lengths().to_numpy() for c in table.column("next").chunks])
    following, n = flat("next").view(U64), flat("n").astype(np.int64)
    rest = flat("rest").view(U64)
    size = 1 + len(rest) // len(following)
    first = np.repeat(table.column("first").to_numpy().view(U64), lengths)
    heads = np.concatenate((first[:, None], rest.reshape(len(first), size - 1)), axis=1)
    # sort the entries of all stripes by prefix and next word, and number the prefixes
    order = np.lexsort((following, *heads.T[::-1]))
    heads, following, n = heads[order], following[order], n[order]
    new = np.concatenate(([True], (heads[1:] != heads[:-1]).any(axis=1)))
    prefix, heads = np.cumsum(new) - 1, heads[new]
    starts = np.flatnonzero(np.concatenate(([True], (prefix[1:] != prefix[:-1]) | (following[1:] != following[:-1]))))
    sums, prefix, following = np.add.reduceat(n, starts), prefix[starts], following[starts]
    totals = np.zeros(len(heads), np.int64)
    np.add.at(totals, prefix, sums)
    real = following != 0
    prefix, following, sums = prefix[real], following[real], sums[real]
    longer = np.concatenate((heads[prefix], following[:, None]), axis=1)
    keys = phrase_key([longer[:, i] for i in range(size + 1)])
    lists = lambda x: pa.ListArray.from_arrays(
        pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(np.ascontiguousarray(x).ravel().view(np.int64))
    )
    return pa.table({
        "words": pa.concat_arrays([lists(longer), lists(heads)]),
        "n": np.concatenate((sums, totals)),
        "total": np.concatenate((np.zeros(len(sums), bool), np.ones(len(totals), bool))),
        "key": np.concatenate((keys, phrase_key([heads[:, i] for i in range(size)]))).view(np.int64),
    })


def _exact(column) -> Column:
    return F.col(column).cast("decimal(28,0)")


def _scored(found: list[DataFrame], least: int) -> DataFrame:
    """``words, a, l, r, score`` of the phrases that no longer one takes up."""
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    totals = every.where("total").groupBy("words").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    phrases = every.where(~F.col("total") & (F.col("n") >= least)).select("words", F.col("n").alias("a"))
    size = F.size("words")
    within = phrases.where(size > 2).select(
        F.explode(F.array(F.slice("words", 1, size - 1), F.slice("words", 2, size - 1))).alias("inner"), "a"
    ).groupBy("inner").agg(F.max("a").alias("most"))
    left = phrases.join(within, phrases["words"] == within["inner"], "left").where(
        F.col("most").isNull() | (COVERED[0] * _exact("most") < COVERED[1] * _exact("a"))
    )
    cuts = left.select("words", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "words", "a", "k", F.slice("words", 1, F.col("k")).alias("head"),
        F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")).alias("rest"),
    )
    heads = totals.select(F.col("words").alias("head"), F.col("n").alias("l"))
    rests = totals.select(F.col("words").alias("rest"), F.col("n").alias("r"))
    score = F.expr(f"CAST({SCALE} AS DECIMAL(8,0)) * CAST(a AS DECIMAL(28,0)) DIV (CAST(l AS DECIMAL(28,0)) + r)")
    return cuts.join(heads, "head").join(rests, "rest").withColumn("score", score).groupBy("words", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    ).select("words", "a", "cut.l", "cut.r", "cut.score")


def _ranked(phrases: DataFrame, words: DataFrame, top: int) -> DataFrame:
    """The first of each language, spelled out."""
    spelled = phrases.select("words", F.posexplode("words").alias("at", "h")).join(
        words.select("h", "lang", "word"), "h"
    ).groupBy("words").agg(
        F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("at", "word"))).alias("spelled")
    )
    named = phrases.join(spelled, "words").select(
        "lang", F.array_join("spelled.word", " ").alias("phrase"), "a", "l", "r", "score"
    )
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    some = named.withColumn("salt", salt).withColumn(
        "place", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*best))
    ).where(F.col("place") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.where(F.col("rank") <= top).join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
