"""Phrase mining against a plain version, and its parts at small limits."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from claimworks.llm import collocations as C

STOP = re.compile("[.,;:!?\x0a-\x0d]")
WORD = re.compile("[^\x20\x09]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def plain(rows, least, top):
    counts, sizes = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in STOP.split((text or "").translate(LOWER)):
            words = WORD.findall(piece)
            sizes[lang] += len(words)
            for n in range(1, 5):
                counts.update((lang, *words[i : i + n]) for i in range(len(words) - n + 1))
    candidates = {p: a for p, a in counts.items() if len(p) > 2 and a >= least}
    inside = Counter()
    for (lang, *words), a in candidates.items():
        for n in range(2, len(words)):
            for i in range(len(words) - n + 1):
                inner = (lang, *words[i : i + n])
                inside[inner] = max(inside[inner], a)
    found = []
    for phrase, a in candidates.items():
        if 100 * inside[phrase] >= 80 * a:
            continue
        lang, *words = phrase
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, *words[:k]], counts[lang, *words[k:]]
            cuts.append((2_000_000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        found.append((lang, " ".join(words), a, left, right, sizes[lang], score))
    result = []
    for lang in sizes:
        mine = sorted((f for f in found if f[0] == lang), key=lambda f: (-f[6], -f[2], f[1].encode()))
        result += [(lang, i, *f[1:]) for i, f in enumerate(mine[:top], 1)]
    return sorted(result)


def corpus(seed=3):
    rng = random.Random(seed)
    words = ["The", "of", "new", "York", "état", "a\x00b", "x-y", "city", "ß", "日本"]
    phrases = ["new york city", "the state of the art", "of of of of of", "x-y x-y"]
    rows = []
    for i in range(300):
        parts = [rng.choice(phrases) if rng.random() < 0.4 else rng.choice(words) for _ in range(rng.randrange(40))]
        text = "".join(p + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "\r"]) for p in parts)
        rows.append((rng.choice(["en", "en", "de", None, "und"]), text))
    rows += [("en", "hot phrase here"), ("fr", None), (None, ""), ("es", ".,!")] * 60
    rows.append(("de", "very long text " * 8_000))
    return rows


SCHEMA = "lang string, text string, words int, n string, bucket int"


@pytest.mark.parametrize("limits", [
    {}, {"bucket_words": 300, "hot": 50, "table_bits": 8, "chunk_words": 500}, {"top": 3}, {"table_bits": 24, "hot": 1},
])
def test_matches_plain_version(spark, limits):
    rows = corpus()
    frame = spark.createDataFrame([(*r, 1, "n", 2) for r in rows], SCHEMA).repartition(5)
    got = sorted(map(tuple, C.mine(frame, least=5, **limits).collect()))
    assert got == plain(rows, 5, limits.get("top", C.TOP))


def test_ties_go_by_bytes_of_the_phrase(spark):
    rows = [("en", f"{a} {b}") for a, b in [("b", "c"), ("B", "d"), ("a", "é"), ("a_", "z")] for _ in range(30)]
    frame = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(map(tuple, C.mine(frame).collect())) == plain(rows, 30, C.TOP)


def test_empty_tables(spark):
    assert C.mine(spark.createDataFrame([], "lang string, text string")).collect() == []
    assert C.mine(spark.createDataFrame([(None, None)], "lang string, text string")).collect() == []


def test_words_that_share_a_hash_get_another_seed(spark, monkeypatch):
    """Under seed 1 all words would be one."""
    sound = C.word_hash
    monkeypatch.setattr(C, "word_hash", lambda lang, word, seed: 7 if seed == 1 else sound(lang, word, seed))
    rows = corpus(4)[:100]
    frame = spark.createDataFrame(rows, "lang string, text string")
    words, seed = C._words(frame.selectExpr("coalesce(lang, 'und') lang", "text"))
    assert seed == 2 and words.count() == words.select("h").distinct().count()
    assert sorted(map(tuple, C.mine(frame, least=3).collect())) == plain(rows, 3, C.TOP)


def test_bit_table_holds_every_key(spark):
    keys = np.random.default_rng(1).integers(-(1 << 63), (1 << 63) - 1, 5_000)
    frame = spark.createDataFrame([(int(k),) for k in keys], "key long")
    for bits in (6, 16, 24):
        table = C._Bits.of(frame, bits)
        assert table.has(keys.view(np.uint64)).all()
    other = np.random.default_rng(2).integers(-(1 << 63), (1 << 63) - 1, 5_000)
    assert table.has(other.view(np.uint64)).mean() < 0.01


class _Every:
    def has(self, keys):
        return np.ones(len(keys), bool)


@pytest.mark.parametrize("most", [1, 4, C.WORD_ROWS])
@pytest.mark.parametrize("size", [1, 2, 3])
def test_stripes_of_numbered_words(size, most, monkeypatch):
    """Numbers of words start anew after a chunk; hashes, buckets and counts are those of the words."""
    monkeypatch.setattr(C, "WORD_ROWS", most)
    rows = [("und" if lang is None else lang, text or "") for lang, text in corpus(5)]
    batches = [pa.RecordBatch.from_pylist([{"lang": a, "text": t} for a, t in rows[i : i + 7]]) for i in range(0, len(rows), 7)]
    wanted, found = Counter(), Counter()
    for lang, text in rows:
        h = [0 if w == C.BREAK else C.word_hash(lang, w, 1) for w in [*C.tokens([text]), *[C.BREAK] * size]]
        for i in range(len(h) - size):
            if all(h[i : i + size]):
                wanted[tuple(h[i : i + size]), h[i + size] if all(h[i + 1 : i + size + 1]) else 0] += 1
    for row in pa.Table.from_batches(C._striper(size, 1, _Every(), _Every(), 5, 50)(iter(batches))).to_pylist():
        for j, (following, n) in enumerate(zip(row["next"], row["n"], strict=True)):
            found[(row["first"], *row["rest"][j * (size - 1) : (j + 1) * (size - 1)]), following] += n
    assert found == wanted
    with pytest.raises(StopIteration):
        next(C._stripes(np.array([1, 0]), np.array([0, 7], np.uint64), 2, _Every(), _Every(), 5))
