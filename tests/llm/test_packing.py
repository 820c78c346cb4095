"""Packing: tokens against the tokenizer itself, pieces and sequences against the texts."""

import functools
import itertools
import random
import zlib
from array import array

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import cloudpickle
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from claimworks.llm import packing
from claimworks.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
FOLDER = "/root/testdata/sf0.001"


@functools.cache
def plain():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, texts, capacity, lot_ids):
    """``rows`` (doc, start, length, ids, doc_tokens, sequence, offset) hold every id once, in sequences."""
    wanted = sorted(map(tuple, map(plain(), texts.values())))
    pieces, sequences = {}, {}
    for doc, start, length, ids, n, sequence, offset in rows:
        ids = list(array("I", bytes(ids)))
        assert len(ids) == length > 0
        pieces.setdefault((doc, n), []).append((start, ids))
        sequences.setdefault(sequence, []).append((offset, length))
    if len({d for d, _ in pieces}) == len(texts):  # unique ids: whole documents come back
        for (doc, n), found in pieces.items():
            assert list(itertools.chain(*(ids for _, ids in sorted(found)))) == plain()(texts[doc])
            assert n == len(plain()(texts[doc]))
    fill = []
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
        fill.append(end)
    total = sum(map(len, wanted))
    assert sum(fill) == total
    lots = total // lot_ids + 1
    assert len(fill) <= total / capacity * (1 + packing.SLACK) + 2 * lots


ALPHABET = list(" \n\t'ab.,;Zé  1!?-s日ß×") + ["'ll", "<|endoftext|>", " ", " ", "…", "Привет"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(ALPHABET), max_size=40).map("".join))
def test_units_leave_the_ids_alone(text):
    encoder = packing._encoder(PATH)
    assert [*array("I", encoder.ids(text)), 1] == plain()(text)


def test_tasks_of_a_worker_share_an_encoder():
    # every task unpickles the module anew
    sent = cloudpickle.dumps(packing._encoder)
    first, second = (cloudpickle.loads(sent)(PATH) for _ in range(2))
    assert first is second


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ALPHABET), max_size=8).map("".join), max_size=6))
def test_texts_split_together_keep_their_units(texts):
    ids = packing._encoder(PATH).ids_of([t.encode() for t in texts])
    assert [[*array("I", i), 1] for i in ids] == list(map(plain(), texts))


def test_a_forgetful_encoder_gives_the_same(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_UNITS", 3)
    encoder = packing.Encoder(PATH)
    texts = ["one two three four five", "", "one, two. three", "six one two", "é", ""]
    for some in (texts, texts[::-1], texts[:1], texts):
        assert [[*array("I", ids), 1] for ids in encoder.ids_of([t.encode() for t in some])] == list(map(plain(), some))


@pytest.mark.parametrize("n, k", [(1, 1), (3, 5), (20, 20), (50, 7), (400, 40), (7, 3)])
def test_differencing(n, k):
    sizes = np.array([random.Random(n * 31 + i).randrange(1, 1000) for i in range(n)])
    part = packing.differencing(sizes, k)
    loads = np.bincount(part, weights=sizes, minlength=k)
    assert len(part) == n and part.max() < k and loads.sum() == sizes.sum()
    if n >= 7 * k:
        assert loads.max() - loads.min() < 0.03 * loads.max()


def test_differencing_of_a_known_case():
    """Two parts of 4 5 6 7 8: the method ends at a difference of two."""
    part = packing.differencing(np.array([8, 7, 6, 5, 4]), 2)
    assert sorted(np.bincount(part, weights=[8, 7, 6, 5, 4])) == [14, 16]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=60))
def test_windows_hold_everything(lengths):
    pieces = [(d, 0, n) for d, n in enumerate(lengths)]
    found = packing.windows(pieces, 64)
    assert all(sum(n for *_, n in w) <= 64 for w in found)
    assert sorted((d, s + i) for w in found for d, s, n in w for i in range(n)) == sorted(
        (d, i) for d, n in enumerate(lengths) for i in range(n)
    )
    assert len(found) <= -(-sum(lengths) // 64) + 1


@pytest.mark.parametrize("capacity, lot_ids, part_bytes", [(2048, 1 << 21, 1 << 24), (16, 200, 400)])
def test_pieces_on_odd_rows(spark, capacity, lot_ids, part_bytes):
    rng = random.Random(5)
    texts = {i: " ".join(rng.choice(["the", "Straße", "x,", "\n"]) for _ in range(rng.randrange(30))) for i in range(60)}
    texts |= {60: None, 61: "", 62: "word " * 9000, 63: texts[3], 64: "a" * 5000, None: "no id"}
    rows = [(d, t, 1, "s", 7) for d, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, offset int, ids string, part int").repartition(4)
    got = packing.pack(docs, PATH, capacity=capacity, lot_ids=lot_ids, part_bytes=part_bytes)
    rows = [tuple(r) for r in got.collect()]
    lot_ids = min(lot_ids, 100 if part_bytes == 400 else lot_ids)
    check(rows, texts, capacity, lot_ids)
    assert sorted(rows, key=str) == sorted((tuple(r) for r in got.collect()), key=str)


def test_repeated_rows_and_an_empty_table(spark):
    docs = spark.createDataFrame([(1, "same text")] * 50 + [(None, None)] * 20, "doc_id long, text string")
    rows = packing.pack(docs, PATH).collect()
    n = len(plain()("same text"))
    assert sum(r["length"] for r in rows) == 50 * n + 20
    assert packing.pack(docs.limit(0), PATH).collect() == []


def test_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op12_packing"](spark, FOLDER).collect()
    ids = {d: plain()(t) for d, t in docs}
    for r in rows:
        some = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(some, "<u4").tobytes()) and len(some) == r["length"]
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
    frame = spark.createDataFrame(rows)
    assert frame.agg(F.sum("length")).head()[0] == sum(map(len, ids.values()))
    pieces = packing.pack(spark.read.parquet(f"{FOLDER}/documents.parquet"), PATH).collect()
    check([tuple(r) for r in pieces], dict(map(tuple, docs)), 2048, 1 << 21)
