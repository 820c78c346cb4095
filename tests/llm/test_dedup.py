"""Substring, suffix and SimHash dedup against plain versions."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from claimworks.llm import simhash, substring, suffixes
from claimworks.llm.components import components

SCHEMA = "doc_id long, text string, fp string, spans string, kept string"


def frame(spark, rows):
    """Rows with further columns whose names clash with those of the operators."""
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)


def odd_rows(seed, words=12, n=60):
    """Nulls, empty and long texts, ties, repeated rows, copies and shared passages."""
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "bb", "é", "dd-d", "Zz", "日本"])[: rng.randrange(1, 4)]
    text = lambda k: rng.choice([" ", "  ", "\n"]).join(word() for _ in range(k))
    passage = text(words)
    rows = [(None, None), (None, ""), (3, None), (3, " \t\n"), (4, "solo")]
    rows += [(rng.randrange(n), text(rng.randrange(30))) for _ in range(n)]
    rows += [(100 + i, f"{text(3)} {passage} {text(3)}") for i in range(10)]
    rows += [(200 + i, rows[10][1]) for i in range(5)] + [rows[12]] * 3
    rows += [(300, "ab " * 500), (301, text(3000)), (None, passage), (None, passage)]
    return rows


def substring_result(found):
    chosen = found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256))
    return sorted(map(tuple, chosen.collect()), key=str)


@pytest.mark.parametrize("window, group_bytes", [(4, 200), (5, 1 << 20), (20, 500)])
def test_substring_matches_plain_version(spark, window, group_bytes):
    rows = odd_rows(window, words=2 * window)
    found = substring.drop_repeated_windows(frame(spark, rows), window, group_bytes, 300)
    assert substring_result(found) == brute.substring(rows, window)


def test_substring_spans_are_maximal_runs(spark):
    line = " ".join(f"w{i}" for i in range(8))
    found = substring.drop_repeated_windows(frame(spark, [(1, f"x {line} y"), (2, f"{line} z {line}")]), 4)
    spans = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in found.collect()}
    assert spans == {1: [], 2: [(0, 8), (9, 17)]}


def suffix_result(found):
    chosen = found.select("doc_id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256))
    return sorted(map(tuple, chosen.collect()), key=str)


@pytest.mark.parametrize("length, group_bytes", [(8, 300), (25, 1 << 20), (2, 400)])
def test_suffixes_match_plain_version(spark, length, group_bytes):
    rows = odd_rows(length)
    found = suffixes.drop_repeated_bytes(frame(spark, rows), length, group_bytes, 300)
    assert suffix_result(found) == brute.suffix(rows, length)


def test_suffix_sort_orders_by_text():
    rng = np.random.default_rng(5)
    text = rng.integers(97, 99, 3000).astype(np.uint8)
    spans = suffixes.A.Spans(suffixes.A.byte_values(5)[text])
    place = rng.permutation(2900)[:700]
    first, size = np.zeros(700, np.int64), np.full(700, 700)
    order = suffixes.sort_suffixes(text, spans, place, first, size, 60)
    raw = text.tobytes()
    assert [raw[p : p + 60] for p in place[order]] == sorted(raw[p : p + 60] for p in place)


def test_fingerprints_and_components_match_plain_version(spark):
    rng = random.Random(3)
    base = " ".join(rng.choice(["alpha", "beta", "GAMMA", "delta"]) + str(rng.randrange(40)) for _ in range(300))
    near = [(i, base.replace("beta7", f"new{i}") + f" tail{i % 3}") for i in range(40)]
    rows = near + [(100, ""), (101, None), (102, "one"), (103, "two words"), (104, "One"), (40, base), (40, base)]
    found = simhash.near_duplicates(frame(spark, rows))
    got = sorted(
        (r["doc_id"], f"{r['fp'] & (1 << 64) - 1:016x}", r["component_id"]) for r in found.collect()
    )
    assert got == brute.simhash(rows)


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_links_are_all_pairs_within_the_distance(spark, distance):
    rng = random.Random(distance)
    seeds = [rng.getrandbits(64) for _ in range(8)]
    values = {s ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for s in seeds for _ in range(12)}
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    pairs = {tuple(r) for r in simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), distance).collect()}
    mask = (1 << 64) - 1
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= distance}
    assert pairs == want


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    found = dict(map(tuple, components(spark.createDataFrame(pairs, "a long, b long")).collect()))
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100)}


def test_one_document_of_each_group_stays(spark):
    rows = [(5, "same text here"), (2, "same text here"), (2, "same text here"), (None, "other words stand alone"), (9, None)]
    kept = simhash.one_of_each(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "fp", "spans", "kept"]
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect() if r["doc_id"]) == [(2, "same text here"), (9, None)]
    assert kept.count() == 3


def test_empty_tables(spark):
    none = frame(spark, [])
    assert substring.drop_repeated_windows(none).count() == 0
    assert suffixes.drop_repeated_bytes(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.one_of_each(none).count() == 0
