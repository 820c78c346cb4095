"""Character models against a plain scorer, and runs of great length."""

import base64
import math
import random
import time

import pytest

from claimworks.llm import secret_scan as S

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def table(spark):
    return S.train(S.labelled_samples(spark))


def plain_steps(value, table):
    places = [S.ALPHABET.find(c) for c in value]
    return [table[a * len(S.ALPHABET) + b] if a >= 0 and b >= 0 else 0.0 for a, b in zip(places, places[1:])]


def test_ratio_matches_plain_scorer(spark, table):
    rng = random.Random(2)
    values = ["".join(rng.choice(S.ALPHABET + " é😀") for _ in range(n)) for n in range(60)]
    frame = spark.createDataFrame(list(enumerate(values)), SCHEMA)
    got = dict(frame.select("doc_id", S.likelihood_ratio(frame["text"], table)).collect())
    for i, value in enumerate(values):
        steps = plain_steps(value, table)
        want = sum(steps) / len(steps) if steps else 0.0
        assert math.isclose(got[i], want, rel_tol=1e-4, abs_tol=1e-4), value


def run_of(kind, n):
    if kind == "random":
        return base64.b64encode(random.Random(n).randbytes(n)).decode()[:n]
    return "-".join(["customer", "account", "export"] * (n // 20))[:n]


@pytest.mark.parametrize("kind, spans", [("random", 1), ("words", 0)])
def test_long_runs_take_time_in_proportion(spark, table, kind, spans):
    took = []
    for n in (1_000, 250_000, 500_000):
        text = f"see {run_of(kind, n)} there"
        frame = S.find_secrets(spark.createDataFrame([(1, text)], SCHEMA), table)
        began = time.perf_counter()
        found = frame.head()["secrets"]
        took.append(time.perf_counter() - began)
        assert [(s["start"], s["end"]) for s in found] == [(4, 4 + n)] * spans
    assert took[2] < 60 and took[2] < 5 * took[1] + 5


def test_columns_with_names_of_helpers_stay(spark, table):
    rows = [(1, "x", "y", "z", "password = abcdefgh12345678"), (2, None, None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, base string, base_ string, __base string, text string")
    got = S.find_secrets(frame, table).orderBy("doc_id").collect()
    assert [tuple(r)[:5] for r in got] == rows and [len(r["secrets"]) for r in got] == [1, 0]
    assert S.find_secrets(frame.limit(0), table).collect() == []
