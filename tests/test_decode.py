"""Archives inflated once: blocks, facts, and what damage does to them."""

import gzip
import hashlib
import random
import re

import pytest
from conftest import claim, put_archive
from pyspark.sql import functions as F

from claimworks.operators import quality
from claimworks.plans import publish as publishing
from claimworks.plans.publish import publish_months
from claimworks.sources import decode
from claimworks.sources.archives import MALFORMED
from claimworks.sources.curated import PARTITION


def blocks_of(text, size=64, longest=1 << 24, step=50, monkeypatch=None):
    monkeypatch.setattr(decode, "BLOCK_TEXT", size)
    monkeypatch.setattr(decode, "LONGEST_RECORD", longest)
    cutter = decode._Cutter()
    out = [b for i in range(0, len(text), step) for b in cutter.add(text[i : i + step])]
    return [*out, cutter.rest()]


@pytest.mark.parametrize("step", [1, 7, 50, 10_000])
def test_blocks_end_with_records(monkeypatch, step):
    rng = random.Random(step)
    records = [b"a;" + b"x" * rng.randrange(30) + rng.choice([b"", b';"two\nlines"', b';""']) + b"\n" for _ in range(200)]
    found = blocks_of(b"".join(records), step=step, monkeypatch=monkeypatch)
    assert b"".join(found) == b"".join(records)
    assert all(b.endswith(b"\n") and b.count(b'"') % 2 == 0 for b in found[:-1])
    assert len(found) > 20


def test_a_quote_that_never_closes_does_not_fill_the_memory(monkeypatch):
    text = b'a;"b\n' + b"c;d\n" * 5_000
    found = blocks_of(text, longest=1_000, monkeypatch=monkeypatch)
    assert b"".join(found) == text and max(map(len, found)) <= 1_100


def test_a_record_longer_than_a_block(monkeypatch):
    text = b"a;b\n" + b"x" * 500 + b"\n" + b"c;d\n" * 40
    found = blocks_of(text, monkeypatch=monkeypatch)
    assert b"".join(found) == text and all(b.endswith(b"\n") for b in found[:-1])


@pytest.fixture
def archives(spark, tmp_path):
    def make(**bodies):
        for name, body in bodies.items():
            (tmp_path / f"{name}.csv.gz").write_bytes(body)
        rows = [(f"file:{tmp_path}/{name}.csv.gz", "202503") for name in bodies]
        frame = spark.createDataFrame(rows, "path string, month string")
        decoded = decode.decode_archives(frame, str(tmp_path / "decoded"))
        name = F.regexp_extract("path", r"([^/]+)\.csv\.gz", 1)
        facts = {r["name"]: r for r in decode.archive_facts(decoded).withColumn("name", name).collect()}
        texts = {}
        for r in decoded.where("block IS NOT NULL").withColumn("name", name).orderBy("block").collect():
            texts[r["name"]] = texts.get(r["name"], "") + r["text"]
        return decoded, facts, texts

    return make


def test_facts_and_text(archives):
    body = b"a;b\r\n" + "1;é\n2;\n\n3;x".encode()
    members = gzip.compress(body[:9]) + gzip.compress(body[9:]) + b"\0" * 20
    decoded, facts, texts = archives(
        plain=gzip.compress(body), members=members, nothing=gzip.compress(b""), short=gzip.compress(body)[:-3],
        crc=gzip.compress(body)[:-8] + b"\0" * 8, tail=gzip.compress(body) + b"junk", latin=gzip.compress(b"a;b\n\xe9;1\n"),
        header=gzip.compress(b"a;b\n"), not_gzip=b"<p>busy</p>", empty=b"",
    )
    for name in ("plain", "members"):
        f = facts[name]
        assert (f["header"], f["text_bytes"], f["problem"]) == (["a", "b"], len(body), None)
        assert texts[name] == "1;é\n2;\n\n3;x"
    assert facts["members"]["sha256"] == hashlib.sha256(members).hexdigest()
    assert facts["members"]["bytes"] == len(members) and facts["members"]["magic"] == "1F8B"
    assert (facts["nothing"]["header"], facts["nothing"]["problem"]) == ([], None)
    assert facts["header"]["header"] == ["a", "b"] and "header" not in texts
    for name in ("short", "crc", "tail", "not_gzip", "empty"):
        assert facts[name]["problem"].startswith("unreadable archive"), name
    assert facts["latin"]["problem"] == "text is not UTF-8"
    rows = decode.parse_blocks(decoded.where(F.col("path").contains("plain")), ["a", "b"]).drop("month")
    assert sorted(map(tuple, rows.collect())) == [("1", "é", None), ("2", None, None), ("3", "x", None)]


def test_ragged_records_keep_their_line(archives):
    decoded, _, _ = archives(x=gzip.compress(b'a;b\n1;2;3\n4\n"5;5";6\n'))
    rows = decode.parse_blocks(decoded, ["a", "b"])
    found = {tuple(r)[:3] for r in rows.collect()}
    assert {r[2] for r in found} == {"1;2;3", "4", None} and ("5;5", "6", None) in found
    assert rows.columns == ["a", "b", MALFORMED, "month"]


def test_publication_inflates_once_and_reads_no_candidate_before_the_gate(spark, tmp_path, monkeypatch):
    put_archive(tmp_path, [claim(), claim(PRS_ACT_NBR="")])
    seen = []
    sound = publishing.observed_write

    def observed(rows, metrics, write):
        plan = rows.select(F.lit(1))._jdf.queryExecution().optimizedPlan().toString()
        assert "month = 202503" in plan or "month" in plan
        seen.append(re.findall(r"Exchange", rows._jdf.queryExecution().executedPlan().toString()))
        return sound(rows, metrics, write)

    monkeypatch.setattr(publishing, "observed_write", observed)
    monkeypatch.setattr(quality, "profile", lambda *a, **k: pytest.fail("second scan"))
    publish_months(spark, str(tmp_path), ["202503"], audit_duplicates=False)
    assert seen == [[]]  # one write of one month, nothing shuffled after the parse


def test_observed_metrics_equal_a_profile(spark, tmp_path):
    rows = spark.createDataFrame(
        [("202503", "1", "99", i % 3 - 1, None if i % 5 == 0 else "2") for i in range(100)],
        f"{PARTITION} string, PRS_REM_TYP string, BEN_RES_REG string, amount int, AGE_BEN_SNDS string",
    ).repartition(7)
    metrics = [
        F.count(F.lit(1)).alias("rows"), *quality.null_counts(["AGE_BEN_SNDS"]), *quality.checksums(["amount"]),
        F.count_if(F.col("amount") < 0).alias("negative"),
    ]
    found = quality.observed_write(rows, metrics, lambda df: df.write.parquet(str(tmp_path / "x")))
    assert found == rows.agg(*metrics).first().asDict()
