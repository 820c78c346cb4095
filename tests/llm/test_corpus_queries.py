"""The numbered queries and the pipeline on the smallest sample, against plain versions and SQL."""

import brute
import duckdb
import pytest
from oracle_check import compare, tables

import corpus_pipeline
from claimworks.llm.oracle import ORACLE
from claimworks.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def sample(columns, name="documents"):
    return duckdb.sql(f"SELECT {columns} FROM '{FOLDER}/{name}.parquet'").fetchall()


PLAIN = {
    "op1_suffix_dedup": lambda: brute.suffix(sample("doc_id, text")),
    "op3_simhash_dedup": lambda: brute.simhash(sample("doc_id, text")),
    "op4_substring_dedup": lambda: brute.substring(sample("doc_id, text")),
    "op5_benchmark_decontamination": lambda: brute.decontamination(
        sample("doc_id, text"), sample("item_id, text", "benchmark")
    ),
    "op7_license_scan": lambda: brute.license_base(sample("doc_id, text")),
    "op9_warc_packages": lambda: brute.warc(sample("page_id, html", "pages")),
    "op10_secret_scan": lambda: brute.secret_base(sample("doc_id, text")),
}


@pytest.mark.parametrize("name", sorted(PLAIN))
def test_query_matches_plain_version(spark, name):
    want = PLAIN[name]()
    got = [tuple(r)[: len(want[0])] for r in QUERIES[name](spark, FOLDER).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    equal, rows, message = compare(spark, tables(FOLDER), FOLDER, name, QUERIES[name], ORACLE[name])
    assert equal and rows, message


def test_quality_query(spark):
    rows = QUERIES["op8_quality_rules"](spark, FOLDER).collect()
    assert sorted((tuple(r)[:7] for r in rows), key=str) == brute.quality_base(sample("doc_id, text"))
    assert not any(r["kept"] and r["base_failed"] for r in rows)


def test_mix_query(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op6_source_mix"](spark, FOLDER).collect()}
    sources = dict(sample("doc_id, source"))
    sizes = {d: len(brute.SPACE_WORD.findall(t or "")) for d, t in sample("doc_id, text")}
    assert {d: r["size"] for d, r in rows.items()} == sizes
    for source in set(sources.values()):
        mine = [r for d, r in rows.items() if sources[d] == source]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 10
        assert all(r["taken"] <= 2 * r["size"] for r in mine)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, FOLDER), name)
        seen[name] = docs.collect()
        if name != "source_mix":
            assert docs.columns == columns
    kept = {r["doc_id"] for r in QUERIES["op8_quality_rules"](spark, FOLDER).where("kept").collect()}
    assert {r["doc_id"] for r in seen["quality_rules"]} == kept
    left = [(r["doc_id"], r["text"]) for r in seen["quality_rules"]]
    leaders = {c for _, _, c in brute.simhash(left)}
    assert {r["doc_id"] for r in seen["near_duplicates"]} == leaders
    items = sample("item_id, text", "benchmark")
    before = [(r["doc_id"], r["text"]) for r in seen["near_duplicates"]]
    hits = {r[0]: r[2] for r in brute.decontamination(before, items)}
    cleaned = {r["doc_id"]: r["text"] for r in seen["benchmark_decontamination"]}
    for doc_id, text in before:
        words = len(brute.PLAIN_WORD.findall(text))
        assert len(brute.PLAIN_WORD.findall(cleaned[doc_id])) == words - hits[doc_id]
        assert hits[doc_id] or cleaned[doc_id] == text
    masked = {r["doc_id"]: r["text"] for r in seen["secret_scans"]}
    secret = {r[0] for r in brute.secret_base(list(cleaned.items())) if sum(r[1:4])}
    assert {d for d in masked if masked[d] != cleaned[d]} == secret
    assert all(r["n_chars"] == len(r["text"]) for r in seen["secret_scans"])
    assert not any(sum(r[1:4]) for r in brute.secret_base(list(masked.items())))
    assert {r["copies"] for r in seen["source_mix"]} <= {1, 2}
