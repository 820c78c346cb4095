"""Publication and row comparison at size: what travels, what runs compiled, what is read anew."""

import datetime
import uuid
from decimal import Decimal

import pytest
from conftest import claim, put_archive, put_text
from pyspark.sql import functions as F

from claimworks import queries
from claimworks.operators import fingerprints, quality
from claimworks.plans import bindings, publish, verify
from claimworks.plans.analyses import ANALYSES
from claimworks.schema import CLAIMS
from claimworks.session import METHOD_LIMIT
from claimworks.sources.archives import CSV_TEXT
from claimworks.sources.decode import decode_archives, parse_blocks


def put_tables(spark, folder, lines):
    """Sample tables of a few order lines ``(order, line, price)`` in one month."""
    day = datetime.date(1995, 3, 7)
    rows = [(o, 1, 1, n, 2.0, float(p), 0.05, 0.02, "A", "F", day) for o, n, p in lines]
    schema = (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate date"
    )
    tables = {
        "lineitem": (rows, schema),
        "orders": ([(o, 1, day) for o in {r[0] for r in lines}], "o_orderkey long, o_custkey long, o_orderdate date"),
        "customer": ([(1, 3)], "c_custkey long, c_nationkey int"),
        "supplier": ([(1, 4)], "s_suppkey long, s_nationkey int"),
        "part": ([(1, 7)], "p_partkey long, p_size int"),
    }
    for name, (found, columns) in tables.items():
        spark.createDataFrame(found, columns).write.mode("overwrite").parquet(f"{folder}/{name}.parquet")


def test_published_rows_are_those_of_the_tables_now(spark, tmp_path):
    folder = str(tmp_path)
    totals = []
    for lines in ([(1, 1, 5), (1, 2, 6)], [(1, 1, 5), (1, 2, 6), (2, 1, 7)]):
        put_tables(spark, folder, lines)
        spark.catalog.clearCache()
        totals.append(queries.QUERIES["publish_roundtrip"](spark, folder).select("rows", "PRS_PAI_MNT").first())
    assert [tuple(t) for t in totals] == [(2, Decimal(11)), (3, Decimal(18))]


def test_dealt_claims_are_the_claims(spark, tmp_path):
    put_tables(spark, str(tmp_path), [(o, n, o + n) for o in range(40) for n in (1, 2, 3)])
    plain = bindings.claims(spark, str(tmp_path), keep=["l_orderkey"])
    dealt = bindings.claims(spark, str(tmp_path), keep=["l_orderkey"], deal="l_shipdate")
    assert sorted(map(str, plain.collect())) == sorted(map(str, dealt.collect()))
    assert "RebalancePartitions" in dealt._jdf.queryExecution().optimizedPlan().toString()


def test_line_ends_of_blocks(spark):
    rows = [("p", "202503", 0, "1;2\n3;4\n"), ("p", "202503", 1, "5;6\r\n7;8\r9;10\n\n  \n"), ("p", "202503", None, None)]
    decoded = spark.createDataFrame(rows, "path string, month string, block long, text string")
    found = parse_blocks(decoded, ["a", "b"]).select("a", "b").collect()
    assert sorted(map(tuple, found)) == [("1", "2"), ("3", "4"), ("5", "6"), ("7", "8"), ("9", "10")]


def test_differences_are_found_once_with_short_methods(spark, monkeypatch):
    key, value = METHOD_LIMIT
    before, seen, plain = spark.conf.get(key), [], fingerprints.differing_buckets
    monkeypatch.setattr(
        fingerprints, "differing_buckets", lambda *a: seen.append(spark.conf.get(key)) or plain(*a)
    )
    left = spark.range(50).select(F.lit("g").alias("g"), F.col("id").cast("string").alias("v"))
    right = left.where("v <> '7'")
    spark.conf.set(key, "65535")
    try:
        for buckets in (1, 4):  # all buckets asked for, then some
            found = fingerprints.row_differences_by_bucket(left, right, "g", buckets)
            assert [tuple(r) for r in found.collect()] == [("g", "7", 1, 0)]
            assert found.inputFiles()  # read back, not derived again by every use
        assert seen == [value, value]
        assert spark.conf.get(key) == "65535"
    finally:
        spark.conf.set(key, before)


def test_blanks_of_archives_are_cut_at_both_ends(spark, monkeypatch):
    rows = spark.createDataFrame([(" \ta b \t", "\t 7,5 "), (" \t ", None)], "c string, n string")
    monkeypatch.setattr(verify, "read_archives", lambda *_: rows)
    monkeypatch.setattr(
        verify, "read_curated", lambda *_, **__: spark.createDataFrame([], "month string, c string, n decimal(24,6)")
    )
    spec = type("Spec", (), {"codes": ("c",), "numeric": ("n",)})
    source, _ = verify.source_and_curated(spark, "r", ["202503"], spec, "raw", "([0-9]{6})", "{month}")
    assert "regexp_replace" not in source._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in source.select("c", "n").collect()] == [("a b", Decimal("7.5")), (None, None)]


def test_amounts_bound_alike(spark):
    found = bindings.alike(list(CLAIMS.numeric))
    assert found["FLT_PAI_MNT"] == found["PRS_PAI_MNT"] and found["PRS_REM_MNT"] != found["PRS_PAI_MNT"]
    # a revision damages this one, so nothing else may be written from it
    assert [c for c, first in found.items() if first == "FLT_REM_MNT"] == ["FLT_REM_MNT"]


def test_archives_hold_every_amount_as_spelled(spark, tmp_path):
    folder, amounts = str(tmp_path), list(CLAIMS.numeric)
    put_tables(spark, folder, [(o, n, 1000.25 * o + n) for o in (1, 2, 3, 4, 1021) for n in (1, 4)] * 2)
    for damaged, table in ((False, bindings.claims), (True, bindings.revision)):
        rows = table(spark, folder, keep=["l_orderkey"])
        spelled = bindings.as_text(rows, amounts, F.col("l_orderkey") % 4)
        wanted = spelled.select(*[F.trim(c).alias(c) for c in amounts])  # Spark's writer leaves outer blanks out
        found = spark.read.options(**CSV_TEXT, sep=";").csv(queries._raw_files(spark, folder, damaged)).select(*amounts)
        assert found.count() == wanted.count() == 20
        assert found.exceptAll(wanted).isEmpty() and wanted.exceptAll(found).isEmpty()


def test_analyses_of_all_months_are_added_up(spark, tmp_path):
    folder = str(tmp_path)
    put_tables(spark, folder, [(o, n, 10 * o + n) for o in (1, 2, 3, 4) for n in (1, 2)])
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").localCheckpoint()
    month = F.make_date(F.col("l_orderkey").cast("int") + 1992, F.col("l_linenumber"), F.lit(5))
    lines.withColumn("l_shipdate", month).write.mode("overwrite").parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(3, "THREE"), (4, "FOUR")], "n_nationkey int, n_name string").write.parquet(
        f"{folder}/nation.parquet"
    )
    spark.catalog.clearCache()
    found = queries.QUERIES["analyses_incremental"](spark, folder).collect()
    months = {f"{year}{n:02d}" for year in range(2018, 2022) for n in (1, 2)}
    assert {(r["query"], r["mois_traitement"]) for r in found} == {(a, m) for a in ANALYSES for m in months}
    assert {r["libelle_prestation"] for r in found if r["query"] == "07_prestations_labels"} == {"FOUR"}
    assert {r["lignes_agregees"] for r in found if r["query"] == "01_monthly"} == {1}


def folders(root):
    return sorted(p.name.rsplit("-", 1)[0] for p in root.iterdir())


def test_stored_lines_are_the_claims_and_the_last_join_stays(spark, tmp_path, monkeypatch):
    folder, shared = str(tmp_path / "tables"), tmp_path / "shared"
    put_tables(spark, folder, [(o, n, o + n) for o in range(9) for n in (1, 2)])
    more = [(1, 4), (1, 5), (None, 6)]  # customer 1 comes twice more, and keys may be null
    spark.createDataFrame(more, "c_custkey long, c_nationkey int").write.mode("append").parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(None, 1, None), (3, None, None)], "o_orderkey long, o_custkey long, o_orderdate date").write.mode(
        "append"
    ).parquet(f"{folder}/orders.parquet")
    for module in (bindings, queries, fingerprints):
        monkeypatch.setattr(module, "scratch_dir", lambda _, label: f"{shared}/{label}-{uuid.uuid4().hex}")
    lines, stored = bindings.stored_lines(spark, folder)
    plain = bindings.claims(spark, folder, keep=["l_orderkey"])
    assert sorted(map(str, bindings.claims_of(lines, ["l_orderkey"]).collect())) == sorted(map(str, plain.collect()))
    assert plain.count() == 9 * 2 * 3 + 2
    assert folders(shared) == ["lines"] and stored.startswith(str(shared))
    queries._raw_files(spark, folder)
    assert folders(shared) == ["lines", "raw"]
    queries.QUERIES["row_fingerprints"](spark, folder).count()
    assert folders(shared) == ["differences", "lines", "raw"]


def test_archives_are_inflated_by_tasks_of_their_own(spark, tmp_path):
    names = [f"file:{put_text(tmp_path, ['a;b', f'{i};2'], name=f'A20250{i}.csv.gz')}" for i in range(1, 6)]
    listed = spark.createDataFrame([(n, "202503") for n in names], "path string, month string").coalesce(1)
    decoded = decode_archives(listed, str(tmp_path / "decoded"))
    assert len(decoded.inputFiles()) == 5
    assert sorted(r["text"] for r in decoded.where("text IS NOT NULL").collect()) == [f"{i};2\n" for i in range(1, 6)]


def test_months_are_published_in_waves_and_their_text_goes(spark, tmp_path, monkeypatch):
    months, waves = ["202503", "202504", "202505", "202506"], []
    for month in months:
        # The third month holds a row of another month, so it is blocked and the others are not.
        put_archive(tmp_path, [claim(FLX_ANN_MOI="202412" if month == "202505" else month)] * 2, month)
    plain = publish.decode_archives

    def seen(archives, path):
        waves.append(sorted(r["month"] for r in archives.collect()))
        return plain(archives, path)

    monkeypatch.setattr(publish, "decode_archives", seen)
    size = max(p.stat().st_size for p in tmp_path.glob("data/raw/*.csv.gz"))
    monkeypatch.setattr(publish, "WAVE_BYTES", 2 * size)
    with pytest.raises(publish.PublishBlocked, match="^202505: "):
        publish.publish_months(spark, str(tmp_path), months)
    assert waves == [months[:2], months[2:]]
    found = publish.read_manifests(spark, str(tmp_path)).select("month", "rows").collect()
    assert sorted(map(tuple, found)) == [(m, 2) for m in months if m != "202505"]
    assert not (tmp_path / "data/staging/decoded").exists()
    monkeypatch.setattr(publish, "WAVE_BYTES", 9)
    assert publish._waves({"b": 9, "a": 1, "c": 8, "d": 1, "e": 20}) == [["a"], ["b"], ["c", "d"], ["e"]]


@pytest.mark.parametrize("sent", [0, 10])
def test_few_rows_are_compared_where_all_buckets_differ(spark, tmp_path, monkeypatch, sent):
    monkeypatch.setattr(fingerprints, "SENT_HASHES", sent)
    rows = spark.range(400).select(
        F.when(F.col("id") % 7 > 0, "g").alias("g"), F.when(F.col("id") % 3 > 0, F.col("id") % 50).alias("n"),
        F.when(F.col("id") % 2 > 0, F.col("id").cast("decimal(24,6)")).alias("d"),
    )
    rows = rows.unionByName(rows.where("n > 40"))
    changed = rows.withColumn("g", F.when(F.col("n") == 44, F.lit("other")).otherwise(F.col("g")))
    changed = changed.where("n IS NULL OR n <> 45 OR d IS NOT NULL")
    wanted = {}
    for side, df in enumerate((rows, changed)):
        for r in map(tuple, df.collect()):
            wanted.setdefault(r, [0, 0])[side] += 1
    texts = [df.withColumn("f", F.lit(1.5)) for df in (rows, changed)]  # a floating number: hashed as texts
    for left, right, more in ((rows, changed, ()), (*texts, (1.5,))):
        found = fingerprints.row_differences_by_bucket(left, right, "g", 2)
        assert {tuple(r)[:-2]: list(tuple(r)[-2:]) for r in found.collect()} == {
            (*r, *more): n for r, n in wanted.items() if n[0] != n[1]
        }


def test_hashes_of_rows_tell_nulls_apart(spark):
    rows = [(None, "a"), ("a", None), ("a", "a"), (None, None), ("", None), (None, "")]
    left = spark.createDataFrame([("g", *r) for r in rows], "g string, a string, b string")
    assert fingerprints.hashable(left, left)
    marked = fingerprints._marked(left, "g", 4, plain=True).select("_h1", "_h2").collect()
    assert len({r["_h1"] for r in marked}) == len({r["_h2"] for r in marked}) == len(rows)
    assert not fingerprints.hashable(left, left.withColumn("b", F.lit(1)))


def test_texts_of_rows_are_told_apart(spark):
    rows = [
        (a, n, b, f)
        for a in (None, "", "-", "1:-", "é;", ";-") for n in (None, -1, 1, 11) for b in (None, "", "-;", "1;", "2:é")
        for f in (None, 0.0, -0.0, float("nan"))
    ]
    frame = spark.createDataFrame(rows, "a string, n long, b string, f double").withColumn(
        "d", F.col("n").cast("decimal(24,6)")
    )
    found = frame.select(quality.row_text(frame).alias("t"), quality.row_digest(frame).alias("h")).collect()
    assert len({r["t"] for r in found}) == len({bytes(r["h"]) for r in found}) == 6 * 4 * 5 * 3  # both zeros are one
    plan = frame.select(quality.row_text(frame))._jdf.queryExecution().analyzed().toString()
    assert "length(cast(a" in plan and "length(cast(n" not in plan and "length(cast(d" not in plan
