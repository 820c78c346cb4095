import random
import re
import statistics
from decimal import Decimal

import pytest
from conftest import claim, put_archive, put_text
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from claimworks.functions import fr_number, strip, valid_month
from claimworks.operators import aggregates, catalogue, dictionary, quality, reconcile, report_tables
from claimworks.operators.cleaning import DEFECTS, clean, clean_with_defects
from claimworks.operators.labels import with_labels
from claimworks.plans.dimensions import write_dimensions
from claimworks.schema import CLAIMS, RESERVED_BLANK_NAME, StructureError, TableSpec
from claimworks.session import local_session, scratch_dir, small_methods
from claimworks.sources.archives import read_archives, read_delimited, read_typed_csv
from claimworks.sources.files import file_facts
from claimworks.sources.labels import checked_labels, labels_from_json, read_labels

SMALL = TableSpec(month="m", codes=("m",), money=("a",), volumes=(), rates=(), never_null=("a",))


def texts(spark, values):
    return spark.createDataFrame([("202503", v) for v in values], "m string, a string")


# --- Functions ---------------------------------------------------------------------------------


def test_strip_is_python_strip(spark):
    values = ["", " ", "a", " a", "a ", "é", "\xa0é\xa0", "\ta\n", "!", "\x7f", "~x", "x　", " -1"]
    rows = spark.createDataFrame([(v,) for v in values], "s string").select("s", strip("s").alias("t"))
    assert all(r["t"] == r["s"].strip() for r in rows.collect())


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_amounts_are_exact_or_defects(spark, ansi):
    good = {" 10,20 ": "10.2", "\t10\xa0": "10", "10.": "10", ".5": "0.5", "+5": "5", "-.20": "-0.2",
            "0" * 30 + "7": "7", "9" * 18 + ".999999": "9" * 18 + ".999999"}
    bad = ["erreur", "0.1234567", "1e3", "1,2,3", "٣", "9" * 19, "1 0", "--1", ".", "+", "10\n.5", "\x0110"]
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = clean(texts(spark, [*good, "", "  ", None]), SMALL).collect()
        assert [r["a"] for r in rows] == [Decimal(v) for v in good.values()] + [None] * 3
        marked = clean_with_defects(texts(spark, [*bad, "1"]), SMALL).collect()
        assert [r[DEFECTS] for r in marked] == [["a"]] * len(bad) + [None]
        for value in bad:
            with pytest.raises(PySparkException, match="holds something it must not"):
                clean(texts(spark, [value]), SMALL).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_clean_contract(spark):
    with pytest.raises(StructureError, match="AGE_BEN_SNDS"):
        clean(texts(spark, []))
    blank = texts(spark, ["1"]).withColumn(RESERVED_BLANK_NAME, F.lit(None).cast("string"))
    assert clean(blank, SMALL).columns == ["m", "a"]
    with pytest.raises(PySparkException, match=RESERVED_BLANK_NAME):
        clean(blank.withColumn(RESERVED_BLANK_NAME, F.lit(" ")), SMALL).select("m").collect()


def test_months(spark):
    values = ["202503", "202500", "202513", "../202503", "20251", "201401", "201501", "202503\n", None]
    rows = spark.createDataFrame([(v,) for v in values], "m string").select(valid_month(F.col("m")))
    assert [v for v, r in zip(values, rows.collect()) if r[0]] == ["202503", "201501"]


def test_french_numbers(spark):
    cases = [("0.125", 2, "0,12"), ("0.375", 2, "0,38"), ("1234567.125", 2, "1 234 567,12"),
             ("-1234.5", 0, "-1 234"), ("2.5", 0, "2"), ("3.5", 0, "4"), ("0", 1, "0,0")]
    for value, decimals, shown in cases:
        frame = spark.createDataFrame([(Decimal(value),)], "v decimal(24,6)")
        assert frame.select(fr_number(F.col("v"), decimals)).first()[0] == shown


# --- Sources -----------------------------------------------------------------------------------


def test_archives_unite_by_name(spark, tmp_path):
    put_text(tmp_path, ["a;b;", "1;x;", '"q;""1""";;'])
    put_text(tmp_path, ["b;c", "y;2"], "202504")
    rows = read_archives(spark, str(tmp_path / "data/raw/*.csv.gz")).orderBy("b").collect()
    assert {(r["a"], r["b"], r["c"]) for r in rows} == {("1", "x", None), ('q;"1"', None, None), (None, "y", "2")}


@pytest.mark.parametrize("lines, reason", [
    ([], "empty file"), (["a;A", "1;2"], "duplicate column names"), ([";a;", ";1;"], "duplicate"),
])
def test_archives_with_bad_headers(spark, tmp_path, lines, reason):
    path = put_text(tmp_path, lines)
    with pytest.raises(StructureError, match=reason):
        read_archives(spark, str(path))


@pytest.mark.parametrize("row", ["1", "1;2;3"])
def test_ragged_rows_are_found_even_when_pruned(spark, tmp_path, row):
    path = str(put_text(tmp_path, ["a;b", "1;2", row]))
    with pytest.raises(Exception, match="MALFORMED"):
        read_delimited(spark, [path], ["a", "b"]).select("a").collect()


def test_byte_order_mark_is_part_of_the_name(spark, tmp_path):
    path = put_text(tmp_path, ["﻿FLX_ANN_MOI;b", "1;2"])
    with pytest.raises(StructureError, match="FLX_ANN_MOI"):
        clean(read_archives(spark, str(path)))


def test_typed_csv_is_strict(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("k,v\n01,1.5\n02,x\n")
    schema = "k string, v decimal(24,6)"
    assert read_typed_csv(spark, str(path), schema).limit(1).first()["k"] == "01"
    with pytest.raises(Exception, match="MALFORMED"):
        read_typed_csv(spark, str(path), schema).collect()


def test_file_facts(spark, tmp_path):
    import gzip
    import hashlib

    path = put_archive(tmp_path, [claim()])
    double = gzip.compress(b"a;b\n") + gzip.compress(b"1;2\n")
    path.with_name("A202504.csv.gz").write_bytes(double)
    path.with_name("A202505.csv.gz").write_bytes(path.read_bytes()[:-9])
    path.with_name("A202506.csv.gz").write_bytes(gzip.compress("a;b\né;2\n".encode("latin-1")))
    path.with_name("A202507.csv.gz").write_bytes(gzip.compress("a;b\n1;é".encode()[:-1]))
    facts = {r["path"][-13:-7]: r for r in file_facts(spark, str(path.parent), "*.csv.gz").collect()}
    whole = facts["202503"]
    assert whole["sha256"] == hashlib.sha256(path.read_bytes()).hexdigest()
    assert whole["bytes"] == path.stat().st_size and whole["magic"] == "1F8B"
    assert whole["text_bytes"] == len(gzip.decompress(path.read_bytes()))
    assert whole["header"] == [*CLAIMS.required, ""]
    assert (facts["202504"]["text_bytes"], facts["202504"]["header"]) == (8, ["a", "b"])
    assert facts["202505"]["problem"].startswith("unreadable archive")
    assert facts["202506"]["problem"] == facts["202507"]["problem"] == "text is not UTF-8"
    assert whole["problem"] is None
    head = file_facts(spark, str(path), depth="header").first()
    assert head["sha256"] is None and head["header"] == whole["header"]


def test_labels(spark, tmp_path):
    assert read_labels(spark, str(tmp_path / "none")).count() == 0
    documents = spark.createDataFrame([('{"V": {"01": "x", "02": "y"}, "W": {}}',)], "d string")
    unfolded = labels_from_json(documents, "d")
    assert {tuple(r) for r in unfolded.collect()} == {("V", "01", "x"), ("V", "02", "y")}
    with pytest.raises(PySparkException, match="repeated"):
        checked_labels(unfolded.union(unfolded)).collect()
    totals = spark.createDataFrame([("01", 1), ("03", 2), (None, 3)], "code string, n int")
    named = with_labels(totals, unfolded, "V", "code", "label").orderBy("n").collect()
    assert [r["label"] for r in named] == ["x"] + ["Libellé non disponible"] * 2


# --- Quality -----------------------------------------------------------------------------------


def test_empty_table_profile_has_zero_sums(spark, tmp_path):
    rows = clean(spark.createDataFrame([], ", ".join(f"{c} string" for c in CLAIMS.required)))
    values = quality.profile(rows, F.lit("202503")).first()
    assert values["rows"] == 0 and values["sum__FLT_REM_MNT"] == 0
    assert quality.gate(quality.profile(rows, F.lit("202503"))).first()["blocking_errors"] == ["no rows"]


def test_null_codes_count_where_they_must(spark):
    row = clean(spark.createDataFrame(
        [tuple(claim(PRS_REM_TYP="", SOI_MOI="00", FLX_ANN_MOI="").values())], list(claim())
    ))
    values = quality.profile(row, F.lit("202503")).first()
    assert values["unexpected_reimbursement_type_rows"] == 1
    assert values["unusual_care_month_rows"] == 1 and values["wrong_month"] == 1
    assert values["filtered_reimbursement_mismatch_rows"] == 0
    assert quality.gate(quality.profile(row, F.lit("202503"))).first()["blocking_errors"] == [
        "month missing or not that of the file", "unexpected reimbursement type",
    ]


@pytest.mark.parametrize("width", [2, 6])
def test_duplicates_against_counting(spark, width):
    rng = random.Random(width)
    choices = [None, "", "a", "1", "1:1", "-"]
    rows = [tuple(rng.choice(choices) for _ in range(width)) for _ in range(500)]
    rows += [rows[0]] * 500
    frame = spark.createDataFrame(rows, ", ".join(f"c{i} string" for i in range(width)))
    found = quality.duplicate_excess(frame).first()
    assert tuple(found) == (1000, 1000 - len(set(rows)))
    assert quality.distinct_rows(frame).count() == len(set(rows))
    by = {r["c0"]: r["exact_duplicate_excess"] for r in quality.duplicate_excess(frame, "c0").collect()}
    assert sum(by.values()) == 1000 - len(set(rows))


# --- Aggregates --------------------------------------------------------------------------------


def test_breakdowns_add_up_and_nulls_sort_last(spark):
    frame = spark.createDataFrame(
        [("a", Decimal(1)), (None, Decimal(2)), ("b", None)], "k string, v decimal(24,6)"
    )
    groups = aggregates.totals(frame, {"code": "k"}, {"sum": "v"}, "n", {"small": F.col("v") < 2})
    rows = aggregates.ordered(groups, "code").collect()
    assert [tuple(r) for r in rows] == [
        ("a", 1, Decimal(1), 1), ("b", 1, None, 0), (None, 1, Decimal(2), 0),
    ]
    assert [r["code"] for r in aggregates.ordered(groups, "-sum").collect()] == [None, "a", "b"]


@pytest.mark.parametrize("n", [1, 2, 999, 5000])
def test_exact_median(spark, n):
    rng = random.Random(n)
    values = [round(rng.lognormvariate(0, 2), 3) for _ in range(n)]
    frame = spark.createDataFrame([("hot", v) for v in values] + [("one", 4.0), ("one", None)],
                                  "mode string, seconds double")
    rows = {r["mode"]: r for r in aggregates.exact_median(frame, "mode", "seconds").collect()}
    assert rows["hot"]["median"] == statistics.median(values)
    assert (rows["hot"]["min"], rows["hot"]["max"]) == (min(values), max(values))
    assert rows["one"]["median"] == 4.0


def test_first_rows_keeps_partition_order(spark):
    frame = spark.createDataFrame([(m, i) for m in ("3", "1", "2") for i in range(5)], "m string, i int")
    rows = aggregates.first_rows(frame, 7, "m", F.col("i").desc()).collect()
    assert {(r["m"], r["i"]) for r in rows} == {("1", i) for i in range(5)} | {("2", 4), ("2", 3)}
    assert aggregates.first_rows(frame, 99, "m", F.col("i")).count() == 15
    with pytest.raises(ValueError):
        aggregates.first_rows(frame, 0, "m", F.col("i"))


# --- Dictionaries ------------------------------------------------------------------------------


def brute_labels(rows, names):
    """Section by section, as one would read a sheet by hand."""
    found = {}
    for sheet in {r[0] for r in rows}:
        current = None
        for _, _, code, label in sorted(r for r in rows if r[0] == sheet):
            if code is not None and code.strip() in names:
                current = found[(sheet, code.strip())] = {}
            elif current is not None and code is not None:
                current[code.strip()] = (label or "").strip()
    return {(s, v, c, text) for (s, v), codes in found.items() for c, text in codes.items()}


@pytest.mark.parametrize("block_rows", [1, 3, 50, 10_000])
def test_latest_labels_against_reading_by_hand(spark, block_rows):
    rng = random.Random(block_rows)
    rows = [
        ("big" if rng.random() < 0.7 else rng.choice("xyz"), i,
         rng.choice([None, "A", " B", "C\t", "1", "2 ", "3", "4"]), rng.choice([None, " l ", f"t{i}"]))
        for i in range(400)
    ]
    frame = spark.createDataFrame(rows, "sheet string, row_no long, c0 string, c1 string")
    names = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "name string")
    found = dictionary.latest_labels(frame, names, block_rows=block_rows)
    assert {tuple(r) for r in found.collect()} == brute_labels(rows, {"A", "B", "C", "D"})


def test_definitions(spark):
    rows = [("s", i, name, f"l{i}", "c", None) for i, name in
            enumerate(["t", "t", "t", "t", " A ", "", None, "B", "A"], start=1)]
    frame = spark.createDataFrame(rows, "sheet string, row_no long, c0 string, c1 string, c2 string, c3 string")
    labels = frame.select("sheet", (F.col("row_no") + 100).alias("row_no"), F.lit("A").alias("c0"), "c1")
    variables, codes = dictionary.build_dimensions(frame, labels)
    assert {(r["name"], r["label"]) for r in variables.collect()} == {("A", "l9"), ("B", "l8")}
    assert codes.count() == 0


def test_dimensions_become_the_labels_of_a_root(spark, tmp_path):
    columns = "sheet string, row_no long, c0 string, c1 string, c2 string, c3 string"
    definition = spark.createDataFrame([("s", 5, "V", "label", "cat", None)], columns)
    codes = spark.createDataFrame(
        [("m", 1, "V", None, None, None), ("m", 2, " 01 ", " one ", None, None)], columns
    )
    write_dimensions(definition, codes, str(tmp_path))
    labels = read_labels(spark, str(tmp_path / "references"))
    assert [tuple(r) for r in labels.collect()] == [("V", "01", "one")]
    variables = spark.read.parquet(str(tmp_path / "references/variables")).first()
    assert (variables["name"], variables["category"], variables["comment"]) == ("V", "cat", None)


# --- Reconciliation, catalogue, report ---------------------------------------------------------


def test_reconcile_nulls_and_one_sided_groups(spark):
    left = spark.createDataFrame([("a", 1, None), ("b", 2, 3)], "k string, x long, y long")
    right = spark.createDataFrame([("a", 1, None), ("c", 2, 3)], "k string, x long, y long")
    rows = {(r["k"], r["metric"]): r["equal"] for r in reconcile.reconcile(left, right, "k", ["x", "y"]).collect()}
    assert rows == {("a", "x"): True, ("a", "y"): True, **{(k, m): False for k in "bc" for m in "xy"}}


def test_row_differences_count_copies(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    right = spark.createDataFrame([(1, None), (3, "y"), (3, "y")], "a int, b string")
    assert tuple(reconcile.row_differences(left, right).first()) == (2, 2)
    assert tuple(reconcile.row_differences(left, left).first()) == (0, 0)


def test_catalogue_rules(spark):
    page = ('<a href="get?name=A202503.csv.gz&amp;key=k">x</a>'
            "<a href='A202504.csv.gz'>1</a><a href=\"/A202504.csv.gz\">2</a>"
            '<a href="https://mirror.example/A202505.csv.gz">y</a>')
    url = "https://open.example/care/months?of=2025"
    pages = spark.createDataFrame([(1, url, page)], "id int, url string, html string")
    wanted = spark.createDataFrame(
        [(1, f"A20250{m}.csv.gz") for m in range(3, 7)] + [(9, "A202503.csv.gz")], "id int, needle string"
    )
    rows = {(r["id"], r["needle"][6]): (r["verdict"], r["resolved"]) for r in
            catalogue.catalogue_match(pages, wanted, "id", "url", "html", "needle").collect()}
    assert rows == {
        (1, "3"): ("ok", "https://open.example/care/get?name=A202503.csv.gz&key=k"),
        (1, "4"): ("ambiguous", None),
        (1, "5"): ("foreign host", "https://mirror.example/A202505.csv.gz"),
        (1, "6"): ("absent", None), (9, "3"): ("absent", None),
    }
    assert catalogue.catalogue_links(pages, "id", "html").count() == 4


def test_top_totals(spark):
    labels = spark.createDataFrame([("R", "1", "one")], "variable string, code string, libelle string")
    rows = [("1", Decimal(8)), ("1", Decimal(2)), ("2", Decimal(5)), ("3", Decimal(5)), ("4", Decimal(-1))]
    groups = spark.createDataFrame(rows, "k string, v decimal(24,6)")
    top = report_tables.top_totals(groups, labels, "R", "k", "v", 4)
    assert {(r["code"], r["label"], r["share"]) for r in top.collect()} == {
        ("1", "one", 100.0), ("2", "Code 2", 50.0), ("3", "Code 3", 50.0), ("4", "Code 4", 0.0),
    }
    zero = report_tables.top_totals(groups.withColumn("v", F.col("v") * 0), labels, "R", "k", "v", 1)
    assert zero.first()["share"] == 0.0


# --- Findings of earlier rounds ----------------------------------------------------------------


def test_clean_is_strict_whatever_is_read(spark):
    bad = texts(spark, ["1", "n.c."])
    for read in (lambda d: d.count(), lambda d: d.select("m").collect(), lambda d: d.agg(F.count("m")).collect()):
        with pytest.raises(PySparkException, match="holds something it must not"):
            read(clean(bad, SMALL))
    assert clean(texts(spark, ["1", "2"]), SMALL).select("m").count() == 2


def test_null_groups_reconcile_with_themselves(spark):
    frame = spark.createDataFrame([(None, 1), ("a", 2)], "g string, v int")
    sums = reconcile.counts_and_sums(frame, "g", {"v": F.col("v").cast("decimal(24,6)")})
    found = reconcile.reconcile(sums, sums, "g", ["rows", "v"]).collect()
    assert len(found) == 4 and all(r["equal"] for r in found)


@pytest.mark.parametrize("width", [3, 6])
def test_duplicates_of_floats_do_not_depend_on_width(spark, width):
    rows = [(0.0, *["x"] * (width - 1)), (-0.0, *["x"] * (width - 1)), (float("nan"), *["y"] * (width - 1))] * 2
    frame = spark.createDataFrame(rows, ["f", *[f"c{i}" for i in range(1, width)]])
    found = quality.duplicate_excess(frame).first()
    assert (found["rows"], found["exact_duplicate_excess"]) == (6, 6 - frame.distinct().count())


def test_dimensions_of_several_sheets(spark, tmp_path):
    cells = "sheet string, row_no int, c0 string, c1 string, c2 string, c3 string"
    names = [("s1", 5, "V", "one", None, None), ("s2", 5, "V", "two", None, None)]
    codes = [(s, n, *c, None, None) for s in ("s1", "s2", None) for n, c in enumerate([("V", None), ("1", f"label {s}")])]
    write_dimensions(spark.createDataFrame(names, cells), spark.createDataFrame(codes, cells), str(tmp_path))
    labels = read_labels(spark, str(tmp_path / "references"))
    assert [tuple(r) for r in labels.collect()] == [("V", "1", "label s2")]
    assert checked_labels(labels).count() == 1


def test_top_totals_come_sorted(spark):
    groups = spark.createDataFrame([(str(i), Decimal(i * 7 % 11)) for i in range(40)], "k string, v decimal(24,6)")
    labels = spark.createDataFrame([("R", str(i), f"l{i}") for i in range(40)], "variable string, code string, libelle string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = report_tables.top_totals(groups, labels, "R", "k", "v").collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert [(-r["total"], r["code"]) for r in rows] == sorted((-r["total"], r["code"]) for r in rows)


def test_label_keys_of_other_variables_are_checked(spark):
    labels = spark.createDataFrame([("A", "1", "x"), ("B", "1", "y"), ("B", "1", "z")], "variable string, code string, libelle string")
    totals = spark.createDataFrame([("1", 1)], "k string, n int")
    with pytest.raises(PySparkException, match="null or repeated"):
        with_labels(totals, labels, "A", "k", "label").collect()


def test_median_and_fill_move_no_raw_rows_by_name(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sheet = spark.createDataFrame([("s", i, "V" if i % 9 == 0 else str(i), "t") for i in range(50)], "sheet string, row_no int, c0 string, c1 string")
        names = spark.createDataFrame([("V",)], "name string")
        plan = dictionary.sections(sheet, names, block_rows=10)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(c0" not in plan and "_name" not in "".join(re.findall(r"hashpartitioning\((.*?)\)", plan))


def test_analyses_keep_their_order(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["202503", "202504", None]), rng.choice(["1", "2", "3", None]), Decimal(rng.randrange(4))) for _ in range(300)]
    frame = spark.createDataFrame(rows, "m string, k string, v decimal(24,6)").repartition(7)
    summed = aggregates.totals(frame, {"m": "m", "k": "k"}, {"v": "v"})
    found = [tuple(r) for r in aggregates.ordered(summed, "m", "-v", "k").collect()]
    last = lambda x: (x is None, x or "")
    assert found == sorted(found, key=lambda r: (last(r[0]), -r[2], last(r[1])))


# --- Session -----------------------------------------------------------------------------------


def test_session_settings_are_restored(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(key, "5000")
    with small_methods(spark):
        assert spark.conf.get(key) == "8000"
    assert spark.conf.get(key) == "5000"
    local_session(8)
    assert scratch_dir(spark, "a") != scratch_dir(spark, "a")
