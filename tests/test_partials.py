"""States of the analyses per month, and fingerprints of rows."""

import random
import statistics

import pytest
from conftest import claim, put_archive
from pyspark.sql import functions as F

from claimworks.operators import fingerprints
from claimworks.operators.aggregates import exact_median
from claimworks.plans import partials
from claimworks.plans.analyses import (
    ANALYSES, KEY_LISTS, STATE_COUNTS, STATE_SUMS, analyses_at_once, run_analyses, stored_partials,
)
from claimworks.plans.publish import publish_months
from claimworks.sources.curated import read_curated

LABELS = "variable string, code string, libelle string"


def claims_with_nulls(spark):
    rows = [
        ("202503" if i % 4 else "202504", str(i % 3) if i % 5 else None, str(i % 7), None if i % 6 == 0 else str(i % 2),
         "2025", str(i % 4) if i % 9 else None, "1", i - 50 if i % 8 else None, i, 1, 2)
        for i in range(200)
    ]
    names = ["FLX_ANN_MOI", "BEN_RES_REG", "PRS_NAT", "AGE_BEN_SNDS", "SOI_ANN", "SOI_MOI", "TOP_PS5_TRG"]
    sums = ["FLT_REM_MNT", "FLT_PAI_MNT", "FLT_DEP_MNT", "FLT_ACT_QTE"]
    schema = ", ".join([*(f"{c} string" for c in names), *(f"{c} int" for c in sums)])
    frame = spark.createDataFrame(rows, schema)
    return frame.withColumns({c: F.col(c).cast("decimal(24,6)") for c in sums})


def test_all_analyses_from_one_scan(spark, tmp_path):
    claims_with_nulls(spark).write.parquet(str(tmp_path / "c"))
    claims, labels = spark.read.parquet(str(tmp_path / "c")), spark.createDataFrame([("PRS_NAT", "1", "One")], LABELS)
    plan = partials.grouped_once(claims, KEY_LISTS, STATE_SUMS, STATE_COUNTS)._jdf.queryExecution().executedPlan()
    assert plan.toString().count("FileScan") == 1 and plan.toString().count("Exchange") == 1
    for name, result in analyses_at_once(claims, labels).items():
        want = ANALYSES[name].run(claims, labels)
        assert result.columns == want.columns and result.collect() == want.collect(), name
        assert str(tmp_path) not in "".join(result.inputFiles())


def test_one_changed_month_is_read_again(spark, tmp_path):
    months = ["202503", "202504", "202505"]
    for month in months:
        put_archive(tmp_path, [claim(FLX_ANN_MOI=month)], month)
    publish_months(spark, str(tmp_path), months)
    with pytest.raises(ValueError, match="no published month"):
        read_curated(spark, str(tmp_path / "elsewhere"))
    states = stored_partials(str(tmp_path))
    states.states(spark)
    assert states.computed == months
    states.states(spark)
    assert states.computed == []
    put_archive(tmp_path, [claim(FLX_ANN_MOI="202504"), claim(FLX_ANN_MOI="202504", BEN_RES_REG="1")], "202504")
    publish_months(spark, str(tmp_path), months)
    states.states(spark)
    assert states.computed == ["202504"]
    assert len(list((tmp_path / "data/partials").glob("*/run=*/month=*"))) == 3
    results = run_analyses(spark, str(tmp_path))
    claims = read_curated(spark, str(tmp_path))
    labels = spark.createDataFrame([], LABELS)
    for name, result in results.items():
        assert result.collect() == ANALYSES[name].run(claims, labels).collect(), name
    some = run_analyses(spark, str(tmp_path), ["202504"])["01_monthly"].collect()
    assert [(r["mois_traitement"], r["lignes_agregees"]) for r in some] == [("202504", 2)]


def test_other_key_lists_do_not_meet_stored_states(tmp_path):
    one = partials.Partials(str(tmp_path), [("a",)], ["x"], {})
    assert one.path != partials.Partials(str(tmp_path), [("a", "b")], ["x"], {}).path
    assert one.path != partials.Partials(str(tmp_path), [("a",)], ["x"], {"n": "x < 0"}).path


ROWS = [("a", "1", 5, None), ("a", "1", 5, None), ("a", "2", 6, "x"), ("b", "1", 5, ""), (None, "1", 5, "y")]
SCHEMA = "g string, k string, n int, t string"


def changes(left, right, buckets):
    found = fingerprints.row_differences_by_bucket(left, right, "g", buckets)
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("buckets", [1, 8, 1024])
def test_fingerprints_find_what_sums_do_not(spark, buckets):
    left = spark.createDataFrame(ROWS, SCHEMA)
    assert changes(left, left.orderBy(F.desc("n")).repartition(3), buckets) == []
    swapped = [("a", "1", 6, None), ("a", "1", 5, None), ("a", "2", 5, "x"), ("b", "1", 5, ""), (None, "1", 5, "y")]
    assert changes(left, spark.createDataFrame(swapped, SCHEMA), buckets) == [
        ("a", "1", 5, None, 2, 1), ("a", "1", 6, None, 0, 1), ("a", "2", 5, "x", 0, 1), ("a", "2", 6, "x", 1, 0),
    ]
    assert changes(left, spark.createDataFrame(ROWS[1:], SCHEMA), buckets) == [("a", "1", 5, None, 2, 1)]
    empty_for_null = [*ROWS[:3], ("b", "1", 5, None), ROWS[4]]
    assert len(changes(left, spark.createDataFrame(empty_for_null, SCHEMA), buckets)) == 2
    assert len(changes(left, left.limit(0), buckets)) == 4


def test_equality_by_group(spark):
    left = spark.createDataFrame(ROWS, SCHEMA)
    right = spark.createDataFrame([*ROWS[:3], ("b", "1", 4, ""), (None, "1", 5, "y"), ("c", "", 0, "")], SCHEMA)
    found = {r["g"]: (r["left_rows"], r["right_rows"], r["equal"]) for r in fingerprints.group_equality(left, right, "g").collect()}
    assert found == {"a": (3, 3, True), "b": (1, 1, False), None: (1, 1, True), "c": (0, 1, False)}


@pytest.mark.parametrize("bins, few", [(4, 3), (1024, 10), (2, 1)])
def test_median_by_narrowing(spark, bins, few):
    rng = random.Random(bins)
    groups = {
        "normal": [rng.gauss(0, 5) for _ in range(301)], "even": [rng.gauss(0, 1e9) for _ in range(300)],
        "ties": [1.0] * 100 + [2.0] * 100, "one": [3.5], "two": [1.0, 4.0], "same": [7.0] * 50,
        "far": [1e300, -1e300, 0.0, 1.0, 2.0], "infinite": [float("inf"), 1.0, 2.0, 3.0], None: [5.0, None, 6.0, 9.0],
    }
    rows = [(g, v) for g, values in groups.items() for v in values]
    frame = spark.createDataFrame(rows, "g string, v double").repartition(4)
    found = {r["g"]: (r["median"], r["min"], r["max"]) for r in exact_median(frame, "g", "v", bins, few).collect()}
    for g, values in groups.items():
        values = [v for v in values if v is not None]
        assert found[g] == pytest.approx((statistics.median(values), min(values), max(values))), g
    assert exact_median(frame.limit(0), "g", "v").collect() == []
