"""What Spark makes of the jobs: pruning, exchanges and file layout."""

import random
import re
from decimal import Decimal
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from conftest import claim, put_archive
from pyspark.sql import functions as F

from claimworks.operators import quality
from claimworks.plans.analyses import ANALYSES
from claimworks.plans.publish import ZSTD, publish_months
from claimworks.sources import decode
from claimworks.sources.curated import PARTITION, read_curated


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    """One month dealt into many lots."""
    folder = tmp_path_factory.mktemp("plans")
    rng = random.Random(1)
    rows = [
        claim(BEN_RES_REG=str(rng.randrange(14)), PRS_NAT=f"{rng.randrange(10**6):07d}",
              FLT_PAI_MNT=f"{rng.randrange(10**6)},{i % 100:02d}")
        for i in range(2000)
    ]
    put_archive(folder, rows)
    before = decode.BLOCK_TEXT, decode.LAYOUT
    settings = {"spark.sql.files.maxPartitionBytes": "20k", "spark.sql.files.openCostInBytes": "1k"}
    old = {key: spark.conf.get(key) for key in settings}
    decode.BLOCK_TEXT, decode.LAYOUT = 10_000, decode.LAYOUT | {"parquet.block.row.count.limit": "2"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        publish_months(spark, str(folder), ["202503"])
    finally:
        decode.BLOCK_TEXT, decode.LAYOUT = before
        for key, value in old.items():
            spark.conf.set(key, value)
    return folder, sum(Decimal(r["FLT_PAI_MNT"].replace(",", ".")) for r in rows)


def test_a_large_archive_becomes_several_parts_with_all_rows(spark, root):
    folder, expected = root
    staged = list(Path(folder, "data/curated").glob("run=*/month=202503/unreadable=none/*.parquet"))
    assert len(staged) > 2
    totals = read_curated(spark, str(folder)).agg(F.count("*"), F.sum("FLT_PAI_MNT")).first()
    assert (totals[0], totals[1]) == (2000, expected)


def test_analyses_read_only_their_columns_and_months(spark, root):
    claims = read_curated(spark, str(root[0]), ["202503"])
    plan = plan_of(ANALYSES["02_regions"].run(claims))
    read = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert {c.split(":")[0] for c in re.split(r",(?=[A-Z])", read)} == {
        "FLX_ANN_MOI", "BEN_RES_REG", "FLT_REM_MNT", "FLT_PAI_MNT",
    }
    assert all("/month=202503/" in path for path in claims.inputFiles())


def test_profile_and_audit_take_one_scan_and_small_exchanges(spark, root):
    claims = read_curated(spark, str(root[0]), keep_month=True)
    profile = plan_of(quality.profile(claims, F.col(PARTITION), by=PARTITION))
    assert profile.count("FileScan") == 1 and profile.count("Exchange") == 1
    audit = plan_of(quality.duplicate_excess(claims, PARTITION))
    assert audit.count("FileScan") == 1 and "Join" not in audit
    assert re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", audit)[-1].count("#") == 2


def test_parquet_layout(spark, tmp_path):
    wide = spark.range(150_000, numPartitions=1).select(F.col("id").cast("decimal(24,6)").alias("v"))
    wide.write.options(**ZSTD).parquet(str(tmp_path / "x"))
    meta = pq.ParquetFile(next((tmp_path / "x").glob("*.parquet"))).metadata
    assert [meta.row_group(i).num_rows for i in range(meta.num_row_groups)] == [131_072, 18_928]
    assert meta.row_group(0).column(0).compression == "ZSTD"
