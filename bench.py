"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the sample, ``BENCH_CPUS`` the cores. The claims are first written as raw
monthly archives and published; the analyses then run on the published table, as they would in use.
The other queries read a copy of the sample in as many parts as there are cores, because the sample
has one row group per table, which a single task reads. Neither preparation counts. Each query is run once to warm up, then three times; the median counts.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import time

from pyspark.sql import functions as F

from claimworks import queries
from claimworks.operators import quality
from claimworks.operators.aggregates import count_and_sum
from claimworks.plans import formats
from claimworks.plans.analyses import ANALYSES
from claimworks.plans.bindings import labels
from claimworks.plans.publish import publish_months, stage
from claimworks.schema import CLAIMS
from claimworks.session import local_session, scratch_dir
from claimworks.sources.curated import PARTITION, read_curated
from claimworks.sources.decode import decode_archives
from claimworks.sources.files import file_facts

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
SAMPLE_ROWS = 1_000_000  # as in the published comparison; once more at four times the rows
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))


def sized(frame, have, wanted):
    """About so many rows of four columns: each row several times, less a share drawn at random."""
    copies = -(-wanted // have)
    repeated = frame.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("_copy")
    return repeated.where(F.rand(7) < wanted / (have * copies))


def drain(frame):
    frame.write.format("noop").mode("overwrite").save()


def timed(build):
    """Median seconds of planning and running a query."""
    seconds = []
    for repeat in range(REPEATS + 1):
        started = time.perf_counter()
        drain(build())
        if repeat:
            seconds.append(time.perf_counter() - started)
    return round(statistics.median(seconds), 4)


def in_parts(spark):
    """The sample tables again, each in several files."""
    copy = scratch_dir(spark, "bench-tables")
    for path in sorted(glob.glob(f"{FOLDER}/*.parquet")):
        spark.read.parquet(path).repartition(int(CPUS)).write.parquet(
            f"{copy}/{os.path.basename(path)}"
        )
    return copy


def main():
    spark = local_session(CPUS)
    raw, root = queries._raw_files(spark, FOLDER), scratch_dir(spark, "bench")
    declared = queries._declared(file_facts(spark, raw, "*.csv.gz", "digest"))
    months = sorted(r["month"] for r in declared.select("month").distinct().collect())

    started = time.perf_counter()
    publish_months(
        spark, root, months, raw=raw, sidecars=declared, glob="*.csv.gz",
        month_in_path=r"month=([0-9]{6})/",
    )
    publish_seconds = time.perf_counter() - started

    # Conversion alone, warm: the stored text of the archives parsed, cleaned and written as Parquet.
    # Inflating, digests and gate do not count, as in the published figure.
    decoded = decode_archives(declared.select("path", "month"), scratch_dir(spark, "bench-decoded"))
    layouts = {m: [([*CLAIMS.required, ""], [])] for m in months}
    started = time.perf_counter()
    stage(spark, decoded, layouts, scratch_dir(spark, "bench-stage"))
    convert_seconds = time.perf_counter() - started

    by_month = read_curated(spark, root, keep_month=True)
    claims, names = by_month.drop(PARTITION), labels(spark, FOLDER)
    results = {
        name: timed(lambda a=analysis: a.run(claims, names)) for name, analysis in ANALYSES.items()
    }
    rows = claims.count()
    sizes = {}
    for name, wanted in (("", SAMPLE_ROWS), ("_4x", 4 * SAMPLE_ROWS)):
        sample = sized(claims.select(*formats.COLUMNS), rows, wanted)
        paths = formats.write_both(sample, scratch_dir(spark, "bench-formats"))
        both = formats.read_both(spark, paths)
        sizes[f"region_count_sum{name}"] = both["parquet"].count()
        for mode in ("csv", "parquet"):
            results[f"region_count_sum_{mode}{name}"] = timed(
                lambda m=mode, b=both: count_and_sum(b[m], formats.KEY, formats.VALUE)
            )
    results["quality_profile"] = timed(
        lambda: quality.profile(by_month, F.col(PARTITION), by=PARTITION)
    )
    results["duplicate_excess"] = timed(lambda: quality.duplicate_excess(by_month, PARTITION))
    sample = in_parts(spark)
    for name in ("top_regions", "clean_decimals", "reconcile_sums", "dictionary_latest",
                 "bench_summary", "catalogue_match"):
        results[name] = timed(lambda n=name: queries.QUERIES[n](spark, sample))
    print(json.dumps({
        "metric": "seconds for all headline queries, median of repeats, added up",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
        "rows": rows,
        "sample_rows": sizes,
        "cpus": CPUS,
        "publish_seconds": round(publish_seconds, 2),
        "publish_rows_per_second": round(rows / publish_seconds),
        "convert_seconds": round(convert_seconds, 2),
        "convert_rows_per_second": round(rows / convert_seconds),
    }))


if __name__ == "__main__":
    main()
