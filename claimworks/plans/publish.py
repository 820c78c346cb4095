"""Gated, idempotent publication of month partitions."""

from __future__ import annotations

import json
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimworks.functions import quoted, utc_now, valid_month
from claimworks.operators.cleaning import DEFECTS, clean_with_defects
from claimworks.operators.fixity import ACCEPTED, check_archives, fingerprints, plain_path
from claimworks.operators.quality import POLICY, duplicate_excess, gate, observed_write, profile_metrics
from claimworks.schema import CLAIMS, StructureError, TableSpec, check_required
from claimworks.session import drop_dir, freed_shuffles, open_writers, small_methods
from claimworks.sources.archives import MONTH_IN_PATH, header_problem
from claimworks.sources.curated import (
    PARTITION, SOUND, UNREADABLE, curated_path, current_runs, record_schema, remove_old_runs,
)
from claimworks.sources.decode import archive_facts, decode_archives, parse_blocks
from claimworks.sources.files import exists, file_facts, list_files
from claimworks.sources.metadata import (
    manifests_path, quality_path, read_manifests, read_quality, read_sidecars,
)

PIPELINE_VERSION = "2"
ZSTD = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "3",
    "parquet.block.row.count.limit": "131072",
}
STAGED_FILES = 4  # open files of a task that stages rows: sound ones and some kinds of damage
WAVE_BYTES = 1 << 30  # archives whose text and row digests lie on disk at one time
MONTHS_AT_ONCE = 16  # jobs that write a month each, side by side, or two for every core if that is more


class PublishBlocked(ValueError):
    """Some months were not published; their previous partitions are untouched."""

    def __init__(self, reasons: dict[str, list[str]]):
        self.reasons = reasons
        super().__init__("; ".join(f"{m}: {', '.join(r)}" for m, r in sorted(reasons.items())))


def plan_months(
    sources: DataFrame, manifests: DataFrame, outputs: DataFrame, reports: DataFrame | None = None
) -> DataFrame:
    """``(sources columns…, action)``: ``keep`` months whose source, version and output match.

    ``sources`` is ``(month, source_sha256, …)``, ``outputs`` ``(month, parquet_sha256)`` as found
    on disk now. With ``reports`` (month) a month is kept only if its report is there too. Anything
    else is ``publish``.
    """
    kept = (
        manifests.where(F.col("pipeline_version") == PIPELINE_VERSION)
        .select("month", "source_sha256", "parquet_sha256")
        .join(outputs, ["month", "parquet_sha256"])
        .select("month", "source_sha256", F.lit("keep").alias("_kept"))
    )
    if reports is not None:
        kept = kept.join(reports.select("month").distinct(), "month", "left_semi")
    return (
        sources.join(kept, ["month", "source_sha256"], "left")
        .withColumn("action", F.coalesce("_kept", F.lit("publish")))
        .drop("_kept")
    )


def output_fingerprints(spark: SparkSession, root: str, runs: dict[str, str]) -> DataFrame:
    """``(month, parquet_sha256, parquet_bytes)`` of the files of months in their runs, as found now."""
    at = rf"/run=([^/]+)/{PARTITION}=([0-9]+)/{UNREADABLE}={SOUND}/[^/]+\z"
    wanted = spark.createDataFrame(list(runs.items()), f"{PARTITION} string, run string")

    def named(files: DataFrame) -> DataFrame:
        return files.withColumns({
            "run": F.regexp_extract("path", at, 1), PARTITION: F.regexp_extract("path", at, 2),
        })

    if not exists(spark, curated_path(root)):
        return spark.createDataFrame([], "month string, parquet_sha256 string, parquet_bytes long")
    facts = file_facts(
        spark, curated_path(root), "*.parquet", "digest",
        keep=lambda files: named(files).join(wanted, ["run", PARTITION], "left_semi"),
    )
    return fingerprints(named(facts), PARTITION).select(
        PARTITION, F.col("fingerprint").alias("parquet_sha256"), F.col("bytes").alias("parquet_bytes")
    )


def stage(
    spark: SparkSession,
    decoded: DataFrame,
    layouts: dict[str, list[tuple[list[str], list[str]]]],
    path: str,
    spec: TableSpec = CLAIMS,
) -> DataFrame:
    """Clean the decoded archives, write a candidate table by month and soundness, and profile it.

    ``layouts`` lists for each month ``(header, archives)``. The months are written side by side, each as
    a job of its own, which parses the month's blocks wherever they are read and shuffles nothing. Its
    profile is observed on the rows as they are written, so nothing reads the candidate again; the
    profiles, one row per month, are returned. Rows with defects go to a folder that names them, so the
    sound files can be published as they are.
    """
    archives: dict[str, tuple[list[str], list[str]]] = {}
    for layout in layouts.values():
        for header, names in layout:
            archives.setdefault(json.dumps(header), (header, []))[1].extend(names)
    frames = []
    for header, names in archives.values():
        some = decoded if len(archives) == 1 else decoded.where(F.col("path").isin(names))
        frames.append(clean_with_defects(parse_blocks(some, header), spec))
    cleaned = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    columns = [c for c in cleaned.columns if c not in (DEFECTS, PARTITION)]
    metrics = profile_metrics(F.col(PARTITION), columns, True, spec)
    soundness = F.coalesce(F.array_join(DEFECTS, ","), F.lit(SOUND)).alias(UNREADABLE)
    written = [*map(quoted, columns), soundness]

    def one(month: str) -> tuple:
        started = time.monotonic()
        found = observed_write(
            cleaned.where(F.col(PARTITION) == month), metrics,
            lambda rows: rows.select(*written).write.mode("overwrite").options(**ZSTD).partitionBy(UNREADABLE).parquet(
                f"{path}/{PARTITION}={month}"
            ),
        )
        return (month, round(time.monotonic() - started, 3), *found.values())

    with ThreadPoolExecutor(max(MONTHS_AT_ONCE, 2 * spark.sparkContext.defaultParallelism)) as pool:
        rows = list(pool.map(inheritable_thread_target(spark)(one), layouts))
    schema = T.StructType().add(PARTITION, "string").add("seconds", "double")
    for f in cleaned.agg(*metrics).schema:
        schema = schema.add(f.name, f.dataType)
    return spark.createDataFrame(rows, schema)


def candidate_table(spark: SparkSession, path: str, columns: list[str], spec: TableSpec = CLAIMS) -> DataFrame:
    """The rows that ``stage`` wrote, with their month and the names of their damaged columns."""
    schema = T.StructType([
        T.StructField(c, T.DecimalType(24, 6) if c in spec.numeric else T.StringType()) for c in columns
    ])
    for name in (PARTITION, UNREADABLE):
        schema = schema.add(name, T.StringType())
    return spark.read.schema(schema).parquet(path)


def publish_months(
    spark: SparkSession,
    root: str,
    months: list[str],
    raw: str | None = None,
    sidecars: DataFrame | None = None,
    glob: str | None = None,
    spec: TableSpec = CLAIMS,
    month_in_path: str = MONTH_IN_PATH,
    audit_duplicates: bool = True,
) -> DataFrame:
    """Publish the months whose archives are sound and whose rows pass the gate.

    Returns the manifests of the months. Unchanged months are kept as they are. Months that fail
    keep their previous partition and leave a failed report; the others are published all the
    same, then :class:`PublishBlocked` names the failures. Months run in waves bounded by the bytes of
    their archives, so the decoded text of one wave is all that is staged; the driver holds only lists
    of months, headers and paths.
    """
    root = root.rstrip("/")
    raw = raw or f"{root}/data/raw"
    months = list(dict.fromkeys(months))
    requested = spark.createDataFrame([(m,) for m in months], f"{PARTITION} string")
    wrong = requested.where(~valid_month(F.col(PARTITION))).collect()
    if wrong:
        raise ValueError(f"not a supported month: {', '.join(r[0] for r in wrong)}")

    remove_old_runs(spark, root)
    # Digests are dear, so the verdicts are written once and read back.
    glob = glob or f"A{{{','.join(months)}}}.csv.gz"
    declared = read_sidecars(spark, raw) if sidecars is None else sidecars
    staging = f"{root}/data/staging"
    checks = _checked(
        spark, f"{staging}/archives", requested, file_facts(spark, raw, glob, "digest"),
        declared.where(F.col(PARTITION).isin(months)), month_in_path,
    )
    blocked = _reasons(checks.where(F.col("verdict") != ACCEPTED), "verdict")

    accepted = checks.where(~F.col(PARTITION).isin(list(blocked)))
    sources = fingerprints(accepted, PARTITION).select(
        PARTITION, F.col("fingerprint").alias("source_sha256"), F.col("bytes").alias("gzip_bytes")
    )
    record_schema(spark, root, spec.numeric)
    plan = plan_months(
        sources, read_manifests(spark, root),
        output_fingerprints(spark, root, current_runs(spark, root, months)).select(
            PARTITION, "parquet_sha256"
        ),
        read_quality(spark, root),
    ).collect()
    todo = {row[PARTITION]: row["gzip_bytes"] or 0 for row in plan if row["action"] == "publish"}
    for some in _waves(todo):
        # Only archives that will be published are decoded, those of one wave at a time.
        named = requested.where(F.col(PARTITION).isin(some))
        wanted = accepted.where(F.col(PARTITION).isin(some)).select(F.col("path").alias("_path"), PARTITION)
        listed = list_files(spark, raw, glob)
        decoded = decode_archives(
            listed.join(wanted, plain_path("path") == wanted["_path"]).select("path", PARTITION),
            f"{staging}/decoded",
        )
        details = _checked(
            spark, f"{staging}/details", named, archive_facts(decoded).drop(PARTITION),
            declared.where(F.col(PARTITION).isin(some)), month_in_path,
        )
        broken = _reasons(details.where(F.col("verdict") != ACCEPTED), "verdict")
        blocked |= broken
        sound = details.where(~F.col(PARTITION).isin(list(broken)))
        for layouts in _by_layout(sound, decoded) if set(some) - set(broken) else ():
            problem = _layout_problem(layouts, spec)
            if problem:
                blocked |= {m: [problem] for m in layouts}
                continue
            with small_methods(spark), open_writers(spark, STAGED_FILES), freed_shuffles(spark):
                blocked |= _publish_group(
                    spark, root, decoded, layouts, sound, sources, spec, audit_duplicates
                )
        drop_dir(spark, f"{staging}/decoded")
    if blocked:
        raise PublishBlocked(blocked)
    return read_manifests(spark, root).where(F.col(PARTITION).isin(months))


def _waves(months: dict[str, int]) -> list[list[str]]:
    """Months in order, in groups whose archives hold ``WAVE_BYTES`` at most, or one larger month."""
    waves, held = [], 0
    for month, size in sorted(months.items()):
        if not waves or held + size > WAVE_BYTES:
            waves.append([])
            held = 0
        waves[-1].append(month)
        held += size
    return waves


def _checked(
    spark: SparkSession, path: str, requested: DataFrame, facts: DataFrame, declared: DataFrame,
    month_in_path: str,
) -> DataFrame:
    """Archives of the requested months with their verdicts, written once and read back."""
    check_archives(
        facts.withColumn("_month", F.regexp_extract("path", month_in_path, 1)), declared
    ).withColumn(PARTITION, F.coalesce("_month", PARTITION)).drop("_month").write.mode(
        "overwrite"
    ).parquet(path)
    return requested.join(spark.read.parquet(path), PARTITION, "left").withColumn(
        "verdict", F.coalesce("verdict", F.lit("archive and sidecar missing"))
    )


def _reasons(df: DataFrame, column: str) -> dict[str, list[str]]:
    rows = df.groupBy(PARTITION).agg(F.sort_array(F.collect_set(column)).alias("r")).collect()
    return {row[PARTITION]: row["r"] for row in rows}


def _by_layout(checks: DataFrame, decoded: DataFrame) -> list[dict[str, list]]:
    """Groups of months whose archives have the same set of headers, ``{month: [(header, paths), …]}``.

    Months of a group share one schema, so no month gains columns from another. Paths are spelled as in
    the decoded rows.
    """
    spelled = archive_facts(decoded).select(F.col("path").alias("name"), plain_path("path").alias("path"))
    rows = checks.join(spelled, "path").groupBy(PARTITION, "header").agg(
        F.sort_array(F.collect_list("name")).alias("names")
    ).collect()
    months: dict[str, list] = {}
    for row in sorted(rows, key=lambda r: (r[PARTITION], str(r["header"]))):
        months.setdefault(row[PARTITION], []).append((row["header"], row["names"]))
    groups: dict[str, dict] = {}
    for month, layout in months.items():
        groups.setdefault(json.dumps([header for header, _ in layout]), {})[month] = layout
    return list(groups.values())


def _layout_problem(layouts: dict[str, list], spec: TableSpec) -> str | None:
    for header, _ in next(iter(layouts.values())):
        problem = header_problem(header)
        if problem:
            return problem
        try:
            check_required(header, spec)
        except StructureError as error:
            return str(error)
    return None


def _publish_group(
    spark: SparkSession, root: str, decoded: DataFrame, layouts: dict[str, list], checks: DataFrame,
    sources: DataFrame, spec: TableSpec, audit_duplicates: bool,
) -> dict[str, list[str]]:
    """Stage, gate and publish months of one layout; returns the blocked ones."""
    staging, run = f"{root}/data/staging", uuid.uuid4().hex
    months, path = list(layouts), f"{curated_path(root)}/run={run}"
    columns = list(dict.fromkeys(c for header, _ in layouts[months[0]] for c in header if c))
    profiles = stage(spark, decoded, layouts, path, spec)
    seconds = profiles.select(PARTITION, "seconds")
    profiles = profiles.drop("seconds")
    if audit_duplicates:
        audit = duplicate_excess(candidate_table(spark, path, columns, spec).drop(UNREADABLE), by=PARTITION)
        profiles = profiles.join(audit.drop("rows"), PARTITION, "left")
    judged = gate(profiles, spec)
    judged.write.mode("overwrite").parquet(f"{staging}/quality")
    judged = spark.read.parquet(f"{staging}/quality")

    blocked = _reasons(
        judged.where("status = 'failed'").select(
            PARTITION, F.explode("blocking_errors").alias("error")
        ),
        "error",
    )
    reports = quality_reports(judged)
    passed = [m for m in months if m not in blocked]
    if blocked:
        _write_monthly(reports.where("status = 'failed'"), quality_path(root, "failed"))
    if passed:
        # The files lie in their run already; a month is published when its manifest names the run.
        _write_monthly(reports.where("status = 'passed'"), quality_path(root))
        record_schema(spark, root, spec.numeric, columns)
        sizes = checks.groupBy(PARTITION).agg(F.sum("text_bytes").alias("csv_bytes"))
        manifests = (
            judged.where("status = 'passed'").select(PARTITION, "rows")
            .join(sources, PARTITION)
            .join(sizes, PARTITION)
            .join(seconds, PARTITION)
            .join(output_fingerprints(spark, root, dict.fromkeys(passed, run)), PARTITION)
            .select(
                F.lit(PIPELINE_VERSION).alias("pipeline_version"), "source_sha256", "parquet_sha256",
                F.array(*[F.lit(c) for c in columns]).alias("source_columns"),
                "rows", "csv_bytes", "gzip_bytes", "parquet_bytes",
                F.col("seconds").alias("transform_seconds"), utc_now().alias("completed_at"),
                F.lit(run).alias("run"), PARTITION,
            )
        )
        _write_monthly(manifests, manifests_path(root))
    return blocked


def quality_reports(judged: DataFrame) -> DataFrame:
    """One report row per month; metrics as exact text by name."""
    meta = (PARTITION, "status", "blocking_errors", "defect_columns")
    metrics = [c for c in judged.columns if c not in meta]
    pairs = [x for c in metrics for x in (F.lit(c), quoted(c).cast("string"))]
    return judged.select(
        utc_now().alias("checked_at"), "status", "blocking_errors",
        F.create_map(*pairs).alias("metrics"), F.lit(POLICY).alias("policy"), PARTITION,
    )


def _overwrite_partitions(df: DataFrame):
    """A writer that replaces the months present in the data and no others."""
    return df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION)


def _write_monthly(df: DataFrame, path: str) -> None:
    """One small JSON file per month."""
    _overwrite_partitions(df.repartition(PARTITION)).json(path)
