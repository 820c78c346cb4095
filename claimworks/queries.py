"""Every operator as a query over the sample tables: ``name -> (spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimworks.functions import fr_number, month_key, total, valid_month
from claimworks.functions.links import host, resolve_link
from claimworks.operators import aggregates, catalogue, dictionary, fingerprints, quality, reconcile, report_tables
from claimworks.operators.cleaning import DEFECTS, clean, clean_with_defects
from claimworks.operators.fixity import check_archives
from claimworks.plans import formats
from claimworks.plans.analyses import (
    ANALYSES, analyse, analyses_at_once, exact_json, run_analyses, run_sql_dir, stored_partials, united,
    write_results,
)
from claimworks.plans.bindings import alike, as_text, claims, claims_of, labels, revision, revision_of, stored_lines, table
from claimworks.plans.dimensions import write_dimensions
from claimworks.plans.publish import PIPELINE_VERSION, PublishBlocked, plan_months, publish_months, stage
from claimworks.plans.report import report_tables as report_tables_of
from claimworks.plans.verify import region_totals_as_text, verify_regions, verify_rows, verify_source
from claimworks.schema import AMOUNT_TYPE, CLAIMS, MONEY, TOTAL_TYPE, StructureError, TableSpec, check_required
from claimworks.session import drop_dir, freed_shuffles, open_writers, scratch_dir, settings, small_methods
from claimworks.sources.archives import CSV_TEXT, header_problem
from claimworks.sources.curated import PARTITION, read_curated
from claimworks.sources.decode import archive_facts, decode_archives
from claimworks.sources.files import file_facts, list_files
from claimworks.sources.labels import LABEL_TABLE, labels_from_json, read_labels
from claimworks.sources.metadata import read_manifests, read_quality

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AMOUNT = "remboursement_part_legale_eur"
YEARS_LATER = 25
SQL_FOLDER = Path(__file__).parent / "plans" / "sql"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- Standing analyses -------------------------------------------------------------------------


def _analysis(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        analysis = ANALYSES[name]
        return analysis.run(claims(spark, folder, sorted(analysis.columns)), labels(spark, folder))

    return run


QUERIES |= {
    "monthly_totals": _analysis("01_monthly"),
    "region_totals": _analysis("02_regions"),
    "service_totals": _analysis("03_prestations"),
    "age_band_totals": _analysis("04_age"),
    "care_period_totals": _analysis("05_care_period"),
    "scope_totals": _analysis("06_scope"),
    "service_labels": _analysis("07_prestations_labels"),
}


@query
def analyses_one_scan(spark, folder):
    """The seven analyses from one scan of the claims, as one table."""
    columns = sorted({c for a in ANALYSES.values() for c in a.columns})
    return united(analyses_at_once(claims(spark, folder, columns), labels(spark, folder)))


@query
def results_in_order(spark, folder):
    """The place of every row in the seven results, as they come."""
    columns = sorted({c for a in ANALYSES.values() for c in a.columns})
    rows = claims(spark, folder, columns)
    found = []
    for name, analysis in ANALYSES.items():
        result = analysis.run(rows, labels(spark, folder))
        codes = [F.col(c) for c in analysis.by][1:]
        codes += [F.lit(None).cast("string")] * (2 - len(codes))
        numbered = result.select(
            F.lit(name).alias("query"), "mois_traitement", codes[0].alias("code"), codes[1].alias("code_2"),
            F.monotonically_increasing_id().alias("at"),
        )
        place = F.row_number().over(Window.partitionBy("query").orderBy("at")).cast("long")
        found.append(numbered.withColumn("place", place).drop("at"))
    return reduce(DataFrame.unionByName, found)


@query
def region_text_totals(spark, folder):
    return region_totals_as_text(claims(spark, folder, ["FLX_ANN_MOI", "BEN_RES_REG", "FLT_REM_MNT"]))


@query
def sql_directory(spark, folder):
    claims(spark, folder, ["BEN_RES_REG", "TOP_PS5_TRG", "FLT_REM_MNT"]).createOrReplaceTempView(
        "remboursements"
    )
    labels(spark, folder).createOrReplaceTempView("nomenclatures")
    return run_sql_dir(spark, str(SQL_FOLDER))["scope_by_region"]


@query
def union_by_name(spark, folder):
    """Early months come without the expense column."""
    rows = claims(spark, folder, ["FLX_ANN_MOI", "FLT_REM_MNT", "FLT_PAI_MNT"], keep=["l_shipdate"])
    early = rows.where(F.year("l_shipdate") < 1998).drop("FLT_PAI_MNT")
    late = rows.where(F.year("l_shipdate") >= 1998)
    return early.unionByName(late, allowMissingColumns=True).groupBy("FLX_ANN_MOI").agg(
        F.count(F.lit(1)).alias("rows"), total("FLT_REM_MNT").alias("reimbursed"),
        F.count("FLT_PAI_MNT").alias("expense_rows"), total("FLT_PAI_MNT").alias("expense"),
    )


@query
def distinct_months(spark, folder):
    rows = claims(spark, folder, ["FLX_ANN_MOI"], keep=["l_orderkey"])
    return aggregates.ordered(
        aggregates.distinct_in_order(rows, "FLX_ANN_MOI", "l_orderkey"), "first_seen", "FLX_ANN_MOI"
    )


@query
def first_rows(spark, folder):
    """The sample operator: the first 1 000 rows in month order."""
    columns = ["FLX_ANN_MOI", "PRS_NAT", "FLT_REM_MNT", "FLT_PAI_MNT"]
    rows = claims(spark, folder, columns)
    return aggregates.first_rows(rows, 1000, "FLX_ANN_MOI", F.struct(*columns))


# --- Quality -----------------------------------------------------------------------------------


def _profiles(spark, folder) -> DataFrame:
    rows = revision(spark, folder)
    return quality.profile(rows, "month", by="month", columns=list(CLAIMS.required))


@query
def quality_by_month(spark, folder):
    needed = [
        "FLX_ANN_MOI", "FLT_REM_MNT", "FLT_PAI_MNT", "BEN_RES_REG", "AGE_BEN_SNDS", "PRS_ACT_NBR",
        "PRS_REM_TYP", "SOI_MOI", "PRS_REM_MNT",
    ]
    return quality.profile(revision(spark, folder, needed), "month", by="month", columns=[], money=[])


@query
def null_profile(spark, folder):
    rows = revision(spark, folder)
    counts = rows.groupBy("month").agg(*quality.null_counts(CLAIMS.required))
    return quality.long_metrics(counts, ["month"], quality.NULLS, "column").withColumnRenamed(
        "value", "null_rows"
    )


@query
def money_checksums(spark, folder):
    rows = revision(spark, folder, ["FLX_ANN_MOI", *MONEY])
    sums = rows.groupBy("month").agg(*quality.checksums(MONEY))
    return quality.long_metrics(sums, ["month"], quality.SUM, "column").withColumnRenamed(
        "value", "total"
    )


@query
def gate_status(spark, folder):
    return quality.gate(_profiles(spark, folder)).select(
        "month", "rows", "status", F.array_join("blocking_errors", "; ").alias("blocking_errors")
    )


@query
def quality_rollup(spark, folder):
    return report_tables.quality_rollup(quality_by_month(spark, folder))


def _with_copies(spark, folder) -> DataFrame:
    """All columns of the claims, every 50th order a second time."""
    rows = claims(spark, folder, keep=["l_orderkey"])
    return rows.unionByName(rows.where("l_orderkey % 50 = 0")).drop("l_orderkey")


@query
def duplicate_excess(spark, folder):
    return quality.duplicate_excess(_with_copies(spark, folder))


@query
def duplicate_excess_by_month(spark, folder):
    return quality.duplicate_excess(_with_copies(spark, folder), by="FLX_ANN_MOI")


@query
def distinct_rows(spark, folder):
    return quality.distinct_rows(_with_copies(spark, folder))


@query
def row_fingerprints(spark, folder):
    """Rows that a copy of the claims has otherwise, although all its sums are the same."""
    lines, stored = stored_lines(spark, folder)
    rows = claims_of(lines, keep=["l_orderkey"])
    other = F.when(F.col("l_orderkey") % 500 == 3, F.lit("3")).otherwise(F.col("BEN_SEX_COD"))
    copy = rows.withColumn("BEN_SEX_COD", other).drop("l_orderkey")
    differences = fingerprints.row_differences_by_bucket(rows.drop("l_orderkey"), copy, "FLX_ANN_MOI")
    drop_dir(spark, stored)
    return differences


# --- Cleaning ----------------------------------------------------------------------------------


def _typed_text(spark, folder) -> DataFrame:
    rows = claims(
        spark, folder, ["PRS_REM_TYP", "FLT_REM_MNT", "FLT_PAI_MNT", "PRS_ACT_NBR"],
        keep=["l_orderkey", "l_linenumber"],
    )
    text = as_text(rows, ["FLT_REM_MNT", "FLT_PAI_MNT", "PRS_ACT_NBR"], F.col("l_orderkey") % 4)
    padded = F.concat(F.lit("\t "), "PRS_REM_TYP", F.lit(" "))
    return text.withColumn("PRS_REM_TYP", padded).withColumn(
        "PRS_ACT_NBR", F.coalesce("PRS_ACT_NBR", F.lit(" \t"))
    )


TYPED = TableSpec(
    month="PRS_REM_TYP", codes=("PRS_REM_TYP",), money=("FLT_REM_MNT", "FLT_PAI_MNT"),
    volumes=("PRS_ACT_NBR",), rates=(), never_null=(),
)


@query
def clean_decimals(spark, folder):
    text = _typed_text(spark, folder)
    keys = {c: F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber")}
    return clean(text.withColumns(keys), TYPED).withColumns(
        {c: F.col(c).cast("long") for c in keys}
    )


@query
def clean_defects(spark, folder):
    """Which unreadable amounts a lenient clean names, and how often."""
    key = F.col("l_orderkey")
    damaged = _typed_text(spark, folder).withColumns({
        "FLT_REM_MNT": F.when(key % 11 == 0, "1e3").when(key % 11 == 1, "0.1234567")
        .otherwise(F.col("FLT_REM_MNT")),
        "FLT_PAI_MNT": F.when(key % 13 == 0, "1,2,3").when(key % 13 == 1, "1234567890123456789")
        .otherwise(F.col("FLT_PAI_MNT")),
    })
    return (
        clean_with_defects(damaged.drop("l_linenumber"), TYPED)
        .groupBy(F.array_join(DEFECTS, ",").alias("defects"))
        .agg(F.count(F.lit(1)).alias("rows"), total("FLT_REM_MNT").alias("readable"))
    )


@query
def month_validation(spark, folder):
    """Month keys of events, spoilt in several ways."""
    good = month_key("ts")
    case = F.col("event_id") % 8
    text = F.col("event_id") % 20
    candidate = (
        F.when(case == 0, F.concat(F.substring(good, 1, 4), F.lpad(text.cast("string"), 2, "0")))
        .when(case == 1, F.concat(F.lit("../"), good))
        .when(case == 2, F.substring(good, 1, 5))
        .when(case == 3, F.concat((F.col("event_id") % 40 + 1995).cast("string"), F.lit("06")))
        .when(case == 4, F.concat(good, F.lit("\n")))
        .when(case == 5, F.lit(None).cast("string"))
        .otherwise(good)
    )
    return table(spark, folder, "events").select("event_id", candidate.alias("candidate")).withColumn(
        "valid", valid_month(F.col("candidate"))
    )


@query
def number_format(spark, folder):
    rows = claims(spark, folder, ["FLT_REM_MNT"], keep=["l_orderkey", "l_linenumber"])
    return rows.select(
        "l_orderkey", "l_linenumber", "FLT_REM_MNT", fr_number(F.col("FLT_REM_MNT"), 2).alias("cents"),
        fr_number(F.col("FLT_REM_MNT"), 0).alias("units"),
    )


# --- Labels and dictionaries -------------------------------------------------------------------


@query
def labels_from_documents(spark, folder):
    """Nested label documents, one per customer, unfolded to the label relation."""
    inner = F.create_map(F.col("c_custkey").cast("string"), F.col("c_name"))
    documents = table(spark, folder, "customer").select(
        F.to_json(F.create_map("c_mktsegment", inner)).alias("document")
    )
    return labels_from_json(documents, "document")


def _sheet(spark, folder) -> DataFrame:
    """Events as dictionary sheets, one per user: some types head a section, the rest are codes."""
    heads = F.col("event_type").isin("signup", "error")
    code = F.when(
        (F.col("event_type") != "view") | (F.col("value") >= 5), F.get_json_object("props", "$.k")
    )
    return table(spark, folder, "events").select(
        F.col("user_id").alias("sheet"), F.col("event_id").alias("row_no"),
        F.when(heads, F.concat(F.lit(" "), "event_type")).otherwise(code).alias("c0"),
        F.concat("event_type", F.lit("-"), F.col("event_id").cast("string"), F.lit(" ")).alias("c1"),
    )


def _section_names(spark, folder) -> DataFrame:
    names = table(spark, folder, "events").where(F.col("event_type").isin("signup", "error"))
    return names.select(F.col("event_type").alias("name")).distinct()


@query
def section_forward_fill(spark, folder):
    """Blocks are kept small here so that carrying over block edges is put to the test."""
    return dictionary.sections(
        _sheet(spark, folder), _section_names(spark, folder), block_rows=1000
    )


@query
def dictionary_latest(spark, folder):
    return dictionary.latest_labels(
        _sheet(spark, folder), _section_names(spark, folder), block_rows=1000
    )


@query
def dictionary_definitions(spark, folder):
    name = F.when(F.col("p_size") == 50, "").otherwise(F.concat(F.lit(" "), "p_type", F.lit("\t")))
    rows = table(spark, folder, "part").select(
        F.col("p_brand").alias("sheet"), F.col("p_partkey").alias("row_no"), name.alias("c0"),
        F.col("p_name").alias("c1"), F.col("p_brand").alias("c2"),
        F.when(F.col("p_size") % 2 == 0, F.col("p_type")).alias("c3"),
    )
    return dictionary.definitions(rows)


# --- Report tables -----------------------------------------------------------------------------


@query
def top_regions(spark, folder):
    regions = _analysis("02_regions")(spark, folder)
    return report_tables.top_totals(
        regions, labels(spark, folder), "BEN_RES_REG", "code_region_residence", AMOUNT
    )


@query
def kpi_totals(spark, folder):
    """Manifests derived from the claims: sizes are those of a small text rendering."""
    rows = claims(spark, folder, ["FLX_ANN_MOI", "PRS_REM_TYP", "FLT_REM_MNT"])
    line = F.concat_ws(";", "FLX_ANN_MOI", "PRS_REM_TYP", F.col("FLT_REM_MNT").cast("string"))
    manifests = rows.groupBy(F.col("FLX_ANN_MOI").alias("month")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.length(line) + 1).alias("csv_bytes"),
        (F.count(F.lit(1)) * 16).alias("parquet_bytes"), total("FLT_REM_MNT").alias(AMOUNT),
    )
    return report_tables.kpis(manifests, manifests, AMOUNT)


@query
def bench_summary(spark, folder):
    events = table(spark, folder, "events")
    return report_tables.bench_summary(events, "event_type", "value").withColumn(
        "median_seconds", F.round("median_seconds", 6)
    )


# --- Reconciliation ----------------------------------------------------------------------------


@query
def reconcile_sums(spark, folder):
    """Typed text added up on its own against the decimals; some months lost a few rows."""
    rows = claims(spark, folder, ["FLX_ANN_MOI", *MONEY], keep=["l_orderkey"])
    key = F.col("l_orderkey")
    raw = as_text(rows, list(MONEY), F.when(key % 4 == 3, 0).otherwise(key % 4))
    left = reconcile.counts_and_sums(raw, "FLX_ANN_MOI", {c: reconcile.raw_amount(c) for c in MONEY})
    right = reconcile.counts_and_sums(
        rows.where(key % 1009 != 0), "FLX_ANN_MOI", {c: F.col(c) for c in MONEY}
    )
    return reconcile.reconcile(left, right, "FLX_ANN_MOI", ["rows", *MONEY])


@query
def reconcile_tolerance(spark, folder):
    """Region totals against a stored copy with small and large errors, gaps and extra groups."""
    text = region_text_totals(spark, folder)
    keys = ["mois_traitement", "code_region_residence"]
    computed = text.withColumn(AMOUNT, F.col(AMOUNT).cast(TOTAL_TYPE))
    region = F.col("code_region_residence").cast("int")
    error = F.when(region % 5 == 1, 0.009).when(region % 5 == 2, 0.011).otherwise(0)
    stored = computed.withColumn(
        AMOUNT, F.when(region % 5 != 3, (F.col(AMOUNT) + error.cast(AMOUNT_TYPE)).cast(TOTAL_TYPE))
    ).where(region != 4)
    return reconcile.reconcile_tolerance(computed.where(region != 7), stored, keys, AMOUNT)


@query
def result_difference(spark, folder):
    rows = claims(spark, folder, ["FLX_ANN_MOI", "PRS_REM_TYP", "FLT_ACT_QTE"], keep=["l_orderkey"])
    left = rows.where(F.col("l_orderkey") % 10 != 0).drop("l_orderkey")
    right = rows.where(F.col("l_orderkey") % 10 != 1).drop("l_orderkey")
    return reconcile.row_differences(left, right)


@query
def format_equivalence(spark, folder):
    paths = formats.write_both(
        claims(spark, folder, formats.COLUMNS), scratch_dir(spark, "formats")
    )
    return formats.format_equivalence(spark, paths)


# --- Sinks and publication ---------------------------------------------------------------------


@query
def result_csv(spark, folder):
    """Age totals through the CSV sink and back as text; null codes come back as null."""
    out = scratch_dir(spark, "results")
    write_results({"ages": _analysis("04_age")(spark, folder)}, out)
    schema = f"mois_traitement string, code_tranche_age string, {AMOUNT} string, lignes_agregees string"
    return spark.read.schema(schema).option("header", "true").csv(f"{out}/ages")


@query
def result_json(spark, folder):
    return exact_json(_analysis("04_age")(spark, folder)).withColumnRenamed("value", "document")


ARCHIVE_ROWS = "16m"  # what travels of the rows of an archive


def _raw_files(spark, folder, damaged: bool = False) -> str:
    """The claims as monthly gzip archives with a trailing separator; returns their folder.

    The sample is older than the first supported year, so its months are moved.
    Rows are dealt out by month while they are narrow, by a rebalance, so Spark can split a month that
    holds most rows over several archives; they become text in the tasks that write.
    """
    out = scratch_dir(spark, "raw")
    lines, stored = stored_lines(spark, folder)
    if damaged:
        rows = revision_of(lines, keep=["l_orderkey"], deal="l_shipdate")
    else:
        rows = claims_of(lines, keep=["l_orderkey"], deal="l_shipdate").withColumn("month", F.col("FLX_ANN_MOI"))
    later = lambda c: (F.col(c).cast("int") + YEARS_LATER * 100).cast("string")
    # Amounts bound alike are written out once a row; the damage of a revision is in none of them.
    spelled = alike(list(CLAIMS.numeric))
    text = as_text(rows, sorted(set(spelled.values())), F.col("l_orderkey") % 4).withColumns(
        {c: F.col(first) for c, first in spelled.items() if c != first}
    ).drop("l_orderkey")
    tuned = settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes=ARCHIVE_ROWS)
    with small_methods(spark), open_writers(spark, 256), freed_shuffles(spark), tuned:
        (
            text.withColumns({"FLX_ANN_MOI": later("FLX_ANN_MOI"), PARTITION: later("month")})
            .select(*[c for c in text.columns if c != PARTITION], F.lit(None).cast("string").alias(""), PARTITION)
            .write.partitionBy(PARTITION)
            .options(sep=";", header="true", compression="gzip", emptyValue="", nullValue="")
            .option("zlib.compress.level", "BEST_SPEED")
            .csv(out)
        )
    drop_dir(spark, stored)
    return out


def _stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the scratch folder, so that later steps do not derive them again."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _declared(facts: DataFrame) -> DataFrame:
    """Sidecars that declare what the archives are."""
    return facts.select(
        F.regexp_extract("path", r"month=([0-9]{6})/", 1).alias("month"), "path",
        F.col("bytes").alias("declared_bytes"), F.col("sha256").alias("declared_sha256"),
    )


@query
def header_verdicts(spark, folder):
    """Archives of one line each, their headers damaged in several ways: what the contract says of each."""
    good = list(CLAIMS.required)
    heads = {
        0: [*good, ""], 1: [c for c in good if c != "AGE_BEN_SNDS"], 2: [*good, "extra", "EXTRA"],
        3: [*good, "month"], 4: [*good, "extra"], 5: [""],
    }
    kind = (F.col("n_nationkey") % 6).cast("int")
    head = F.create_map(*[x for k, names in heads.items() for x in (F.lit(k), F.lit(";".join(names)))])
    raw = scratch_dir(spark, "headers")
    table(spark, folder, "nation").select("n_nationkey", head[kind].alias("value")).repartition("n_nationkey").write.partitionBy(
        "n_nationkey"
    ).option("compression", "gzip").text(raw)
    facts = file_facts(spark, raw, "*.txt.gz", "header").select("path", "header", "problem").collect()

    def verdict(header, problem):
        if problem or header_problem(header):
            return problem or header_problem(header)
        try:
            check_required(header)
        except StructureError as error:
            return str(error)
        extra = [c for c in header if c and c not in good]
        return f"extra columns: {', '.join(extra)}" if extra else "sound"

    found = [(r["path"], verdict(r["header"], r["problem"])) for r in facts]
    return spark.createDataFrame(found, "path string, verdict string").select(
        F.regexp_extract("path", r"n_nationkey=([0-9]+)/", 1).cast("long").alias("n_nationkey"), "verdict"
    )


@query
def archive_fixity(spark, folder):
    """Verdicts on archives whose sidecars were altered for some months."""
    raw = _raw_files(spark, folder)
    facts = _stored(file_facts(spark, raw, "*.csv.gz"), "facts")
    number = F.col("month").cast("int") % 100
    sidecars = (
        _declared(facts)
        .withColumn("declared_sha256", F.when(number == 4, "0").otherwise(F.col("declared_sha256")))
        .withColumn("declared_bytes", F.col("declared_bytes") + F.when(number == 5, 1).otherwise(0))
        .where(number != 6)
        .withColumn("path", F.concat("path", F.when(number == 7, ".lost").otherwise("")))
    )
    return (
        check_archives(facts, sidecars.drop("month"))
        .select(F.regexp_extract("path", r"month=([0-9]{6})/", 1).alias("month"), "verdict")
        .distinct()
    )


def _decoded(spark, folder, damaged: bool = False) -> DataFrame:
    raw = _raw_files(spark, folder, damaged)
    archives = list_files(spark, raw, "*.csv.gz").select(
        "path", F.regexp_extract("path", MONTH_FOLDER, 1).alias(PARTITION)
    )
    return decode_archives(archives, scratch_dir(spark, "decoded"))


@query
def staged_decode(spark, folder):
    """What one pass over the archives stored: records per month, and whether the blocks are all of the text."""
    decoded = _decoded(spark, folder)
    size = F.octet_length("text")
    blocks = decoded.where("block IS NOT NULL").groupBy("path").agg(
        F.sum("lines").alias("lines"), F.min("first_byte").alias("first"), F.sum(size).alias("size"),
        (F.max("block") + 1 == F.count(F.lit(1))).alias("numbered"),
    )
    facts = archive_facts(decoded).join(blocks, "path", "left")
    whole = F.col("numbered") & (F.col("first") + F.col("size") == F.col("text_bytes")) & F.col("problem").isNull()
    return facts.groupBy("month").agg(F.sum("lines").alias("lines"), F.min(whole).alias("whole"))


@query
def gate_observed(spark, folder):
    """The gate on metrics that were observed while a bad revision was written."""
    header = [*CLAIMS.required, ""]
    decoded = _decoded(spark, folder, damaged=True)
    months = sorted(r["month"] for r in archive_facts(decoded).select("month").distinct().collect())
    profiles = stage(spark, decoded, {m: [(header, [])] for m in months}, scratch_dir(spark, "observed"))
    return quality.gate(profiles).select(
        "month", "rows", "status", F.array_join("blocking_errors", "; ").alias("blocking_errors")
    )


@query
def publish_plan(spark, folder):
    """Months to publish when some have new rows and some published files were altered."""
    rows = claims(spark, folder, ["FLX_ANN_MOI", "FLT_REM_MNT"], keep=["l_linestatus"])

    def state(df: DataFrame) -> DataFrame:
        text = F.concat_ws(
            "|", "FLX_ANN_MOI", F.count(F.lit(1)).cast("string"), total("FLT_REM_MNT").cast("string")
        )
        return df.groupBy("FLX_ANN_MOI").agg(F.sha2(text, 256).alias("source_sha256")).select(
            F.col("FLX_ANN_MOI").alias("month"), "source_sha256"
        )

    published = state(rows.where("l_linestatus = 'F'"))
    output = F.sha2(F.concat(F.lit("out"), "source_sha256"), 256)
    manifests = published.select(
        "month", "source_sha256", output.alias("parquet_sha256"),
        F.lit(PIPELINE_VERSION).alias("pipeline_version"),
    )
    found = published.select(
        "month", F.when(F.col("month").endswith("7"), "altered").otherwise(output).alias("parquet_sha256")
    )
    return plan_months(state(rows), manifests, found).select("month", "action")


MONTH_FOLDER = r"month=([0-9]{6})/"


def _published(spark, folder, kind: str = "sound") -> tuple[str, str]:
    """``(root, raw)`` of the claims after publication.

    The tables are read anew by every query, since they may have changed. The damaged kind has the claims
    of a bad revision, so some months are blocked.
    """
    raw = _raw_files(spark, folder, damaged=kind == "damaged")
    root = scratch_dir(spark, "publish")
    declared = _stored(_declared(file_facts(spark, raw, "*.csv.gz", "digest")), "declared")
    months = [row["month"] for row in declared.select("month").distinct().collect()]
    try:
        publish_months(
            spark, root, sorted(months), raw=raw, sidecars=declared, glob="*.csv.gz",
            month_in_path=MONTH_FOLDER,
        )
    except PublishBlocked:
        if kind == "sound":
            raise
    return root, raw


@query
def quality_reports(spark, folder):
    """Some metrics of the stored reports of all published months."""
    root, _ = _published(spark, folder)
    metric = lambda name: F.col("metrics")[name].alias(name)
    return read_quality(spark, root).select(
        "month", "status", F.size("blocking_errors").alias("errors"), metric("rows"),
        metric("negative_reimbursement_rows"), metric("missing_act_count_rows"), metric("sum__FLT_REM_MNT"),
    )


@query
def failed_reports(spark, folder):
    """The reports that a bad revision leaves for its blocked months."""
    root, _ = _published(spark, folder, "damaged")
    return read_quality(spark, root, "failed").select(
        "month", F.array_join("blocking_errors", "; ").alias("blocking_errors")
    )


@query
def stored_manifests(spark, folder):
    """Manifests beside their reports, for the months that a bad revision did not block."""
    root, _ = _published(spark, folder, "damaged")
    reports = read_quality(spark, root).select("month", F.col("metrics")["rows"].cast("long").alias("reported"))
    return read_manifests(spark, root).join(reports, "month", "left").select(
        "month", "rows", "reported", F.size("source_columns").alias("source_columns")
    )


@query
def source_verification(spark, folder):
    """Archive text added up again against the published months; what the job stored."""
    root, raw = _published(spark, folder)
    verify_source(
        spark, root, raw=raw, month_in_path=MONTH_FOLDER, archive_glob="month={month}/*.csv.gz"
    )
    stored = spark.read.json(f"{root}/reports/source_verification")
    return stored.select(
        "month", "metric", *[F.col(c).cast(TOTAL_TYPE).alias(c) for c in ("raw", "curated")], "equal"
    )


@query
def row_verification(spark, folder):
    """Archive rows against published rows, month by month."""
    root, raw = _published(spark, folder)
    return verify_rows(spark, root, raw=raw, month_in_path=MONTH_FOLDER, archive_glob="month={month}/*.csv.gz")


@query
def region_verification(spark, folder):
    """Region totals computed again from the published months; the totals that the job stored."""
    root, _ = _published(spark, folder)
    later = (F.col("mois_traitement").cast("int") + YEARS_LATER * 100).cast("string")
    verify_regions(spark, root, region_text_totals(spark, folder).withColumn("mois_traitement", later))
    schema = f"mois_traitement string, code_region_residence string, {AMOUNT} string"
    return spark.read.schema(schema).options(**CSV_TEXT).csv(f"{root}/reports/analyses/regions_recomputed")


@query
def analyses_written(spark, folder):
    """How many rows each stored analysis has, by its listing."""
    root, _ = _published(spark, folder)
    analyse(spark, root)
    stored = f"{root}/reports/analyses"
    rows = spark.read.option("basePath", f"{stored}/results").text(f"{stored}/results")
    counted = rows.groupBy(F.col("query").cast("string").alias("query")).agg(F.count(F.lit(1)).alias("rows"))
    return spark.read.json(f"{stored}/listing").select("query").join(counted, "query", "left")


@query
def analyses_incremental(spark, folder):
    """The seven analyses of all months, a third of them published later: only those are read the second time."""
    root, raw = scratch_dir(spark, "incremental"), _raw_files(spark, folder)
    declared = _stored(_declared(file_facts(spark, raw, "*.csv.gz", "digest")), "declared")
    months = sorted(r["month"] for r in declared.select("month").distinct().collect())
    labels(spark, folder).write.parquet(f"{root}/references/{LABEL_TABLE}")
    first = (2 * len(months) + 2) // 3
    computed = []
    for some in (months[:first], months):
        publish_months(
            spark, root, some, raw=raw, sidecars=declared, glob="*.csv.gz", month_in_path=MONTH_FOLDER,
        )
        states = stored_partials(root)
        states.states(spark)
        computed.append(states.computed)
    if computed != [months[:first], months[first:]]:
        raise AssertionError(f"months read: {computed}")
    return united(run_analyses(spark, root))


@query
def report_kpis(spark, folder):
    root, _ = _published(spark, folder)
    return report_tables_of(spark, root)["kpis"].select("rows", "months", "amount")


@query
def report_regions(spark, folder):
    root, _ = _published(spark, folder)
    return report_tables_of(spark, root)["top_regions"].select("code", "total", "label", "share")


@query
def report_quality(spark, folder):
    root, _ = _published(spark, folder)
    return report_tables_of(spark, root)["quality"]


@query
def format_report(spark, folder):
    """Both formats written, found equal and timed; what the stored summary says, but for the times."""
    out = scratch_dir(spark, "compared")
    rows = claims(spark, folder, [*formats.COLUMNS, "FLX_ANN_MOI"]).withColumnRenamed("FLX_ANN_MOI", PARTITION)
    formats.compare_formats(spark, rows, out, repeats=1)
    counted = formats.format_equivalence(spark, {f: f"{out}/sample_{f}" for f in ("csv", "parquet")})
    summary = formats.read_summary(spark, out).select(
        "mode", (F.col("min_seconds") > 0).alias("timed"),
        (F.col("median_seconds").between(F.col("min_seconds"), F.col("max_seconds"))).alias("ordered"),
    )
    totals = counted.agg(F.sum("csv_n").cast("long").alias("rows"), F.min("equal").alias("equal")).first()
    return summary.withColumns({c: F.lit(totals[c]) for c in ("rows", "equal")})


@query
def dimension_build(spark, folder):
    """Labels stored from sheets that share codes: the last sheet wins."""
    root = scratch_dir(spark, "dimensions")
    names = _section_names(spark, folder).select(
        F.lit(0).alias("sheet"), (F.lit(5) + F.monotonically_increasing_id()).alias("row_no"),
        F.col("name").alias("c0"), *[F.lit(None).cast("string").alias(c) for c in ("c1", "c2", "c3")],
    )
    write_dimensions(names, _sheet(spark, folder), root)
    return read_labels(spark, f"{root}/references")


@query
def publish_roundtrip(spark, folder):
    """Archives in, published partitions out: one row per month."""
    root, _ = _published(spark, folder)
    return read_curated(spark, root).groupBy("FLX_ANN_MOI").agg(
        F.count(F.lit(1)).alias("rows"), F.count("PRS_ACT_NBR").alias("act_rows"),
        *[total(c).alias(c) for c in MONEY],
    )


# --- Catalogue ---------------------------------------------------------------------------------


@query
def href_links(spark, folder):
    return catalogue.catalogue_links(table(spark, folder, "pages"), "page_id", "html")


@query
def resolved_links(spark, folder):
    pages = table(spark, folder, "pages").withColumn("links", catalogue.hrefs("html"))
    links = pages.select("page_id", "url", F.posexplode("links").alias("position", "link"))
    resolved = links.withColumn("resolved", resolve_link(F.col("url"), F.col("link")))
    return resolved.select("page_id", "position", "resolved", host(F.col("resolved")).alias("host"))


@query
def catalogue_match(spark, folder):
    """Does each page link to the section its own address names, exactly once?"""
    pages = table(spark, folder, "pages")
    needle = F.regexp_extract("url", r"^https?://[^/]+(/[^/?#]+)", 1)
    wanted = pages.select("page_id", needle.alias("needle"))
    return catalogue.catalogue_match(pages, wanted, "page_id", "url", "html", "needle")
