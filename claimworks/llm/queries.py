"""The numbered queries: each operator on its whole table, with the columns that are compared."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks.llm import collocations, conversations, decontamination, licenses, mixing, packing, quality, secret_scan, simhash, substring, suffixes, urls, warc
from claimworks.llm.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_suffix_dedup(spark, folder):
    found = suffixes.drop_repeated_bytes(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def _dated_entries(pages: DataFrame) -> DataFrame:
    """A dated list drawn from the pages' own hosts, domains and first path steps.

    Which patterns are listed, and when, follows from digests of their text, so that SQL can make the
    same list: added, taken off, and for some added again.
    """
    keys = pages.select(F.explode(urls.url_keys("url")).alias("pattern")).distinct()
    number = F.conv(F.substring(F.md5("pattern"), 1, 6), 16, 10).cast("long")
    keys = keys.withColumn("n", number).where("n % 3 = 0")
    day = F.col("n") % 400
    return keys.select("pattern", F.inline(F.array(
        F.struct(day.alias("day"), F.lit(True).alias("listed")),
        F.struct((day + 30 + F.col("n") % 200).alias("day"), F.lit(False).alias("listed")),
        F.struct(F.when(F.col("n") % 5 == 0, day + 300).alias("day"), F.lit(True).alias("listed")),
    )))


@query
def op2_url_filter(spark, folder):
    """Pages have no fetch time; the day follows from the page_id."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    captures = pages.withColumn("day", ((F.col("page_id") * 37) % 730).cast("int"))
    return urls.filter_captures(captures, _dated_entries(pages)).select(
        "page_id", "day", "n_entries", "pattern", "blocked"
    )


@query
def op3_simhash_dedup(spark, folder):
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op4_substring_dedup(spark, folder):
    found = substring.drop_repeated_windows(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op5_benchmark_decontamination(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontamination.find_contamination(docs, table(spark, folder, "benchmark"))
    items, spans = F.col("contamination.items"), F.col("contamination.spans")
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id", "contamination.n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


@query
def op6_source_mix(spark, folder):
    found = mixing.mix(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


@query
def op7_license_scan(spark, folder):
    found = licenses.scan(table(spark, folder, "documents"))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )


@query
def op8_quality_rules(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return quality.judge(docs, group_bytes=14 << 20).select(  # larger groups send fewer pairs to disk
        "doc_id", *[f"quality.{c}" for c in counts], "base_failed", "kept", "quality.log_perplexity"
    )


@query
def op9_warc_packages(spark, folder):
    return warc.archive_round_trip(table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query
def op10_secret_scan(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = secret_scan.find_secrets(docs)
    kinds = F.array(*[F.lit(k) for k in secret_scan.KINDS])
    named = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"] - 1), s["start"].cast("string"), s["end"].cast("string"))
    ), ",")
    number = lambda rank: F.size(F.filter("secrets", lambda s: s["rank"] == rank)).cast("long")
    return found.select(
        "doc_id", number(1).alias("n_assign"), number(2).alias("n_access"), number(3).alias("n_hex"),
        F.sha2(named(F.filter("secrets", lambda s: s["rank"] <= 3)), 256).alias("base_sha256"),
        named(F.col("secrets")).alias("spans"),
    )


@query
def op11_collocations(spark, folder):
    return collocations.mine(table(spark, folder, "documents"))


@query
def op12_packing(spark, folder):
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(table(spark, folder, "documents"), vocabulary).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op13_conversation_repair(spark, folder):
    rows = table(spark, folder, "conversations")
    found = conversations.conversations(conversations.damage(rows)).withColumnRenamed("conv_id", "id")
    zeros = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return rows.select("conv_id").distinct().join(found, F.col("conv_id").eqNullSafe(F.col("id")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in zeros],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.sha2(F.coalesce(F.array_join("repaired", "\n"), F.lit("")), 256).alias("repaired_sha256"),
    )
