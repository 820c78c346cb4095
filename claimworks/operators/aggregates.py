"""Totals by any set of codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimworks.functions import total
from claimworks.session import scratch_dir


def totals(
    df: DataFrame,
    by: dict[str, str],
    sums: dict[str, str] | None = None,
    rows: str | None = None,
    counts: dict[str, Column] | None = None,
) -> DataFrame:
    """One grouped pass: exact sums, row count and conditional counts.

    ``by`` and ``sums`` map output names to columns. Null codes form a group of their own. Sums and
    counts combine on the map side, so a code holding most rows costs one partial row per task.
    """
    measures = []
    if rows:
        measures.append(F.count(F.lit(1)).alias(rows))
    measures += [total(column).alias(name) for name, column in (sums or {}).items()]
    measures += [F.count_if(test).alias(name) for name, test in (counts or {}).items()]
    return df.groupBy(*[F.col(c).alias(name) for name, c in by.items()]).agg(*measures)


def ordered(df: DataFrame, *keys: str) -> DataFrame:
    """Sort with nulls last both ways; a leading ``-`` sorts that key downwards."""
    return df.orderBy(
        *[
            F.col(k[1:]).desc_nulls_last() if k.startswith("-") else F.col(k).asc_nulls_last()
            for k in keys
        ]
    )


def count_and_sum(df: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, n, total)`` with the total as six-decimal text: equal text means equal results."""
    return (
        df.groupBy(F.col(key).cast("string").alias("key"))
        .agg(F.count(F.lit(1)).alias("n"), total(value).alias("total"))
        .select("key", "n", F.col("total").cast("string").alias("total"))
    )


def distinct_in_order(df: DataFrame, key: str, position: str) -> DataFrame:
    """Distinct keys with the position at which each was first seen."""
    return df.groupBy(key).agg(F.min(position).alias("first_seen"))


def first_rows(df: DataFrame, n: int, partition: str, order: Column) -> DataFrame:
    """The first ``n`` rows in partition order, or all when there are fewer.

    ``order`` makes the choice within a partition repeatable. Only the partition in which the sample
    ends is sorted, over all tasks, and cut by the counts of its parts, so no task holds ``n`` rows.
    The driver holds one count per partition value and one per part.
    """
    if n < 1:
        raise ValueError("the sample needs at least one row")
    sizes = df.groupBy(partition).count().orderBy(F.col(partition).asc_nulls_last()).collect()
    whole, last, rest = [], [], n
    for size in sizes:
        if size["count"] > rest:
            last = [size[partition]] if rest else []
            break
        whole.append(size[partition])
        rest -= size["count"]
    kept = df.where(_one_of(partition, whole))
    if not last:
        return kept
    parts = _in_parts(df.where(_one_of(partition, last)), order)
    counts = parts.groupBy("_part").count().orderBy("_part").collect()
    for part in counts:
        if part["count"] > rest:
            break
        rest -= part["count"]
    chosen = (F.col("_part") < part["_part"]) | ((F.col("_part") == part["_part"]) & (F.col("_at") <= rest))
    return kept.unionByName(parts.where(chosen).drop("_part", "_at"))


def _one_of(column: str, values: list) -> Column:
    test = F.col(column).isin([v for v in values if v is not None])
    return test | F.col(column).isNull() if None in values else test


def _in_parts(df: DataFrame, *order: Column) -> DataFrame:
    """The rows sorted over all tasks, with the number of their part and their place in it.

    Written to the scratch folder, because the borders of the parts are drawn anew by every run.
    """
    spark = df.sparkSession
    keyed = df.withColumn("_id", F.monotonically_increasing_id())
    dealt = keyed.repartitionByRange(*order, "_id").withColumn("_part", F.spark_partition_id())
    at = F.row_number().over(Window.partitionBy("_part").orderBy(*order, "_id"))
    path = scratch_dir(spark, "parts")
    dealt.withColumn("_at", at).drop("_id").write.parquet(path)
    return spark.read.parquet(path)


BINS = 1024  # parts that an interval of values is cut into
FEW = 100_000  # rows of a group that are ranked by value


def exact_median(df: DataFrame, by: str, value: str, bins: int = BINS, few: int = FEW) -> DataFrame:
    """``(by, median, min, max)`` of numbers, the median exact, by narrowing down where it lies.

    Per group an interval of values is known that holds the median, and how many rows lie below it. A
    round cuts the intervals into bins, counts them on the map side and keeps the bin with the median.
    When an interval holds few rows, or one value, the rest is ranked. So no row is sorted or shuffled
    before that, and a round exchanges one row per task and bin. The driver sees one number a round.

    Nulls are left out; a null group is a group. Infinite values cannot be cut into bins, so groups that
    have them are ranked by their distinct values at once.
    """
    rows = df.where(F.col(value).isNotNull()).select(F.col(by).alias("_by"), F.col(value).alias("v"))
    spans = rows.groupBy("_by").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("min"), F.max("v").alias("max")
    ).select("*", F.col("min").alias("low"), F.col("max").alias("high"), F.lit(0).cast("long").alias("below"),
             F.col("n").alias("inside"))
    spans = _stored(spans)
    wide = (F.col("low") < F.col("high")) & ~_unbounded("low") & ~_unbounded("high")
    left = None
    while True:
        most = spans.where(wide).agg(F.max("inside")).first()[0]
        if most is None or most <= few or most == left:
            break
        spans, left = _stored(_narrowed(rows, spans, bins)), most
    counted = _within(rows, spans.select("_by", "low", "high")).groupBy("_by", "v").agg(F.count(F.lit(1)).alias("c"))
    upto = F.sum("c").over(Window.partitionBy("_by").orderBy("v"))
    ranked = counted.withColumn("upto", upto).groupBy("_by").agg(F.array_sort(F.collect_list(F.struct("v", "upto"))).alias("r"))
    joined = spans.select(F.col("_by").alias("_g"), "n", "min", "max", "below").join(
        ranked, F.col("_g").eqNullSafe(F.col("_by"))
    )
    at = lambda rank: F.array_min(F.transform(
        F.filter("r", lambda x: x["upto"] + F.col("below") >= rank), lambda x: x["v"]
    ))
    low_rank, high_rank = F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1
    return joined.select(F.col("_g").alias(by), ((at(low_rank) + at(high_rank)) / 2).alias("median"), "min", "max")


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_dir(df.sparkSession, "spans")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _unbounded(column: str) -> Column:
    number = F.col(column).cast("double")
    return F.isnan(number) | (F.abs(number) == float("inf"))


def _within(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """The rows whose value lies in their group's interval, with its ends."""
    named = spans.withColumnRenamed("_by", "_g")
    return rows.join(named, rows["_by"].eqNullSafe(F.col("_g")) & F.col("v").between(F.col("low"), F.col("high")))


def _narrowed(rows: DataFrame, spans: DataFrame, bins: int) -> DataFrame:
    """The intervals cut down to the bins with the two middle rows."""
    number_of = lambda c: F.col(c).cast("double")
    share = F.try_divide(number_of("v") - number_of("low"), number_of("high") - number_of("low"))
    share = F.when(F.isnan(share), 0.0).otherwise(share)
    number = F.coalesce(F.least(F.floor(share * bins), F.lit(bins - 1)), F.lit(0)).cast("int")
    counted = _within(rows, spans.select("_by", "low", "high")).groupBy("_by", number.alias("bin")).agg(
        F.count(F.lit(1)).alias("c"), F.min("v").alias("from"), F.max("v").alias("to")
    )
    order = Window.partitionBy("_by").orderBy("bin")
    counted = counted.withColumn("upto", F.sum("c").over(order)).withColumnRenamed("_by", "_g")
    known = spans.select("_by", "n", "min", "max", "below")
    low_rank, high_rank = F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1
    last = F.col("below") + F.col("upto")
    wanted = (last >= low_rank) & (last - F.col("c") < high_rank)
    return known.join(counted, F.col("_by").eqNullSafe(F.col("_g"))).where(wanted).groupBy(
        "_by", "n", "min", "max", "below"
    ).agg(
        F.min("from").alias("low"), F.max("to").alias("high"), F.min(F.col("upto") - F.col("c")).alias("more"),
        F.sum("c").alias("inside"),
    ).select("_by", "n", "min", "max", "low", "high", (F.col("below") + F.col("more")).alias("below"), "inside")
