"""Are two tables the same rows, copies included? Sums cannot tell; fingerprints of rows can.

A row's fingerprint is 128 bits of its content. Those of a bucket of rows are added up, so a bucket's
sum does not depend on order or on how the rows lie in files, and combines on the map side: the exchange
carries one row per task and bucket. Only in buckets that differ hashes are counted, and only the rows of
hashes that differ are compared themselves.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.functions import quoted
from claimworks.operators.quality import row_text
from claimworks.session import drop_dir, freed_shuffles, scratch_dir, small_methods

BUCKETS = 1024
SENT_HASHES = 2_000_000  # 64-bit hashes of differing rows that are sent to all tasks, some 100 MB
# Types of one spelling a value, so that equal hashes mean equal texts; floating numbers are none.
HASHABLE = ("string", "bigint", "int", "smallint", "tinyint", "boolean", "date")
_BUCKET = "_bucket"


def hashable(left: DataFrame, right: DataFrame) -> bool:
    """Whether the columns of both sides can be hashed as they are; else rows are hashed as texts."""
    kinds = dict(right.dtypes)
    return len(left.columns) <= 62 and all(
        kinds[c] == kind and (kind in HASHABLE or kind.startswith("decimal")) for c, kind in left.dtypes
    )


def _marked(df: DataFrame, by: str, buckets: int, plain: bool = False) -> DataFrame:
    """The rows with two hashes of their content; the bucket is part of the first.

    A hash leaves out nulls, so ``plain`` values go with a number that says which of them are null.

    The row number keeps the optimiser from moving tests of the bucket below the hashes: it would rewrite
    the text of the whole row once for every choice of columns and their expressions.
    """
    if plain:
        nulls = reduce(add, [F.when(quoted(c).isNull(), 1 << i).otherwise(0).cast("long") for i, c in enumerate(df.columns)])
        content = [nulls, *map(quoted, df.columns)]
    else:
        content = [row_text(df)]
    marked = df.withColumns({
        "_h1": F.xxhash64(*content), "_h2": F.xxhash64(F.lit("second"), *content),
        "_row": F.monotonically_increasing_id(),
    })
    return marked.where("_row >= 0").withColumn(_BUCKET, F.pmod("_h1", F.lit(buckets)).cast("int"))


def bucket_fingerprints(df: DataFrame, by: str, buckets: int = BUCKETS, plain: bool = False) -> DataFrame:
    """``(by, _bucket, rows, low, high)``: how many rows a bucket holds and the sums of their hashes.

    The halves of a hash are added up as longs, which is exact for 2**31 rows of a bucket and does not
    make a decimal of every row.
    """
    sums = [
        F.sum(half).alias(f"{name}{i}") for name in ("_h1", "_h2")
        for i, half in enumerate((F.shiftright(name, 32), F.col(name).bitwiseAND(0xFFFFFFFF)))
    ]
    wide = lambda c: F.col(f"{c}0").cast("decimal(20,0)") * F.lit(1 << 32) + F.col(f"{c}1").cast("decimal(20,0)")
    return _marked(df, by, buckets, plain).groupBy(by, _BUCKET).agg(F.count(F.lit(1)).alias("rows"), *sums).select(
        by, _BUCKET, "rows", *[wide(c).cast("decimal(30,0)").alias(name) for c, name in (("_h1", "low"), ("_h2", "high"))]
    )


def differing_buckets(left: DataFrame, right: DataFrame, by: str, buckets: int = BUCKETS) -> DataFrame:
    """``(by, _bucket, left_rows, right_rows)`` of the buckets that do not agree; null groups meet."""
    plain = hashable(left, right)
    a = bucket_fingerprints(left, by, buckets, plain).select(
        F.col(by).alias("_l"), F.col(_BUCKET).alias("_lb"), F.struct("rows", "low", "high").alias("a")
    )
    b = bucket_fingerprints(right.select(*map(quoted, left.columns)), by, buckets, plain).select(
        F.col(by).alias("_r"), F.col(_BUCKET).alias("_rb"), F.struct("rows", "low", "high").alias("b")
    )
    both = a.join(b, F.col("_l").eqNullSafe(F.col("_r")) & (F.col("_lb") == F.col("_rb")), "full_outer")
    return both.where(~F.col("a").eqNullSafe(F.col("b"))).select(
        F.coalesce("_l", "_r").alias(by), F.coalesce("_lb", "_rb").alias(_BUCKET),
        F.coalesce("a.rows", F.lit(0)).alias("left_rows"), F.coalesce("b.rows", F.lit(0)).alias("right_rows"),
    )


def group_equality(left: DataFrame, right: DataFrame, by: str, buckets: int = BUCKETS) -> DataFrame:
    """``(by, left_rows, right_rows, equal)``: whether each group holds the same rows on both sides."""
    plain = hashable(left, right)
    sums = lambda df, side: bucket_fingerprints(df, by, buckets, plain).groupBy(by).agg(
        F.sum("rows").alias("rows"), F.sum("low").alias("low"), F.sum("high").alias("high")
    ).select(F.col(by).alias(f"_{side}"), F.struct("rows", "low", "high").alias(side))
    both = sums(left, "a").join(
        sums(right.select(*map(quoted, left.columns)), "b"), F.col("_a").eqNullSafe(F.col("_b")), "full_outer"
    )
    return both.select(
        F.coalesce("_a", "_b").alias(by), F.coalesce("a.rows", F.lit(0)).alias("left_rows"),
        F.coalesce("b.rows", F.lit(0)).alias("right_rows"), F.col("a").eqNullSafe(F.col("b")).alias("equal"),
    )


def row_differences_by_bucket(left: DataFrame, right: DataFrame, by: str, buckets: int = BUCKETS) -> DataFrame:
    """``(columns…, left_copies, right_copies)`` of the rows that one side has more often.

    Tables that agree cost two scans and no exchange of rows. Otherwise the hashes of the rows in buckets
    that are unequal in some group are counted on both sides, 16 bytes a row, and only the rows of a hash
    that is not as often on both sides are compared by their content, nulls equal to nulls. The driver
    holds the numbers of those buckets, ``buckets`` at most, and up to ``SENT_HASHES`` hashes, which go to
    all tasks; if there are more, rows and hashes meet by shuffle.
    The result is written to the scratch folder at once.
    Equality rests on 128-bit hashes, differences on the rows themselves.
    """
    columns = left.columns
    spark = left.sparkSession
    right = right.select(*map(quoted, columns))
    path, unequal = scratch_dir(spark, "differences"), scratch_dir(spark, "hashes")
    plain = hashable(left, right)

    def asked(df: DataFrame) -> DataFrame:
        rows = _marked(df, by, buckets, plain)
        # If every bucket is asked for, none need be told from the others.
        return rows if len(numbers) == buckets else rows.where(F.col(_BUCKET).isin(numbers))

    # The text of a wide row and groups by all its columns make methods too long for HotSpot.
    with small_methods(spark), freed_shuffles(spark):
        found = differing_buckets(left, right, by, buckets).select(_BUCKET).distinct().collect()
        numbers = [r[0] for r in found]  # at most ``buckets``
        sides = [
            (asked(df) if numbers else _marked(df, by, buckets, plain).limit(0)).withColumn("_left", F.lit(side))
            for side, df in ((1, left), (0, right))
        ]
        hashes = sides[0].select("_h1", "_h2", "_left").unionByName(sides[1].select("_h1", "_h2", "_left"))
        hashes.groupBy("_h1", "_h2").agg(F.sum(F.col("_left") * 2 - 1).alias("_more")).where("_more <> 0").select(
            F.col("_h1").alias("_hash")
        ).write.parquet(unequal)
        wanted = spark.read.schema("_hash long").parquet(unequal)
        if wanted.count() <= SENT_HASHES:
            wanted = F.broadcast(wanted)
        some = [rows.join(wanted, F.col("_h1") == F.col("_hash"), "left_semi") for rows in sides]
        some = [rows.select(*map(quoted, columns), "_left") for rows in some]
        counted = some[0].unionByName(some[1]).groupBy(*map(quoted, columns)).agg(
            F.sum("_left").cast("long").alias("left_copies"),
            F.sum(1 - F.col("_left")).cast("long").alias("right_copies"),
        )
        differing = counted.where("left_copies <> right_copies")
        differing.write.parquet(path)
    drop_dir(spark, unequal)
    return spark.read.schema(differing.schema).parquet(path)
