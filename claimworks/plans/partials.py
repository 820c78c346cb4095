"""States of the standing analyses: all key lists in one scan, kept per month and run.

A state is a group's row count, sums and conditional counts under one of the analyses' key lists.
States of different rows add up, so those of a month are computed once, stored beside the run that the
month's manifest names, and added up with those of the other months whenever results are asked for.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimworks.functions import total
from claimworks.session import scratch_dir
from claimworks.sources.curated import PARTITION, current_runs, read_curated

SET, ROWS, SUM, COUNT = "key_set", "rows", "sum__", "count__"


def grouped_once(
    claims: DataFrame, key_lists: list[tuple[str, ...]], sums: list[str], counts: dict[str, str],
    within: tuple[str, ...] = (),
) -> DataFrame:
    """``(within…, key_set, keys…, rows, sum__…, count__…)`` of several key lists in one scan.

    ``counts`` are row tests as SQL text.
    Each row is counted under every list and combined on the map side; the exchange carries one row per
    task, list and group, whatever holds most rows. ``key_set`` is the place of the list, so a code that
    is null stays apart from a key that the list does not have.
    """
    lists = list(dict.fromkeys(key_lists))
    keys = list(dict.fromkeys(k for keys in lists for k in keys))
    sets = [[F.col(c) for c in (*within, *keys_)] for keys_ in lists]
    grouped = claims.groupingSets(sets, *[F.col(c) for c in (*within, *keys)]).agg(
        F.grouping_id().cast("long").alias("_absent"), F.count(F.lit(1)).alias(ROWS),
        *[total(c).alias(f"{SUM}{c}") for c in sums],
        *[F.count_if(F.expr(test)).alias(f"{COUNT}{name}") for name, test in counts.items()],
    )
    absent = {
        sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in keys_): at
        for at, keys_ in enumerate(lists)
    }
    number = F.create_map(*[F.lit(x).cast(t) for pair in absent.items() for x, t in zip(pair, ("long", "int"))])
    return grouped.withColumn(SET, number[F.col("_absent")]).drop("_absent")


def merged(states: DataFrame, key_set: int, keys: tuple[str, ...]) -> DataFrame:
    """One key list's groups, states of different rows added up."""
    measures = [c for c in states.columns if c == ROWS or c.startswith((SUM, COUNT))]
    return states.where(F.col(SET) == key_set).groupBy(*keys).agg(
        *[total(c).alias(c) if c.startswith(SUM) else F.sum(c).alias(c) for c in measures]
    )


class Partials:
    """Stored states of the published months of a root, for one set of key lists and measures.

    States lie under ``data/partials``, by a digest of what they hold, then by run and month. A month is
    computed when the run its manifest names has none, which is the case after each new publication and
    for none but the months it changed. Writing replaces whole months, so a lost or repeated writer
    leaves nothing twice.
    """

    def __init__(self, root: str, key_lists: list[tuple[str, ...]], sums: list[str], counts: dict[str, str]):
        self.root, self.key_lists, self.sums, self.counts = root.rstrip("/"), key_lists, sums, counts
        content = json.dumps([key_lists, sums, counts])
        self.folder = f"{self.root}/data/partials"
        self.path = f"{self.folder}/{hashlib.sha256(content.encode()).hexdigest()[:16]}"
        self.computed: list[str] = []

    def states(self, spark: SparkSession, months: list[str] | None = None) -> DataFrame:
        """The states of the published months; those that have none are computed, in one scan."""
        runs = current_runs(spark, self.root, months)
        there = self._stored(spark)
        self.computed = sorted(m for m, run in runs.items() if (run, m) not in there)
        schema = self._schema(spark)
        if self.computed:
            named = spark.createDataFrame([(m, runs[m]) for m in self.computed], f"{PARTITION} string, run string")
            rows = read_curated(spark, self.root, self.computed, keep_month=True)
            made = grouped_once(rows, self.key_lists, self.sums, self.counts, within=(PARTITION,))
            made.join(named, PARTITION).select(*schema.names, "run", PARTITION).write.mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).partitionBy("run", PARTITION).parquet(self.path)
        self._remove_old(spark, there)
        paths = [f"{self.path}/run={run}/{PARTITION}={m}" for m, run in sorted(runs.items())]
        if not paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*paths)

    def _schema(self, spark: SparkSession) -> T.StructType:
        keys = list(dict.fromkeys(k for keys in self.key_lists for k in keys))
        schema = T.StructType().add(SET, T.IntegerType())
        for k in keys:
            schema = schema.add(k, "string")
        schema = schema.add(ROWS, "long")
        for c in self.sums:
            schema = schema.add(f"{SUM}{c}", "decimal(38,6)")
        for name in self.counts:
            schema = schema.add(f"{COUNT}{name}", "long")
        return schema

    def _listed(self, spark: SparkSession):
        """Folders ``(run, month)`` of stored states, with the file system that holds them."""
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        top = hadoop(self.path)
        store = top.getFileSystem(spark._jsc.hadoopConfiguration())
        found = {}
        for run in store.listStatus(top) if store.exists(top) else ():
            name = run.getPath().getName()
            for month in store.listStatus(run.getPath()) if name.startswith("run=") else ():
                at = month.getPath()
                if at.getName().startswith(f"{PARTITION}="):
                    found[name.split("=", 1)[1], at.getName().split("=", 1)[1]] = at
        return store, found

    def _stored(self, spark: SparkSession) -> set:
        return set(self._listed(spark)[1])

    def _remove_old(self, spark: SparkSession, there: set) -> None:
        """States that were there before and that no manifest names now; readers of them should have ended."""
        current = current_runs(spark, self.root)
        store, found = self._listed(spark)
        for (run, month), at in found.items():
            if (run, month) in there and current.get(month) != run:
                store.delete(at, True)


def states_once(claims: DataFrame, key_lists, sums, counts) -> DataFrame:
    """The states of any claims table, written to scratch so that results read them and not the claims."""
    spark = claims.sparkSession
    path = scratch_dir(spark, "states")
    made = grouped_once(claims, key_lists, sums, counts)
    made.write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)
