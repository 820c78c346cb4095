"""Question rounds between groups of documents and buckets of keys.

Documents lie in groups of bounded size. In a round each group sends every bucket one message, a
compact list of its distinct keys, and each bucket answers each group with one message of the same
order. A key that stands in a third of all documents is thus one entry per group, whatever the number
of documents. Groups and buckets are keyed rows of Spark's shuffle; what a function makes depends only
on its group, so a lost task is run again with the same result.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GROUP, BUCKET, BODY = "__group", "__bucket", "__body"
MESSAGE = f"{GROUP} int, {BUCKET} int, {BODY} binary"
_SCHEMA = pa.schema([(GROUP, pa.int32()), (BUCKET, pa.int32()), (BODY, pa.binary())])


def text_bytes(docs: DataFrame, column: str) -> int:
    """All bytes of a text column."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0)).alias("n")).head()["n"]


def counts(total: int, group_bytes: int, bucket_bytes: int) -> tuple[int, int]:
    """Numbers of groups and buckets for a number of text bytes."""
    return total // group_bytes + 1, total // bucket_bytes + 1


def ask(grouped: DataFrame, question: Callable) -> DataFrame:
    """One message per group and bucket; ``question(table)`` yields ``(bucket, bytes)``."""

    def run(table: pa.Table) -> pa.Table:
        group = table.column(GROUP)[0].as_py()
        made = list(question(table))
        return pa.table(
            [[group] * len(made), [b for b, _ in made], [body for _, body in made]], schema=_SCHEMA
        )

    return grouped.groupBy(GROUP).applyInArrow(run, MESSAGE)


def ask_again(grouped: DataFrame, answers: DataFrame, question: Callable) -> DataFrame:
    """As ``ask``, knowing the answers of the round before."""

    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _SCHEMA.empty_table()
        group = table.column(GROUP)[0].as_py()
        made = list(question(table, in_order(replies)))
        return pa.table(
            [[group] * len(made), [b for b, _ in made], [body for _, body in made]], schema=_SCHEMA
        )

    return grouped.groupBy(GROUP).cogroup(answers.groupBy(GROUP)).applyInArrow(run, MESSAGE)


def answer(messages: DataFrame, reply: Callable) -> DataFrame:
    """One answer per message; ``reply(groups, bodies)`` gives the bodies in the same order."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(
            zip(table.column(GROUP).to_pylist(), table.column(BODY).to_pylist(), strict=True),
            key=lambda row: row[0],
        )
        bucket = table.column(BUCKET)[0].as_py()
        groups = [g for g, _ in rows]
        return pa.table([groups, [bucket] * len(rows), reply(groups, [b for _, b in rows])], schema=_SCHEMA)

    return messages.groupBy(BUCKET).applyInArrow(run, MESSAGE)


def finish(grouped: DataFrame, answers: list[DataFrame], work: Callable, schema, arrow) -> DataFrame:
    """The result of each group: ``work(table, bodies of each round)`` as columns of the schema."""
    numbered = [a.withColumn("__round", F.lit(i)) for i, a in enumerate(answers)]
    every = numbered[0]
    for more in numbered[1:]:
        every = every.unionByName(more)
    n = len(answers)

    def run(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return arrow.empty_table()
        which = replies.column("__round").to_numpy()
        parts = [in_order(replies.filter(pa.array(which == i))) for i in range(n)]
        return work(table, *parts).cast(arrow)

    return grouped.groupBy(GROUP).cogroup(every.groupBy(GROUP)).applyInArrow(run, schema)


def in_order(replies: pa.Table) -> list[bytes]:
    rows = zip(replies.column(BUCKET).to_pylist(), replies.column(BODY).to_pylist(), strict=True)
    return [body for _, body in sorted(rows, key=lambda row: row[0])]
