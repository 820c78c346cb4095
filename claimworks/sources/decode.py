"""One pass over compressed archives: digest, CRC, encoding and header checked while the text is cut.

An archive is inflated once, by one task, since gzip has no places to enter it. Its text leaves that
task in blocks that end where a record ends, so any number of tasks can parse them. Blocks and facts are
written by Spark's own writer: what a lost or repeated task wrote does not count.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimworks.sources.archives import MALFORMED, header_problem, text_schema
from claimworks.sources.files import BLOCK, _Digesting, _header_cells, _open

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_TEXT = 1024 * 1024  # text of a block, up to the end of its last record
LONGEST_RECORD = 16 * 1024 * 1024  # text without a record end in sight is cut at a line end beyond this
# A row group is what one task can parse: some blocks.
LAYOUT = {
    "compression": "zstd", "parquet.compression.codec.zstd.level": "1", "parquet.block.row.count.limit": "32",
}
MOST_TASKS = 10_000  # tasks that inflate archives; beyond it a task takes some, one after the other
FACT_FIELDS = "bytes long, sha256 string, magic string, text_bytes long, header array<string>, problem string"
SCHEMA = f"path string, month string, block long, first_byte long, lines long, text string, {FACT_FIELDS}"
_ARROW = pa.schema([
    ("path", pa.string()), ("month", pa.string()), ("block", pa.int64()), ("first_byte", pa.int64()),
    ("lines", pa.int64()), ("text", pa.string()), ("bytes", pa.int64()), ("sha256", pa.string()),
    ("magic", pa.string()), ("text_bytes", pa.int64()), ("header", pa.list_(pa.string())), ("problem", pa.string()),
])


def decode_archives(archives: DataFrame, path: str, delimiter: str = ";") -> DataFrame:
    """Inflate archives ``(path, month)`` once and store their text in blocks; returns the stored rows.

    A row with a ``block`` number holds lines of one archive after the header: ``first_byte`` is the
    place of its text in the decoded archive, ``lines`` their number. One row per archive without block
    holds its facts, as :func:`claimworks.sources.files.file_facts` gives them. A damaged archive has a
    ``problem`` and perhaps some blocks; it stops nothing else. Blocks end at line ends outside quotes;
    an archive whose quotes never close is cut at line ends all the same, so memory stays bounded and
    the parser finds the damage. Stored by month, so a month can be read alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, month in zip(batch.column("path").to_pylist(), batch.column("month").to_pylist(), strict=True):
                yield from _decoded(name, month, delimiter)

    spark = archives.sparkSession
    # A task per archive: few rows name much work, and Spark would put them into one task.
    tasks = max(1, min(MOST_TASKS, archives.count()))
    rows = archives.select("path", "month").repartitionByRange(tasks, "path").mapInArrow(run, SCHEMA)
    writers = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(writers)
    # A task holds one archive at a time. Without open writers Spark would sort all text by month first.
    spark.conf.set(writers, "256")
    try:
        rows.write.mode("overwrite").options(**LAYOUT).partitionBy("month").parquet(path)
    finally:
        spark.conf.set(writers, before)
    schema = T.StructType([f for f in rows.schema if f.name != "month"]).add("month", T.StringType())
    return spark.read.schema(schema).parquet(path)


def archive_facts(decoded: DataFrame) -> DataFrame:
    """One row of facts per archive; the text is not read."""
    return decoded.where(F.col("block").isNull()).select(
        "path", "month", "bytes", "sha256", "magic", "text_bytes", "header", "problem"
    )


def parse_blocks(decoded: DataFrame, header: list[str], delimiter: str = ";") -> DataFrame:
    """The records of blocks that share a header, every column text, empty cells null, and ``month``.

    A record with too few or too many cells keeps its raw line in ``_malformed``. Every task parses the
    blocks it reads; nothing is shuffled.
    """
    problem = header_problem(header)
    if problem:
        raise ValueError(problem)
    names = [*text_schema(header).names, MALFORMED]
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in names)
    options = {
        "sep": delimiter, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED,
    }
    # Java splits at one plain character without a regular expression, several times as fast.
    cut = F.when(F.contains("text", F.lit("\r")), F.split("text", "\r\n|\n|\r")).otherwise(F.split("text", "\n"))
    lines = decoded.where(F.col("block").isNotNull()).select("month", F.explode(cut).alias("line")).where(
        F.trim("line") != ""
    )
    return lines.select("month", F.from_csv("line", schema, options).alias("cells")).select(
        "cells.*", "month"
    )


def _decoded(path: str, month: str, delimiter: str) -> Iterator[pa.RecordBatch]:
    """The blocks of one archive, then its facts."""
    facts = {"path": path, "month": month, "text_bytes": 0, "header": None, "problem": None}
    with _open(path) as stream:
        source = _Digesting(stream)
        try:
            text, number, at = _Cutter(), 0, 0
            for piece in _inflated(source, path.endswith(".gz")):
                facts["text_bytes"] += len(piece)
                for block in text.add(piece):
                    number, at, row = _row(facts, block, number, at, delimiter)
                    if row:
                        yield row
            rest = text.rest()
            if rest or facts["header"] is None:
                _, _, row = _row(facts, rest, number, at, delimiter)
                if row:
                    yield row
        except (OSError, EOFError, zlib.error) as error:
            facts |= {"text_bytes": None, "problem": f"unreadable archive: {error}"}
        except UnicodeDecodeError:
            facts["problem"] = "text is not UTF-8"
        source.drain()
    facts |= {"bytes": source.count, "sha256": source.sha.hexdigest(), "magic": source.first.hex().upper()}
    yield pa.RecordBatch.from_pylist([facts], schema=_ARROW)


def _row(facts: dict, block: bytes, number: int, at: int, delimiter: str):
    """The next block's number and place and its row; the first block gives up the header line."""
    start, at = at, at + len(block)
    if facts["header"] is None:
        line, _, block = block.partition(b"\n")
        facts["header"] = _header_cells(line, delimiter)
        start += at - start - len(block)
    if not block:
        return number, at, None
    row = {
        "path": facts["path"], "month": facts["month"], "block": number, "first_byte": start,
        "lines": block.count(b"\n") + (not block.endswith(b"\n")), "text": block.decode(),
    }
    return number + 1, at, pa.RecordBatch.from_pylist([row], schema=_ARROW)


def _inflated(source: _Digesting, compressed: bool) -> Iterator[bytes]:
    """Decoded pieces of bounded size; gzip members follow each other, each with its CRC checked."""
    if not compressed:
        while piece := source.read(BLOCK):
            yield piece
        return
    member, any_member, data = None, False, b""
    while True:
        if not data:
            data = source.read(BLOCK)
            if not data:
                if member is not None and (piece := member.flush()):
                    yield piece
                break
        if member is None:
            if any_member:
                data = data.lstrip(b"\0")  # padding after the last member
                if not data:
                    continue
            member, any_member = zlib.decompressobj(wbits=31), True
        piece = member.decompress(data, BLOCK)
        data = member.unconsumed_tail
        if member.eof:
            data, member = member.unused_data, None
        if piece:
            yield piece
    if (member is not None and not member.eof) or not any_member:
        raise EOFError("the compressed data ends too early")


class _Cutter:
    """Text pieces in, blocks out that end with a line end outside quotes."""

    def __init__(self):
        self.held, self.parts = 0, []

    def add(self, piece: bytes) -> Iterator[bytes]:
        self.parts.append(piece)
        self.held += len(piece)
        if self.held < BLOCK_TEXT:
            return
        text, self.parts = b"".join(self.parts), []
        at = 0
        while len(text) - at >= BLOCK_TEXT:
            end = self._end(text, at)
            if end is None:
                break
            yield text[at:end]
            at = end
        self.parts, self.held = [text[at:]], len(text) - at

    def _end(self, text: bytes, at: int) -> int | None:
        """The end of a block that starts at a record: about ``BLOCK_TEXT`` on, where quotes are paired."""
        end = text.rfind(b"\n", at, at + BLOCK_TEXT) + 1 or text.find(b"\n", at) + 1
        quotes = text.count(b'"', at, end)
        while end and quotes % 2:
            later = text.find(b"\n", end) + 1
            quotes += text.count(b'"', end, later) if later else 0
            end = later
        if end:
            return end
        if len(text) - at > LONGEST_RECORD:
            return text.rfind(b"\n", at, at + LONGEST_RECORD) + 1 or None
        return None

    def rest(self) -> bytes:
        return b"".join(self.parts)
