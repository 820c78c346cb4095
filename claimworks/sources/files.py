"""Facts about files: size, digest, magic bytes, decoded size and header cells."""

from __future__ import annotations

import codecs
import csv
import gzip
import hashlib
import io
import sys
import zlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The functions below travel to the executors whole, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FACTS_SCHEMA = (
    "path string, bytes long, sha256 string, magic string, text_bytes long, "
    "header array<string>, problem string"
)
GZIP_MAGIC = "1F8B"  # fixed value
BLOCK = 4 * 1024 * 1024


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store the path names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def list_files(spark: SparkSession, paths: str | list[str], glob: str | None = None) -> DataFrame:
    """``(path, bytes)`` of all files under the paths; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(paths).select("path", F.col("length").alias("bytes"))


def file_facts(
    spark: SparkSession,
    paths: str | list[str],
    glob: str | None = None,
    depth: str = "full",
    delimiter: str = ";",
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row of facts per file, each file streamed in blocks by one task.

    ``binaryFile`` content would hold a whole file in memory and stops at 2 GB, so only the listing
    comes from it. Depths: ``digest`` hashes the bytes; ``full`` also reads gzip to its end, which
    checks the CRC and the encoding, counts the decoded bytes and yields the header cells; ``header`` stops after
    the first line and gives no digest. A damaged file gives a ``problem``, not a failed job. ``keep``
    narrows the listing before any content is read.
    """
    if depth not in ("digest", "header", "full"):
        raise ValueError(f"unknown depth: {depth}")

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                [_facts_of(p, n, depth, delimiter) for p, n in zip(batch["path"], batch["bytes"])]
            )

    listing = list_files(spark, paths, glob)
    return (keep(listing) if keep else listing).select("path", "bytes").mapInPandas(scan, FACTS_SCHEMA)


class _Digesting:
    """A reader that hashes and counts what passes through."""

    def __init__(self, stream):
        self.stream = stream
        self.sha = hashlib.sha256()
        self.count = 0
        self.first = b""

    def read(self, size: int = BLOCK) -> bytes:
        block = self.stream.read(size if size and size > 0 else BLOCK)
        if len(self.first) < 2:
            self.first = (self.first + block)[:2]
        self.sha.update(block)
        self.count += len(block)
        return block

    def drain(self) -> None:
        while self.read(BLOCK):
            pass


def _open(path: str):
    from pyarrow import fs

    # Hadoop and Arrow spell the same object store differently.
    uri = path.replace("s3a://", "s3://", 1) if path.startswith("s3a://") else path
    filesystem, name = fs.FileSystem.from_uri(uri)
    return filesystem.open_input_stream(name, compression=None)


def _header_cells(line: bytes, delimiter: str) -> list[str]:
    text = line.rstrip(b"\r").decode("utf-8")
    return next(csv.reader(io.StringIO(text, newline=""), delimiter=delimiter), [])


def _facts_of(path: str, size: int, depth: str, delimiter: str) -> dict:
    header, text_bytes, problem = None, None, None
    with _open(path) as stream:
        source = _Digesting(stream)
        if depth != "digest":
            try:
                text = gzip.GzipFile(fileobj=source) if path.endswith(".gz") else source
                parts, text_bytes, open_line = [], 0, True
                utf8 = codecs.getincrementaldecoder("utf-8")()
                while block := text.read(BLOCK):
                    text_bytes += len(block)
                    utf8.decode(block)
                    if open_line:
                        head, end, _ = block.partition(b"\n")
                        parts.append(head)
                        open_line = not end
                    if depth == "header" and not open_line:
                        break
                if depth == "full":
                    utf8.decode(b"", final=True)
                header = _header_cells(b"".join(parts), delimiter)
            except (OSError, EOFError, zlib.error) as error:
                text_bytes, problem = None, f"unreadable archive: {error}"
            except UnicodeDecodeError:
                problem = "text is not UTF-8"
        if depth != "header":
            source.drain()
    whole = depth != "header"
    return {
        "path": path, "bytes": source.count if whole else int(size),
        "sha256": source.sha.hexdigest() if whole else None,
        "magic": source.first.hex().upper(), "text_bytes": text_bytes if whole else None,
        "header": header, "problem": problem,
    }
