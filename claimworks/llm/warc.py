"""Web archive records in ZIP packages: writing, and reading by ranges without extraction.

A package holds ``archive/data.warc.gz``, the records one after another, each a gzip member of its own,
and ``indexes/index.cdxj``, one line per record with its place in that member. Both members are stored
in the package without further compression, so a record is a byte range of the package. The reader takes the directory from the package's end, with its ZIP64 form, finds
the members' data behind their local headers, and reads ranges.

Paths go through ``pyarrow.fs``, so packages may lie in any store it knows; the folder must be one that
all executors reach.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import struct
import sys
import uuid
import zipfile

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimworks.llm.tables import stored
from claimworks.session import scratch_dir

cloudpickle.register_pickle_by_value(sys.modules[__name__])

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
PACKAGE = 64 << 20  # bytes of records in a package, about, before they are compressed
LEVEL = 6
# Fixed values of the ZIP format: signatures, and the sizes that say "see ZIP64".
END, END64, LOCATOR64, ENTRY, LOCAL = b"PK\x05\x06", b"PK\x06\x06", b"PK\x06\x07", b"PK\x01\x02", b"PK\x03\x04"
MAX16, MAX32, EXTRA64, STORED = 0xFFFF, 0xFFFFFFFF, 0x0001, 0
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "payload binary"
)
_ARROW = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
])


def place(path: str):
    """``(file system, path)`` of a URI or a local path."""
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


# --- Records -----------------------------------------------------------------------------------


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, sha: str, refers_to, revisit: bool) -> bytes:
    """One WARC record; a revisit keeps the response's HTTP head and leaves out the payload."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + (b"" if revisit else payload)
    name = "none" if page_id is None else page_id
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{name}>"),
        ("WARC-Date", "2000-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{sha}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", url.replace("\r", "%0D").replace("\n", "%0A")))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{'none' if refers_to is None else refers_to}>")]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def _headers(text: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in text.decode().split("\r\n")[1:] if ": " in line)


def _page(name: str):
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return None if number == "none" else int(number)


def parse(raw: bytes) -> tuple:
    """A record's fields as in ``RECORDS``; a payload that does not match its digest is an error."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _headers(head)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size, revisit = int(_headers(http)["Content-Length"]), fields["WARC-Type"] == "revisit"
    sha = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if not revisit and (len(payload) != size or digest(payload) != sha):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    refers = _page(fields["WARC-Refers-To"]) if revisit else None
    return (
        _page(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), size, sha, fields["WARC-Type"], refers,
        None if revisit else payload,
    )


# --- Packages ----------------------------------------------------------------------------------


class _Plain(io.RawIOBase):
    """A write-only stream for ``zipfile`` over a store's output stream."""

    def __init__(self, stream):
        self.stream = stream

    def writable(self):
        return True

    def write(self, data):
        self.stream.write(data)
        return len(data)


class Package:
    """A ZIP package under construction; records go straight to the store, the index at the end."""

    def __init__(self, path: str):
        store, at = place(path)
        store.create_dir(at.rsplit("/", 1)[0], recursive=True)
        self.path, self.lines, self.offset = path, [], 0
        self.stream = store.open_output_stream(at)
        self.zip = zipfile.ZipFile(_Plain(self.stream), "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(_entry(DATA), "w", force_zip64=True)

    def add(self, url, raw: bytes) -> None:
        raw = gzip.compress(raw, LEVEL, mtime=0)
        self.member.write(raw)
        line = {"url": url, "offset": self.offset, "length": len(raw)}
        self.lines.append(json.dumps(line) + "\n")
        self.offset += len(raw)

    def close(self) -> tuple[str, int]:
        self.member.close()
        with self.zip.open(_entry(INDEX), "w", force_zip64=True) as index:
            for line in self.lines:
                index.write(line.encode())
        self.zip.close()
        self.stream.close()
        return self.path, len(self.lines)


def _entry(name: str) -> zipfile.ZipInfo:
    return zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0))


def directory(file, size: int) -> dict[str, tuple[int, int]]:
    """``name: (place of the data, bytes)`` of the stored members of a package.

    The end record is looked for backward over the longest possible comment. Where a count, size or
    place is at its limit, the ZIP64 records hold the number. Compressed members are refused.
    """
    tail_at = max(0, size - 22 - MAX16)
    file.seek(tail_at)
    tail = file.read(size - tail_at)
    at = tail.rfind(END)
    while at >= 0 and not _closes(tail, at):
        at = tail.rfind(END, 0, at)
    if at < 0:
        raise ValueError("no end of a ZIP directory")
    count, length, begin = struct.unpack_from("<HII", tail, at + 10)
    if MAX16 == count or MAX32 in (length, begin):
        mark = tail_at + at - 20
        file.seek(max(0, mark))
        locator = file.read(20)
        if mark < 0 or locator[:4] != LOCATOR64:
            raise ValueError("no ZIP64 locator")
        file.seek(struct.unpack_from("<Q", locator, 8)[0])
        end = file.read(56)
        if end[:4] != END64:
            raise ValueError("no ZIP64 end of directory")
        count, length, begin = struct.unpack_from("<QQQ", end, 32)
    file.seek(begin)
    raw, members, at = file.read(length), {}, 0
    for _ in range(count):
        if raw[at : at + 4] != ENTRY:
            raise ValueError("damaged ZIP directory")
        method, = struct.unpack_from("<H", raw, at + 10)
        packed, plain, n_name, n_extra, n_comment = struct.unpack_from("<IIHHH", raw, at + 20)
        local, = struct.unpack_from("<I", raw, at + 42)
        name = raw[at + 46 : at + 46 + n_name].decode()
        extra = raw[at + 46 + n_name : at + 46 + n_name + n_extra]
        plain, packed, local = _wide(extra, plain, packed, local)
        if method != STORED or packed != plain:
            raise ValueError(f"{name} is compressed")
        members[name] = (local, plain)
        at += 46 + n_name + n_extra + n_comment
    return {name: (_data_place(file, local), n) for name, (local, n) in members.items()}


def _closes(tail: bytes, at: int) -> bool:
    """Does an end record at this place, with its comment, reach the end of the package?"""
    return at + 22 <= len(tail) and at + 22 + struct.unpack_from("<H", tail, at + 20)[0] == len(tail)


def _wide(extra: bytes, *values: int) -> list[int]:
    """Sizes and place of a directory entry, from the ZIP64 extra field where they are at the limit."""
    at, wide = 0, b""
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == EXTRA64:
            wide = extra[at + 4 : at + 4 + n]
        at += 4 + n
    out, used = [], 0
    for value in values:
        if value == MAX32:
            value, used = struct.unpack_from("<Q", wide, used)[0], used + 8
        out.append(value)
    return out


def _data_place(file, local: int) -> int:
    file.seek(local)
    head = file.read(30)
    if head[:4] != LOCAL:
        raise ValueError("no local header")
    return local + 30 + sum(struct.unpack_from("<HH", head, 26))


# --- Jobs --------------------------------------------------------------------------------------


def decide(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) with payload digest, record type and what a revisit refers to.

    Of equal payloads of at least ``least_bytes`` the largest page_id is the response and the others
    revisit it; a null page_id is smaller than all others. Rows that share that page_id are responses
    each. A null page is an empty payload.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), payload.alias("payload"),
        F.sha1(payload).alias("sha"),
    )
    known = rows.groupBy("sha").agg(F.max("page_id").alias("first"))
    revisit = (F.octet_length("payload") >= least_bytes) & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(known, "sha").select(
        "page_id", "url", "payload", revisit.alias("revisit"), F.when(revisit, F.col("first")).alias("refers_to")
    )


def write_packages(records: DataFrame, folder: str, package_bytes: int = PACKAGE) -> DataFrame:
    """Writes what ``decide`` gives to packages under ``folder``; ``path, records`` of each.

    Every try of a task writes packages of its own name; only those of tries that ended are returned,
    and the list is stored, so a lost task leaves files that nobody reads.
    """

    def run(batches):
        package, held, made = None, 0, []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                page_id, url, payload, revisit, refers_to = row
                if package is None:
                    package = Package(f"{folder}/{uuid.uuid4().hex}.wacz")
                raw = record(page_id, url, payload, digest(payload), refers_to, revisit)
                package.add(url, raw)
                held += len(raw)
                if held >= package_bytes:
                    made.append(package.close())
                    package, held = None, 0
        if package is not None:
            made.append(package.close())
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in made], pa.string()), pa.array([n for _, n in made], pa.int64())],
            ["path", "records"],
        )

    return stored(records.mapInArrow(run, "path string, records long"), "packages")


def read_packages(paths: DataFrame, batch_bytes: int = 4 << 20) -> DataFrame:
    """All records of the packages named in the column ``path``, by ranges found in their indexes."""

    def ranges(batches):
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, at = place(path)
                with store.open_input_file(at) as file:
                    members = directory(file, file.size())
                    data, _ = members[DATA]
                    begin, size = members[INDEX]
                    file.seek(begin)
                    lines = [json.loads(x) for x in file.read(size).decode().splitlines()]
                for part in _parts(lines, batch_bytes):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([path]), pa.array([data + part[0]["offset"]]),
                            pa.array([[x["length"] for x in part]], pa.list_(pa.int64())),
                        ],
                        ["path", "start", "lengths"],
                    )

    def records(batches):
        for batch in batches:
            for path, start, lengths in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                store, at = place(path)
                with store.open_input_file(at) as file:
                    file.seek(start)
                    rows = [parse(gzip.decompress(file.read(n))) for n in lengths]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW
                )

    # A path or a range is a few bytes that stand for many: deal them out by number, not by size.
    tasks = int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = paths.select("path").repartition(tasks).mapInArrow(
        ranges, "path string, start long, lengths array<long>"
    )
    return found.repartition(tasks).mapInArrow(records, RECORDS)


def _parts(lines: list[dict], batch_bytes: int):
    """Consecutive records with about so many bytes."""
    part, size = [], 0
    for line in lines:
        part.append(line)
        size += line["length"]
        if size >= batch_bytes:
            yield part
            part, size = [], 0
    if part:
        yield part


def archive_round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes all pages to packages in the shared folder and reads every record back.

    Rows as in ``RECORDS``; a revisit has no payload. Repeated rows have a record each; an empty table
    writes nothing and gives no rows; other columns are not read.
    """
    folder = scratch_dir(pages.sparkSession, "warc")
    return read_packages(write_packages(decide(pages, least_bytes), folder))
