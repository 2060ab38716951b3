"""WARC archives as a Spark data source: ``spark.read.format("warc")`` and ``df.write``.

Reading plans one partition per archive file. Filters on record type and on header
columns are pushed into the tasks. A task parses a record's headers first; if the
record is not wanted, or its payload is not, the payload is neither decoded nor read:
plain archives are left by Content-Length, and compressed ones by the ``sl`` field of
the member's gzip header (WARC, annex D), or by inflating where that is missing.

Writing makes one gzip member per record. Tasks write to names of their own, and the
driver's commit gives the finished files their final names, so that a lost executor
or a repeated task leaves nothing that a reader would see.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    StringStartsWith,
    WriterCommitMessage,
)

# Column, its header, as the format names it.
HEADERS = {
    "record_type": "WARC-Type",
    "record_id": "WARC-Record-ID",
    "date": "WARC-Date",
    "target_uri": "WARC-Target-URI",
    "refers_to": "WARC-Refers-To",
    "payload_digest": "WARC-Payload-Digest",
    "profile": "WARC-Profile",
}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

SCHEMA = ", ".join(f"{c} string" for c in HEADERS) + ", payload_length long, payload binary"
_ARROW = pa.schema(
    [(c, pa.string()) for c in HEADERS] + [("payload_length", pa.int64()), ("payload", pa.binary())]
)
_BATCH_BYTES, _BATCH_ROWS = 8 << 20, 2000
_FILE_BYTES = 256 << 20


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def base32_of_sha1(hexadecimal) -> Column:
    """The 32 base32 characters of a SHA-1 given as 40 hexadecimal digits."""
    characters = []
    for start in range(1, 41, 5):
        bits = F.conv(F.substring(hexadecimal, start, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            at = F.shiftright(bits, shift).bitwiseAND(31) + 1
            characters.append(F.substring(F.lit(BASE32), at, F.lit(1)))
    return F.concat(*characters)


class WarcSource(DataSource):
    """Options: path; payload (false: headers only, the payload column is null)."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("write archives to a new folder, with mode append")
        return WarcWriter(self.options, schema)


@dataclass
class WarcFile(InputPartition):
    path: str


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.payload = options.get("payload", "true").lower() != "false"
        self.wanted = []

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else None
            if name in HEADERS and isinstance(
                f, (EqualTo, In, IsNotNull, IsNull, StringStartsWith)
            ):
                kind = type(f).__name__
                self.wanted.append((kind, name, getattr(f, "value", None)))
            else:
                yield f

    def partitions(self):
        store, root = _store(self.path)
        found = store.get_file_info(fs.FileSelector(root, recursive=False))
        files = [i.path for i in found if i.path.endswith((".warc", ".warc.gz"))]
        return [WarcFile(p) for p in sorted(files)] or [WarcFile("")]

    def read(self, partition):
        if not partition.path:
            return
        store, _ = _store(self.path)
        columns, size = [[] for _ in _ARROW], 0
        with store.open_input_file(partition.path) as file:
            for row in records(file, self.accepts, self.payload):
                for column, value in zip(columns, row):
                    column.append(value)
                size += len(row[-1] or b"")
                if size >= _BATCH_BYTES or len(columns[0]) >= _BATCH_ROWS:
                    yield _batch(columns)
                    columns, size = [[] for _ in _ARROW], 0
        yield _batch(columns)

    def accepts(self, row: dict) -> bool:
        return all(_holds(kind, row.get(name), value) for kind, name, value in self.wanted)


def _holds(kind, value, given):
    if kind == "IsNull":
        return value is None
    if value is None:
        return False
    if kind == "EqualTo":
        return value == given
    if kind == "In":
        return value in given
    return kind == "IsNotNull" or value.startswith(given)


def _batch(columns):
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW)


def _store(path: str):
    """The file system of a path, and the path within it."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def records(file, accepts, with_payload: bool):
    """Rows of _ARROW from an open, seekable archive."""
    at, end = 0, file.size()
    while at < end:
        file.seek(at)
        start = file.read(26)
        opened = _Member(file, at, start) if start[:2] == b"\x1f\x8b" else _Plain(file, at)
        head = opened.until(b"\r\n\r\n")
        headers = _fields(head)
        if not head.startswith(b"WARC/") or "content-length" not in headers:
            raise ValueError(f"no WARC record at byte {at}")
        row = {c: headers.get(h.lower()) for c, h in HEADERS.items()}
        length = int(headers["content-length"])
        if accepts(row):
            payload, size = None, length
            left = length
            if headers.get("content-type", "").startswith("application/http") and length:
                http = opened.until(b"\r\n\r\n", length)
                left -= len(http)
                size = int(_fields(http).get("content-length", left))
            if with_payload:
                payload = opened.take(left)
            yield [*row.values(), size, payload]
        at = opened.after(length, len(head))


def _fields(head: bytes) -> dict:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    pairs = (line.split(":", 1) for line in lines if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in pairs}


class _Plain:
    def __init__(self, file, at):
        self.file, self.at, self.buffer = file, at, b""
        file.seek(at)

    def more(self) -> bool:
        chunk = self.file.read(8192)
        self.buffer += chunk
        return bool(chunk)

    def until(self, mark: bytes, most: int | None = None) -> bytes:
        """Bytes up to and with the mark; those that are there if it is missing."""
        while (found := self.buffer.find(mark)) < 0 and (most is None or len(self.buffer) < most):
            if not self.more():
                break
        cut = found + len(mark) if found >= 0 else min(len(self.buffer), most or len(self.buffer))
        head, self.buffer = self.buffer[:cut], self.buffer[cut:]
        return head

    def take(self, n: int) -> bytes:
        parts, have = [self.buffer], len(self.buffer)
        while have < n:
            chunk = self.pull(n - have)
            if not chunk:
                raise ValueError(f"the record at byte {self.at} is cut off")
            parts.append(chunk)
            have += len(chunk)
        whole = b"".join(parts)
        self.buffer = whole[n:]
        return whole[:n]

    def pull(self, n: int) -> bytes:
        return self.file.read(max(n, 8192))

    def after(self, length: int, head: int) -> int:
        return self.at + head + length + 4


class _Member(_Plain):
    """A gzip member that holds one record."""

    def __init__(self, file, at, start):
        super().__init__(file, at)
        self.skip = None
        if start[3] & 4 and start[12:14] == b"sl":
            self.skip = struct.unpack("<I", start[16:20])[0]
        self.inflate = zlib.decompressobj(31)
        self.raw = b""

    def pull(self, n: int) -> bytes:
        while not self.inflate.eof:
            self.raw = self.inflate.unconsumed_tail or self.file.read(16384)
            if not self.raw:
                return b""
            out = self.inflate.decompress(self.raw, max(n, 8192))
            if out:
                return out
        return b""

    def more(self) -> bool:
        chunk = self.pull(4096)
        self.buffer += chunk
        return bool(chunk)

    def after(self, length, head):
        if self.skip is not None:
            return self.at + self.skip
        while self.pull(1 << 16):
            pass
        if not self.inflate.eof:
            raise ValueError(f"the record at byte {self.at} is cut off")
        return self.file.tell() - len(self.inflate.unused_data)


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    """Columns: those of HEADERS that there are, payload, and payload_length for revisits."""

    def __init__(self, options, schema):
        self.path = options["path"]
        self.names = schema.fieldNames()

    def write(self, iterator):
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        files, out, size = [], None, 0
        for batch in iterator:
            columns = {n: batch.column(i) for i, n in enumerate(self.names)}
            for i in range(batch.num_rows):
                if out is None or size > _FILE_BYTES:
                    if out is not None:
                        out.close()
                    files.append(f"{root}/_{uuid.uuid4().hex}.unfinished")
                    out, size = store.open_output_stream(files[-1], compression=None), 0
                member = gzip_member(record({n: c[i].as_py() for n, c in columns.items()}))
                out.write(member)
                size += len(member)
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages):
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        for message in messages:
            for path in message.files if message else ():
                name = path.rsplit("/_", 1)[1].removesuffix(".unfinished")
                store.move(path, f"{root}/part-{name}.warc.gz")

    def abort(self, messages):
        store, _ = _store(self.path)
        for message in messages:
            for path in message.files if message else ():
                store.delete_file(path)


def _clean(value: str) -> str:
    return "".join(f"%{ord(c):02X}" if c < " " or c == "\x7f" else c for c in value)


def record(row: dict) -> bytes:
    """One WARC record: HTTP headers, and for all but revisits the payload after them."""
    payload = row.get("payload") or b""
    size = len(payload)
    if row.get("record_type") == "revisit":
        size, payload = row.get("payload_length") or 0, b""
    block = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n"
    ).encode() + payload
    lines = ["WARC/1.1"]
    lines += [f"{h}: {_clean(row[c])}" for c, h in HEADERS.items() if row.get(c) is not None]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(content: bytes) -> bytes:
    """A gzip member whose header tells its own length, so that readers can pass it by."""
    deflate = zlib.compressobj(4, zlib.DEFLATED, -15)
    body = deflate.compress(content) + deflate.flush()
    whole = 12 + 12 + len(body) + 8
    flags, extra = 0, b""
    if whole < 1 << 32 and len(content) < 1 << 32:
        flags = 4
        extra = struct.pack("<H", 12) + b"sl" + struct.pack("<HII", 8, whole, len(content))
    head = b"\x1f\x8b\x08" + bytes([flags]) + b"\0\0\0\0\0\xff"
    if not extra:
        whole -= 14
    return (
        head + extra + body + struct.pack("<II", zlib.crc32(content), len(content) & 0xFFFFFFFF)
    )


def archive_pages(pages: DataFrame, path: str, least: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write one record per row of (page_id, url, html) below ``path``.

    Payload is the html in UTF-8, empty for null. Of rows whose payloads of at least
    ``least`` bytes are equal, that with the smallest page_id becomes a response, and
    the others revisit it; shorter ones are all responses. A row without page_id is a
    response only if no equal one has an id. Rows that repeat the smallest page_id
    are all responses. An empty table gives a folder without records.
    """
    spark = pages.sparkSession
    register(spark)
    payload = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select("page_id", "url", payload.alias("html")).withColumn("sha1", F.sha1("html"))
    firsts = rows.groupBy("sha1").agg(F.min("page_id").alias("first"))
    size = F.octet_length("html").cast("long")
    again = (size >= least) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    record_id = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    own = F.coalesce(record_id(F.col("page_id")), F.lit("<urn:page:none>"))
    (
        rows.join(firsts, "sha1")
        .select(
            F.when(again, "revisit").otherwise("response").alias("record_type"),
            own.alias("record_id"),
            F.lit(date).alias("date"),
            F.col("url").cast("string").alias("target_uri"),
            F.when(again, record_id(F.col("first"))).alias("refers_to"),
            F.concat(F.lit("sha1:"), base32_of_sha1(F.col("sha1"))).alias("payload_digest"),
            F.when(again, REVISIT_PROFILE).alias("profile"),
            size.alias("payload_length"),
            F.when(~again, F.col("html").cast("binary")).alias("payload"),
        )
        .write.format("warc")
        .mode("append")
        .save(path)
    )


def read_archive(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) from archives.

    A response's length and digest are those of the payload that was read; a revisit
    has no payload, and its headers tell both.
    """
    number = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
    responses = read_archive(spark, path).filter(F.col("record_type") == "response")
    revisits = read_archive(spark, path, payload=False).filter(F.col("record_type") == "revisit")
    return responses.select(
        number("record_id").alias("page_id"),
        F.length("payload").cast("long").alias("payload_bytes"),
        base32_of_sha1(F.sha1("payload")).alias("payload_digest"),
        "record_type",
        F.lit(None).cast("long").alias("refers_to"),
    ).unionByName(
        revisits.select(
            number("record_id").alias("page_id"),
            F.col("payload_length").alias("payload_bytes"),
            F.substring_index("payload_digest", ":", -1).alias("payload_digest"),
            "record_type",
            number("refers_to").alias("refers_to"),
        )
    )
