"""WARC archives: a Python data source, and revisit records for repeated payloads.

``spark.read.format("warc")`` reads any WARC 1.0 or 1.1 archive (``.warc.gz``).  It plans one
partition a file; large files are cut into byte ranges at record borders where the writer left a
list of them beside the file.  Predicates on record type, page id and digest are decided on the
record headers: a record that fails is not inflated further, but skipped by the length that its
gzip member names in the usual ``sl`` extra field (members without one are inflated and thrown
away).  A payload is kept only if its column is asked for.

``df.write.format("warc")`` writes WARC 1.1: a record is one gzip member of headers, block and
two blank lines; a response's block is an HTTP response whose body is the payload.  Record ids
are UUIDs of the run, task and place, so a repeated task writes the same ones and no two records
share one.  One file a task is written under a temporary name; the driver's commit renames the
files of successful attempts and drops the others, so a repeated task leaves nothing behind.
Files are reached through pyarrow's file systems by URI: a folder shared by all executors, local
or remote.

Payloads: SHA-1 in the usual base-32 form in ``WARC-Payload-Digest``; a revisit record has no
block and names its response's URI and date.  ``X-Page-ID``, ``X-Refers-To-Page`` and
``X-Payload-Length`` carry what WARC has no field for.  ``WARC-Date`` is the ``date`` that the
caller gives (no clock is read).

Defined cases: null html counts as empty; a null page id is written without its field and read
back as null, its record revisits a copy that has an id; a null url is written as no target;
repeated rows (same page id, same payload) are written each, all as responses if theirs is the
largest id; an empty table writes no file and reads as an empty table.  In archives of others,
page_id is null where there is no ``X-Page-ID``; a digest other than SHA-1 in base 32 is given as
it stands; payload_bytes is the length of the block less an HTTP response's head.
"""

from __future__ import annotations

import base64
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo,
                                    In, InputPartition, WriterCommitMessage)
from pyspark.sql.types import StructType

from .common import scratch

SCHEMA = ("page_id long, record_type string, payload_digest string, payload_bytes long, "
          "refers_to long, payload binary")
DATE = "1970-01-01T00:00:00Z"
#: Payloads below this size are never written as revisits.
MIN_REVISIT = 1000
RANGE_BYTES = 64 << 20
BLOCK, STEP = 1 << 20, 1 << 16


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    if re.match(r"[a-z][a-z0-9+.-]*:", path):
        return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return pafs.LocalFileSystem(), path


def member(data: bytes) -> bytes:
    """One gzip member that names its whole length and that of its data in an ``sl`` field."""
    z = zlib.compressobj(4, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush() + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)
    size = 10 + 2 + 12 + len(body)
    if max(size, len(data)) >> 32:
        return b"\x1f\x8b\x08\x00\0\0\0\0\0\xff" + body
    return (b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, size, len(data))
            + body)


def member_length(head: bytes) -> int | None:
    """The length that a gzip member's ``sl`` field names, if it has one."""
    if len(head) < 12 or head[:3] != b"\x1f\x8b\x08" or not head[3] & 4:
        return None
    at, end = 12, 12 + struct.unpack_from("<H", head, 10)[0]
    while at + 4 <= min(end, len(head)):
        name, size = struct.unpack_from("<2sH", head, at)
        if name == b"sl" and size == 8 and at + 12 <= len(head):
            return struct.unpack_from("<I", head, at + 4)[0]
        at += 4 + size
    return None


def record(row: dict, record_id: str, date: str) -> bytes:
    """A whole record: headers, block and two blank lines."""
    kind, payload, block = row["record_type"], row["payload"] or b"", b""
    if kind == "response":
        block = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
                 % len(payload)) + payload
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{record_id}>"), ("WARC-Date", date),
              ("WARC-Target-URI", row["target_uri"]),
              ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(row["payload_digest"])).decode()),
              ("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block)),
              ("X-Page-ID", row["page_id"]), ("X-Payload-Length", row["payload_bytes"])]
    if kind == "revisit":
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To-Target-URI", row["refers_to_uri"]), ("WARC-Refers-To-Date", date),
                   ("X-Refers-To-Page", row["refers_to"])]
    lines = ["WARC/1.1"] + [f"{k}: {one_line(str(v))}" for k, v in fields if v is not None]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def one_line(value: str) -> str:
    """A field's value; control characters and blanks of a URI are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def parse_headers(block: bytes) -> dict[str, str]:
    """Fields by lower-case name."""
    lines = block.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = (line.partition(":") for line in lines[1:] if line)
    return {name.strip().lower(): value.strip() for name, _, value in fields}


def number(value: str | None) -> int | None:
    return int(value) if value and re.fullmatch(r"-?\d+", value) else None


def digest_of(value: str | None) -> str | None:
    m = re.fullmatch(r"sha1:([A-Z2-7]{32})", value or "", re.I)
    return base64.b32decode(m[1].upper()).hex() if m else value


class Inflated:
    """The inflated bytes of a run of gzip members, in bounded steps; ``skip`` leaps over a
    member's rest if the member names its length."""

    def __init__(self, f, start: int, end: int):
        self.f, self.next, self.end = f, start, end
        self.raw, self.out, self.z, self.leap = b"", bytearray(), None, None

    def _more_raw(self) -> None:
        self.f.seek(self.next)
        got = self.f.read(min(BLOCK, self.end - self.next))
        self.raw += got
        self.next += len(got)

    def _fill(self) -> bool:
        """Inflate some more; False at the end."""
        if self.z is None:
            if len(self.raw) < 64 and self.next < self.end:
                self._more_raw()
            if not self.raw:
                return False
            length = member_length(self.raw[:64])
            at = self.next - len(self.raw)
            self.leap = at + length if length and not self.out and at + length <= self.end else None
            self.z = zlib.decompressobj(31)
        elif not self.raw:
            if self.next >= self.end:
                raise ValueError("a WARC file ends within a record")
            self._more_raw()
        self.out += self.z.decompress(self.raw, STEP)
        self.raw = self.z.unused_data if self.z.eof else self.z.unconsumed_tail
        if self.z.eof:
            self.z = None
        return True

    def starts(self) -> bool:
        """Whether another record starts here."""
        while not self.out.strip(b"\r\n"):
            self.out.clear()
            if not self._fill():
                return False
        return True

    def head(self, limit: int | None = None) -> int:
        """Length of what comes before the block's first blank line, that included; 0 if none does."""
        while (at := self.out.find(b"\r\n\r\n", 0, limit)) < 0:
            if limit is not None and len(self.out) >= limit or not self._fill():
                return 0
        return at + 4

    def take(self, n: int) -> bytes:
        while len(self.out) < n and self._fill():
            pass
        got = bytes(self.out[:n])
        del self.out[:n]
        return got

    def skip(self, n: int) -> None:
        """Go on behind ``n`` bytes that end a record."""
        if self.z is not None and self.leap is not None and len(self.out) < n:
            at, self.next = self.next, self.leap
            raw, self.raw = self.raw, b""
            self._more_raw()
            if self.leap == self.end or self.raw.startswith(b"\x1f\x8b"):
                self.z, self.leap = None, None
                self.out.clear()
                return
            self.next, self.raw = at, raw  # the field means something else
        while n > 0:
            step = len(self.take(min(n, STEP)))
            if not step:
                return
            n -= step


@dataclass
class FileRange(InputPartition):
    path: str
    start: int
    end: int


@dataclass
class Written(WriterCommitMessage):
    temporary: str
    final: str


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.date = options["path"], options.get("date", DATE)
        self.run = uuid.uuid4()

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        context = TaskContext.get()
        fs, folder = file_system(self.path)
        fs.create_dir(folder, recursive=True)
        name = f"part-{context.partitionId():05d}-{self.run.hex[:12]}"
        temporary = f"{folder}/_{name}-{context.taskAttemptId()}"
        out, at, count, marks = None, 0, 0, [0]
        for batch in batches:
            if out is None:
                out = fs.open_output_stream(temporary)
            names = batch.schema.names
            for values in zip(*batch.columns):
                row = {n: v.as_py() for n, v in zip(names, values)}
                made = member(record(row, uuid.uuid5(self.run, f"{context.partitionId()}/{count}"), self.date))
                out.write(made)
                at, count = at + len(made), count + 1
                if at - marks[-1] >= RANGE_BYTES:
                    marks.append(at)
        if out is None:
            return Written("", "")
        out.close()
        with fs.open_output_stream(temporary + ".ranges") as f:  # where ranges of records begin
            f.write(",".join(map(str, marks + ([at] if marks[-1] < at else []))).encode())
        return Written(temporary, f"{folder}/{name}.warc.gz")

    def commit(self, messages: list) -> None:
        fs, folder = file_system(self.path)
        for m in messages:
            if m is not None and m.final:
                fs.move(m.temporary + ".ranges", m.final + ".ranges")
                fs.move(m.temporary, m.final)
        self._drop_temporary(fs, folder)

    def abort(self, messages: list) -> None:
        self._drop_temporary(*file_system(self.path))

    def _drop_temporary(self, fs: pafs.FileSystem, folder: str) -> None:
        for f in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)):
            if f.base_name.startswith("_") and self.run.hex[:12] in f.base_name:
                fs.delete_file(f.path)


class WarcReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.path = options["path"]
        self.columns = schema.names
        self.wanted: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters: list) -> Iterator:
        """Equality on record type, page id and digest is decided on the headers."""
        for f in filters:
            column = f.attribute[0] if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 else None
            if column in ("record_type", "page_id", "payload_digest"):
                values = f.value if isinstance(f, In) else (f.value,)
                self.wanted.append((column, frozenset(values)))
            else:
                yield f

    def partitions(self) -> list[FileRange]:
        fs, folder = file_system(self.path)
        out = []
        for f in sorted(fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)),
                        key=lambda f: f.path):
            if f.base_name.endswith(".warc.gz") and not f.base_name.startswith("_"):
                marks = [0, f.size]
                if fs.get_file_info(f.path + ".ranges").type == pafs.FileType.File:
                    with fs.open_input_stream(f.path + ".ranges") as r:
                        marks = [int(x) for x in r.read().split(b",")]
                out += [FileRange(f.path, a, b) for a, b in zip(marks, marks[1:])]
        return out

    def read(self, part: FileRange) -> Iterator[pa.RecordBatch]:
        if not isinstance(part, FileRange):
            return
        fs, _ = file_system(self.path)
        schema = pa.schema([(n, TYPES[n]) for n in self.columns])
        rows: list[dict] = []
        size = 0
        with fs.open_input_file(part.path) as f:
            data = Inflated(f, part.start, part.end)
            while data.starts():
                h = parse_headers(data.take(data.head()))
                length, kind = int(h["content-length"]), h.get("warc-type")
                row = {"page_id": number(h.get("x-page-id")), "record_type": kind,
                       "payload_digest": digest_of(h.get("warc-payload-digest")),
                       "refers_to": number(h.get("x-refers-to-page"))}
                if any(row[c] not in values for c, values in self.wanted):
                    data.skip(length + 4)  # the payload is not inflated
                    continue
                http = kind == "response" and h.get("content-type", "").startswith("application/http")
                before = data.head(length) if http and ("payload" in self.columns or "x-payload-length" not in h) else 0
                known = number(h.get("x-payload-length"))
                row["payload_bytes"] = length - before if known is None else known
                row["payload"] = None
                if "payload" in self.columns and kind != "revisit":
                    row["payload"] = data.take(length)[before:]
                    size += length
                    length = 0
                data.skip(length + 4)
                rows.append(row)
                if len(rows) >= 4096 or size > 8 << 20:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


TYPES = {"page_id": pa.int64(), "record_type": pa.string(), "payload_digest": pa.string(),
         "payload_bytes": pa.int64(), "refers_to": pa.int64(), "payload": pa.binary()}


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return WarcReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def records(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
            min_revisit: int = MIN_REVISIT, url_col: str = "url") -> DataFrame:
    """One WARC record a row.  Of equal payloads of at least ``min_revisit`` bytes those with
    the largest page id are responses.  Only ids, urls and digests are grouped and joined by
    digest; payloads meet their verdict by (page id, digest), so a hot payload is spread evenly.
    A table without ``url_col`` has no target URIs."""
    url = F.col(f"`{url_col}`").cast("string") if url_col in pages.columns else F.lit(None).cast("string")
    p = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), url.alias("target_uri"),
                     F.encode(F.coalesce(F.col(f"`{html_col}`"), F.lit("")), "UTF-8").alias("payload"))
    p = (p.withColumn("payload_digest", F.sha1("payload"))
         .withColumn("payload_bytes", F.length("payload").cast("long")))
    ids = (p.where(F.col("payload_bytes") >= min_revisit)
           .groupBy(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest"))
           .agg(F.min("target_uri").alias("_uri")))
    first = (ids.groupBy(F.col("_digest").alias("_d")).agg(F.max("_id").alias("_page"), F.count("*").alias("_n"),
                                                           F.max_by("_uri", "_id").alias("_page_uri"))
             .where("_n > 1"))
    again = (ids.join(first, F.col("_digest") == F.col("_d"))
             .where(~F.col("_id").eqNullSafe(F.col("_page"))).select("_id", "_digest", "_page", "_page_uri"))
    revisit = F.col("_digest").isNotNull()
    return (p.join(again, F.col("page_id").eqNullSafe(F.col("_id"))
                   & (F.col("payload_digest") == F.col("_digest")), "left")
            .select("page_id", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                    "payload_digest", "payload_bytes", F.col("_page").alias("refers_to"),
                    F.when(~revisit, F.col("payload")).alias("payload"), "target_uri",
                    F.col("_page_uri").alias("refers_to_uri")))


def write(pages: DataFrame, path: str, date: str = DATE, **names) -> None:
    register(pages.sparkSession)
    records(pages, **names).write.format("warc").option("date", date).mode("append").save(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    register(spark)
    return spark.read.format("warc").load(path)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the archives to the shared folder, read them back, and take size and digest of
    responses from the payload that was read, of revisits from the headers."""
    spark = pages.sparkSession
    path = scratch(spark, "warc")
    write(pages, path)
    back = read(spark, path)
    has = F.col("record_type") == "response"
    return back.select(
        "page_id",
        F.when(has, F.coalesce(F.length("payload"), F.lit(0)).cast("long"))
        .otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(has, F.sha1(F.coalesce(F.col("payload"), F.lit(b""))))
        .otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", "refers_to")
