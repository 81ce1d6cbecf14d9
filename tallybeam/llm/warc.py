"""WARC archives: a PySpark Python data source that writes and reads them.

Reading: partitions() plans runs of files of about SPLIT_BYTES each; predicates on the record type and other named headers are pushed down; a record's
headers are parsed first, and the payload of a record that the predicates reject, or that the schema does not ask for, is
neither inflated nor decoded: the reader seeks past it, by Content-Length in plain archives and by the skip
length that the writer leaves in each gzip member ("sl" extra field); members without one are inflated and discarded.

Writing: one gzip member per record, files of FILE_BYTES at most. Tasks write under hidden names that carry the write's number, and on commit the driver renames the
files of the attempts that succeeded, several at a time, and deletes the write's other ones, so retries and lost executors leave no records behind.
Files are reached by pyarrow.fs, so any store that has a URI there can hold archives.

archive() writes a response record per page, or a revisit record where an equal payload of LEAST_BYTES or more belongs to
a smaller page_id. Defined results: null html is an empty payload; null page_ids count as larger than all others, and rows that
repeat the first page_id of a payload are responses too. Null urls have no target. Control characters and spaces in a url are percent-encoded in the header.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, WriterCommitMessage
from pyspark.sql.types import StructType

from tallybeam.llm.common import materialise, new_path, split

LEAST_BYTES = 100
FILE_BYTES, SPLIT_BYTES, WINDOW, BATCH_BYTES = 256 << 20, 64 << 20, 1 << 20, 4 << 20
#: Files that the driver renames at once.
MOVES = 32
SCHEMA = "record_type string, record_id string, date string, target_uri string, payload_digest string, refers_to string, content_type string, content_length long, headers map<string,string>, payload binary"
#: Columns that are a named header each.
NAMED = {"record_type": "warc-type", "record_id": "warc-record-id", "date": "warc-date", "target_uri": "warc-target-uri", "payload_digest": "warc-payload-digest", "refers_to": "warc-refers-to", "content_type": "content-type"}


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI or an absolute path."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return pafs.FileSystem.from_uri(path)


# --- records -------------------------------------------------------------------------------------------------


def record(headers: dict[str, str], block: bytes) -> bytes:
    """One WARC/1.1 record."""
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 1) -> bytes:
    """A gzip member whose "sl" extra field has its whole length and the length of its content (modulo 2^32)."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    length = 10 + 2 + 12 + len(body) + 8
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H2sHII", 12, b"sl", 8, length & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return head + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def parse_headers(head: bytes) -> dict[str, str]:
    """Lower-case names to values; the first line is the version. Continued lines are joined."""
    out: dict[str, str] = {}
    name = ""
    for line in head.decode(errors="replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            name = name.strip().lower()
            out[name] = value.strip()
    return out


def http_payload(block: bytes) -> bytes:
    """What follows the HTTP headers."""
    return block.partition(b"\r\n\r\n")[2]


class Window:
    """Reads of a file through one buffer."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.size, self.start, self.data = file, file.size(), 0, b""

    def get(self, at: int, n: int) -> bytes:
        if at < self.start or at + n > self.start + len(self.data):
            self.file.seek(at)
            self.start, self.data = at, self.file.read(max(n, WINDOW))
        return self.data[at - self.start : at - self.start + n]


class _Plain:
    """A record of an uncompressed archive at an offset: head() first, then body() or end()."""

    def __init__(self, window: Window, at: int):
        self.window, self.at = window, at

    def head(self) -> bytes:
        step = 4096
        while (cut := (data := self.window.get(self.at, step)).find(b"\r\n\r\n")) < 0:
            if len(data) < step:
                raise ValueError(f"a WARC record without an end of headers at byte {self.at}")
            step *= 2
        self.body_at = self.at + cut + 4
        return data[:cut]

    def body(self, n: int) -> bytes:
        return self.window.get(self.body_at, n)

    def end(self, n: int) -> int:
        return self.body_at + n + 4


class _Gzip:
    """The same for a record that is a gzip member."""

    def __init__(self, window: Window, at: int):
        self.window, self.at, self.next, self.skip = window, at, at, None
        fixed = window.get(at, 12)
        if fixed[:3] != b"\x1f\x8b\x08":
            raise ValueError(f"neither a gzip member nor a WARC record at byte {at}")
        if fixed[3] & 4:
            extra = window.get(at + 12, struct.unpack("<H", fixed[10:12])[0])
            while len(extra) >= 4:
                name, n = struct.unpack("<2sH", extra[:4])
                if name == b"sl" and n == 8:
                    self.skip = struct.unpack("<I", extra[4:8])[0]
                extra = extra[4 + n :]
        self.inflate, self.out = zlib.decompressobj(31), b""

    def _more(self, least: int) -> bool:
        """Inflate at least so many bytes more, unless the member ends."""
        want = len(self.out) + least
        parts = [self.out]
        have = len(self.out)
        while have < want and not self.inflate.eof:
            if not (data := self.window.get(self.next, min(1 << 16, max(1024, least)))):
                break
            parts.append(self.inflate.decompress(data))
            have += len(parts[-1])
            self.next += len(data) - len(self.inflate.unused_data)
        self.out = b"".join(parts)
        return have >= want

    def head(self) -> bytes:
        while (cut := self.out.find(b"\r\n\r\n")) < 0:
            if not self._more(512) and self.out.find(b"\r\n\r\n") < 0:
                raise ValueError(f"a WARC record without an end of headers at byte {self.at}")
        self.body_at = cut + 4
        return self.out[:cut]

    def body(self, n: int) -> bytes:
        if (need := self.body_at + n - len(self.out)) > 0:
            self._more(need)
        return self.out[self.body_at : self.body_at + n]

    def end(self, n: int) -> int:
        if self.skip is not None:
            return self.at + self.skip
        while not self.inflate.eof:
            self.out = b""
            if not self._more(1 << 16) and not self.inflate.eof:
                raise ValueError(f"a gzip member without an end at byte {self.at}")
        return self.next


def records(file: pa.NativeFile, wanted, with_payload: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """Headers and payload of each record whose headers are wanted; other payloads are skipped undecoded."""
    window, at = Window(file), 0
    while at < window.size:
        mark = window.get(at, 5)
        if mark.strip() == b"":
            at += len(mark)
            continue
        while mark[:1] in b"\r\n":
            at, mark = at + 1, mark[1:]
        found = _Plain(window, at) if mark.startswith(b"WARC/"[: len(mark)]) else _Gzip(window, at)
        headers = parse_headers(found.head())
        n = int(headers.get("content-length", 0))
        if wanted(headers):
            payload = found.body(n) if with_payload else None
            if payload is not None and headers.get("content-type", "").startswith("application/http"):
                payload = http_payload(payload)
            yield headers, payload
        at = found.end(n)


# --- data source ---------------------------------------------------------------------------------------------


@dataclass
class Files(InputPartition):
    """Whole files that one task reads."""

    paths: list[str]

    def __init__(self, paths: list[str]):
        super().__init__(None)
        self.paths = paths


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType):
        self.path, self.columns = path, schema.names
        self.predicates: list[tuple[str, frozenset]] = []

    def pushFilters(self, filters: list[Filter]):
        """Equality and membership of named headers are decided here; the rest is left to Spark."""
        column = lambda f: f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
        decided = [f for f in filters if column(f) in NAMED and isinstance(f, EqualTo | In)]
        self.predicates = [(NAMED[column(f)], frozenset([f.value] if isinstance(f, EqualTo) else f.value)) for f in decided]
        known = {column(f) for f in decided}
        return [f for f in filters if f not in decided and not (isinstance(f, IsNotNull) and column(f) in known)]

    def partitions(self) -> list[Files]:
        fs, path = open_fs(self.path)
        info = fs.get_file_info(path)
        found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(path, recursive=True))
        files = sorted((f.path, f.size) for f in found if f.type == pafs.FileType.File and not re.search(r"/[._][^/]*$", f.path))
        out: list[list[str]] = []
        room = 0
        for p, size in files:
            if not out or size > room:
                out.append([])
                room = SPLIT_BYTES
            out[-1].append(p)
            room -= size
        return [Files(p) for p in out]

    def read(self, partition: Files | None) -> Iterator[pa.RecordBatch]:
        fs, _ = open_fs(self.path)
        wanted = lambda h: all(h.get(name) in values for name, values in self.predicates)
        held, size = [], 0
        for path in partition.paths if partition else []:
            with fs.open_input_file(path) as file:
                for headers, payload in records(file, wanted, "payload" in self.columns):
                    held.append((headers, payload))
                    size += 1024 + len(payload or b"")
                    if size >= BATCH_BYTES:
                        yield self.batch(held)
                        held, size = [], 0
        if held:
            yield self.batch(held)

    def batch(self, found: list[tuple[dict[str, str], bytes | None]]) -> pa.RecordBatch:
        arrays = []
        for c in self.columns:
            if c == "payload":
                arrays.append(pa.array([p for _, p in found], pa.binary()))
            elif c == "headers":
                arrays.append(pa.array([list(h.items()) for h, _ in found], pa.map_(pa.string(), pa.string())))
            elif c == "content_length":
                arrays.append(pa.array([int(h.get("content-length", 0)) for h, _ in found], pa.int64()))
            else:
                arrays.append(pa.array([h.get(NAMED[c]) for h, _ in found], pa.string()))
        return pa.RecordBatch.from_arrays(arrays, self.columns)


class WarcWriter(DataSourceArrowWriter):
    """Rows (record_type, record_id, date, target_uri, payload_digest, refers_to, headers, payload); revisits have no block."""

    def __init__(self, path: str, file_bytes: int = FILE_BYTES):
        self.path, self.file_bytes, self.number = path, file_bytes, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = open_fs(self.path)
        fs.create_dir(root, recursive=True)
        files: list[str] = []
        stream, size = None, 0
        try:
            for batch in iterator:
                for row in batch.to_pylist():
                    if stream is None or size >= self.file_bytes:
                        if stream:
                            stream.close()
                        files.append(f"{self.number}-{uuid.uuid4().hex}.warc.gz")
                        stream, size = fs.open_output_stream(f"{root}/.{files[-1]}", compression=None), 0
                    data = member(self.record(row))
                    stream.write(data)
                    size += len(data)
        finally:
            if stream:
                stream.close()
        return Written(files)

    @staticmethod
    def record(row: dict) -> bytes:
        kind = row["record_type"]
        named = [("WARC-Type", kind), ("WARC-Record-ID", row["record_id"]), ("WARC-Date", row["date"]), ("WARC-Target-URI", row["target_uri"]), ("WARC-Payload-Digest", row["payload_digest"]), ("WARC-Refers-To", row["refers_to"])]
        headers = {k: v for k, v in named if v is not None} | dict(row["headers"] or [])
        if kind == "revisit":
            headers["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
            return record(headers, b"")
        payload = row["payload"] or b""
        headers["Content-Type"] = "application/http; msgtype=response"
        return record(headers, f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode() + payload)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = open_fs(self.path)
        with ThreadPoolExecutor(MOVES) as pool:
            list(pool.map(lambda name: fs.move(f"{root}/.{name}", f"{root}/{name}"), (f for m in messages if m for f in m.files)))
        self.clean()

    def abort(self, messages: list[Written | None]) -> None:
        self.clean()

    def clean(self) -> None:
        """Delete this write's hidden files."""
        fs, root = open_fs(self.path)
        for info in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
            if info.base_name.startswith(f".{self.number}-"):
                fs.delete_file(info.path)


class WarcSource(DataSource):
    """spark.read.format("warc").load(path); a schema with some of SCHEMA's columns reads only those."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self.options["path"], schema)

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only appended to")
        return WarcWriter(self.options["path"], int(self.options.get("file_bytes", FILE_BYTES)))


def register(spark: SparkSession) -> None:
    """Make the format known and let Spark hand predicates to Python data sources: without spark.sql.python.filterPushdown.enabled, which is set here, they are filtered after decoding."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


# --- pages ---------------------------------------------------------------------------------------------------


def page_records(pages: DataFrame, least_bytes: int = LEAST_BYTES, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """A record per page, ready for the writer.

    Only (digest, page_id) is gathered to find the first page of equal payloads. Pages whose payload surely is no other's, told by a broadcast map of hashes,
    need no join; the others are joined with the groups of two or more.
    """
    text = F.coalesce(F.col("html"), F.lit(""))
    body = text.cast("binary")
    known = [F.sha2(body, 256).alias("digest"), F.octet_length(body).cast("long").alias("bytes")]
    sized = pages.select(F.col("page_id").cast("long"), F.xxhash64(text).alias("hash"), *known).filter(F.col("bytes") >= least_bytes)
    groups = sized.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"), F.min("hash").alias("hash")).filter("n > 1 and first is not null")
    groups = materialise(groups.select("digest", "first", "hash"), "payload-groups")
    single, several = (p.select(F.col("page_id").cast("long"), "url", body.alias("payload"), *known) for p in split(pages, groups.select("hash"), F.xxhash64(text)))
    rows = single.withColumn("first", F.lit(None).cast("long")).unionByName(several.join(groups.drop("hash"), "digest", "left"))
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    urn = lambda c: F.concat(F.lit("<urn:x-page:"), c.cast("string"), F.lit(">"))
    encoded = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    named = lambda k, v: F.when(v.isNotNull(), F.struct(F.lit(k).alias("k"), v.cast("string").alias("v")))
    return rows.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.coalesce(urn(F.col("page_id")), F.concat(F.lit("<urn:sha256:"), "digest", F.lit(">"))).alias("record_id"),
        F.lit(date).alias("date"),
        encoded.alias("target_uri"),
        F.concat(F.lit("sha256:"), "digest").alias("payload_digest"),
        F.when(revisit, urn(F.col("first"))).alias("refers_to"),
        F.map_from_entries(F.array_compact(F.array(named("X-Page-Id", F.col("page_id")), named("X-Payload-Length", F.col("bytes"))))).alias("headers"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def archive(pages: DataFrame, path: str, least_bytes: int = LEAST_BYTES) -> None:
    """Write pages to WARC files at path."""
    register(pages.sparkSession)
    page_records(pages, least_bytes).write.format("warc").mode("append").save(path)


def read(spark: SparkSession, path: str, schema: str = SCHEMA) -> DataFrame:
    register(spark)
    return spark.read.format("warc").schema(schema).load(path)


def round_trip(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the archives that hold the pages, as read back.

    Responses and revisits are two scans with their record type pushed down; the scan of revisits asks for no payload, so none is inflated.
    """
    path = new_path(pages.sparkSession, "warc")
    archive(pages, path)
    page = F.element_at("headers", "x-page-id").cast("long").alias("page_id")
    first = F.regexp_extract("refers_to", "<urn:x-page:(-?[0-9]+)>", 1).cast("long").alias("refers_to")
    responses = read(pages.sparkSession, path, "record_type string, headers map<string,string>, payload binary").filter("record_type = 'response'")
    responses = responses.select(page, F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"))
    revisits = read(pages.sparkSession, path, "record_type string, payload_digest string, refers_to string, headers map<string,string>").filter("record_type = 'revisit'")
    revisits = revisits.select(page, F.element_at("headers", "x-payload-length").cast("long").alias("payload_bytes"), F.substring("payload_digest", 8, 64).alias("payload_digest"), "record_type", first)
    return responses.unionByName(revisits)
