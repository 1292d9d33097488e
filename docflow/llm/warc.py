"""WARC archives as a PySpark data source: spark.read.format("warc") and df.write.format("warc").

Reading. One partition holds whole files, small files together, up to ``split_bytes``. Predicates on the columns
that headers give (record_type, record_id, target_uri, warc_date, refers_to, payload_digest, content_type) are
pushed into the reader. A record's headers are parsed first; where a predicate rejects them, or the schema asks
for no payload, the block is skipped undecoded: by a seek in a plain file, and in a gzip file whose members
state their length (as this writer's do) by a jump to the next member.

Writing. Records roll over into files of about ``file_bytes``; each file is written under a hidden name and gets
its own when the whole write commits, so that a repeated task leaves nothing that a reader sees.

Files are opened by pyarrow's file systems (local paths, file://, s3://, hdfs://, gs://), never by a local open().

Defined results: null header columns are left out; control characters and blanks in them are percent-encoded;
a null payload is empty; a revisit record stores no payload, only the digest and length of its response's; a
truncated last record ends its file; an empty folder or table gives no rows; unknown columns are ignored. A file that isn't
WARC, a content length that is no number or below zero, or damaged gzip bytes end the file there: the records before
stay, and a row with nothing but ``error`` follows, which names the file and the fault; it comes where the schema has error and
no predicate is pushed. With the option mode=failfast such a file fails the read instead.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StructType

from .common import shared_path, table

SCHEMA = "record_type string, record_id string, target_uri string, warc_date string, refers_to string, payload_digest string, content_type string, payload_bytes long, payload binary, error string"
_HEADER = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "warc_date": "warc-date", "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest", "content_type": "content-type"}
_KINDS = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
_LENGTH = "x-payload-length"
_HTTP_OK = b"HTTP/1.1 200 OK\r\n"
MIN_REVISIT_BYTES = 1000
_SLICE = 1 << 14


class _Bytes:
    """The bytes of a plain or gzip file in order, with a cheap skip."""

    def __init__(self, file: pa.NativeFile):
        self.file, self.at, self.raw, self.held, self.gone = file, 0, b"", bytearray(), 0
        self.size = file.size()
        self.file.seek(0)
        self.zipped = self._peek(2) == b"\x1f\x8b"
        self.inflate = None
        self.member_end = self.member_left = 0

    def _peek(self, n: int) -> bytes:
        while len(self.raw) < n and self.at < self.size:
            got = self.file.read(max(1 << 18, n - len(self.raw)))
            if not got:
                break
            self.raw += got
            self.at += len(got)
        return self.raw[:n]

    def _seek(self, to: int) -> None:
        have = self.at - len(self.raw)
        if have <= to <= self.at:
            self.raw = self.raw[to - have :]
        else:
            self.file.seek(to)
            self.raw, self.at = b"", to

    def _more(self) -> bool:
        if not self.zipped:
            got = self._peek(1 << 16)
            self.raw = self.raw[len(got) :]
            self.held += got
            return bool(got)
        while True:
            if self.inflate is None:
                head = self._peek(24)
                if len(head) < 18:
                    return False
                self.inflate = zlib.decompressobj(31)
                self.member_end = self.member_left = 0
                if head[3] & 4 and head[12:16] == b"sl\x08\0":
                    packed, plain = struct.unpack("<II", head[16:24])
                    if packed:
                        self.member_end, self.member_left = self.at - len(self.raw) + packed, plain
            if not self._peek(1):
                return False
            part = self.raw[:_SLICE]  # what a call leaves over is copied: a slice, not all that was read
            out = self.inflate.decompress(part, _SLICE if self.member_end else 1 << 18)
            left = self.inflate.unconsumed_tail or self.inflate.unused_data
            self.raw = left + self.raw[_SLICE:] if len(self.raw) > _SLICE else left
            if self.inflate.eof:
                self.inflate = None
            if self.member_end:
                self.member_left -= len(out)
            if out:
                self.held += out
                return True

    def until(self, mark: bytes) -> bytes | None:
        i = 0
        while (found := self.held.find(mark, i)) < 0:
            i = max(0, len(self.held) - len(mark) + 1)
            if not self._more():
                return None
        out = bytes(self.held[:found])
        del self.held[: found + len(mark)]
        return out

    def read(self, n: int) -> bytes:
        while len(self.held) < n and self._more():
            pass
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def skip(self, n: int) -> None:
        while n > len(self.held):
            n -= len(self.held)
            self.held.clear()
            if not self.zipped:
                self._seek(self.at - len(self.raw) + n)
                return
            if self.inflate is not None and self.member_end and n >= self.member_left:
                n -= self.member_left
                self._seek(self.member_end)
                self.inflate, self.member_end = None, 0
            elif not self._more():
                return
        del self.held[:n]


def records(file: pa.NativeFile, wanted, payloads: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """(headers with names in lower case, block or None) of the records whose headers are wanted."""
    stream = _Bytes(file)
    while (head := stream.until(b"\r\n\r\n")) is not None:
        version, *lines = head.decode("utf-8", "replace").lstrip("\r\n").split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError(f"not a WARC record: {version[:60]!r}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        length = headers.get("content-length", "0")
        if not (length.isascii() and length.isdigit() and len(length) < 19):
            raise ValueError(f"content length {length[:40]!r}")
        n = int(length)
        if not wanted(headers):
            stream.skip(n + 4)
        elif payloads:
            block = stream.read(n)
            if len(block) < n:
                return
            stream.skip(4)
            yield headers, block
        else:
            stream.skip(n + 4)
            yield headers, None


def _payload(headers: dict[str, str], block: bytes | None) -> bytes | None:
    if block is None or headers.get("warc-type") == "revisit":
        return None
    if headers.get("content-type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


@dataclass
class Files(InputPartition):
    paths: list[str]


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: StructType, split_bytes: int, failfast: bool = False):
        self.path, self.columns, self.split_bytes, self.failfast = path, [(f.name, f.dataType.simpleString()) for f in schema], split_bytes, failfast
        self.filters: list = []

    def pushFilters(self, filters):  # noqa: N802
        for f in filters:
            if isinstance(f, (EqualTo, In, IsNotNull, StringStartsWith, StringEndsWith, StringContains)) and len(f.attribute) == 1 and f.attribute[0] in _HEADER:
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[Files]:
        fs, root = pafs.FileSystem.from_uri(self.path)
        info = fs.get_file_info(root)
        if info.type == pafs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(root, recursive=True))
        found = sorted((f for f in found if f.type == pafs.FileType.File and f.base_name[0] not in "._"), key=lambda f: f.path)
        out: list[Files] = []
        room = 0
        for f in found:
            if not out or f.size > room:
                out.append(Files([]))
                room = self.split_bytes
            out[-1].paths.append(f.path)
            room -= f.size
        return out or [Files([])]

    def _wanted(self, headers: dict[str, str]) -> bool:
        for f in self.filters:
            value = headers.get(_HEADER[f.attribute[0]])
            if value is None:
                return False
            ok = True
            if isinstance(f, EqualTo):
                ok = value == f.value
            elif isinstance(f, In):
                ok = value in f.value
            elif isinstance(f, StringStartsWith):
                ok = value.startswith(f.value)
            elif isinstance(f, StringEndsWith):
                ok = value.endswith(f.value)
            elif isinstance(f, StringContains):
                ok = f.value in value
            if not ok:
                return False
        return True

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(self.path)
        names = [n for n, _ in self.columns]
        schema = pa.schema([(n, _KINDS[k]) for n, k in self.columns])
        need = "payload" in names
        rows: list[tuple] = []
        size = 0
        for path in partition.paths:
            with fs.open_input_file(path) as file:
                try:
                    for headers, block in records(file, self._wanted, need):
                        payload = _payload(headers, block)
                        rows.append(tuple(payload if n == "payload" else _length(headers, payload) if n == "payload_bytes" else headers.get(_HEADER[n]) if n in _HEADER else None for n in names))
                        size += len(payload or b"") + 200
                        if size > 8 << 20:
                            yield _batch(rows, schema)
                            rows, size = [], 0
                except (ValueError, zlib.error, struct.error) as e:
                    if self.failfast:
                        raise ValueError(f"{path}: {e}") from e
                    if "error" in names and not self.filters:
                        rows.append(tuple(f"{path}: {e}" if n == "error" else None for n in names))
        if rows:
            yield _batch(rows, schema)


def _length(headers: dict[str, str], payload: bytes | None) -> int | None:
    if headers.get(_LENGTH, "").isdigit():
        return int(headers[_LENGTH])
    return None if payload is None else len(payload)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, columns: list[str], gzip: bool, file_bytes: int):
        self.path, self.columns, self.gzip, self.file_bytes = path, columns, gzip, file_bytes

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(root, recursive=True)
        files: list[tuple[str, str]] = []
        out, size = None, 0
        for batch in iterator:
            for i in range(batch.num_rows):
                if out is None:
                    name = f"records-{uuid.uuid4().hex}.warc{'.gz' * self.gzip}"
                    files.append((f"{root}/_{name}", f"{root}/{name}"))
                    out, size = fs.open_output_stream(files[-1][0], compression=None), 0
                record = render({n: batch.column(n)[i].as_py() for n in self.columns if n in batch.schema.names})
                record = member(record) if self.gzip else record
                out.write(record)
                size += len(record)
                if size >= self.file_bytes:
                    out.close()
                    out = None
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages) -> None:
        fs, root = pafs.FileSystem.from_uri(self.path)
        fs.create_dir(root, recursive=True)
        for hidden, name in (f for m in messages if m for f in m.files):
            fs.move(hidden, name)

    def abort(self, messages) -> None:
        fs, _ = pafs.FileSystem.from_uri(self.path)
        for hidden, _name in (f for m in messages if m for f in m.files):
            if fs.get_file_info(hidden).type == pafs.FileType.File:
                fs.delete_file(hidden)


def _clean(value: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) <= 32 or ord(c) == 127 else c for c in value)


def render(row: dict) -> bytes:
    """A WARC record of a row of SCHEMA's columns."""
    kind, payload = row.get("record_type") or "response", row.get("payload") or b""
    http = kind in ("response", "revisit")
    length = row.get("payload_bytes")
    block = b"" if kind == "revisit" else payload
    if http:
        block = _HTTP_OK + f"Content-Type: {_clean(row.get('content_type') or 'text/html')}\r\nContent-Length: {len(payload) if length is None else length}\r\n\r\n".encode() + block
    lines = ["WARC/1.1", f"WARC-Type: {_clean(kind)}"]
    for name, header in (("record_id", "WARC-Record-ID"), ("target_uri", "WARC-Target-URI"), ("warc_date", "WARC-Date"), ("refers_to", "WARC-Refers-To"), ("payload_digest", "WARC-Payload-Digest")):
        if row.get(name) is not None:
            lines.append(f"{header}: {_clean(row[name])}")
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    lines += [f"X-Payload-Length: {len(payload) if length is None else length}", f"Content-Type: {'application/http;msgtype=response' if http else _clean(row.get('content_type') or 'application/octet-stream')}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member that states its packed and plain length in an extra field."""
    deflate = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = deflate.compress(data) + deflate.flush()
    total = 24 + len(body) + 8
    sizes = (total, len(data)) if max(total, len(data)) < 1 << 32 else (0, 0)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x0c\0sl\x08\0" + struct.pack("<II", *sizes) + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


class WarcSource(DataSource):
    """Options: path; split_bytes, mode (read); gzip, file_bytes (write)."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def _path(self) -> str:
        path = self.options["path"]
        return path if "://" in path else "file://" + path.removeprefix("file:")

    def reader(self, schema: StructType) -> WarcReader:
        return WarcReader(self._path(), schema, int(self.options.get("split_bytes", 64 << 20)), self.options.get("mode", "permissive").lower() == "failfast")

    def writer(self, schema: StructType, overwrite: bool) -> WarcWriter:
        if overwrite:
            fs, root = pafs.FileSystem.from_uri(self._path())
            if fs.get_file_info(root).type == pafs.FileType.Directory:
                fs.delete_dir(root)
        return WarcWriter(self._path(), schema.names, self.options.get("gzip", "true") == "true", int(self.options.get("file_bytes", 32 << 20)))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def page_records(pages: DataFrame) -> DataFrame:
    """A record per page (page_id, url, html): of equal payloads of MIN_REVISIT_BYTES or more the one with the
    largest page_id is the response and the others revisit it. Rows that share that page_id are all responses,
    and a null page_id counts as the smallest; where all are null, all are responses."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("target_uri"), F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    p = p.withColumns({"payload_digest": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long")})
    repeated = p.filter(F.col("payload_bytes") >= MIN_REVISIT_BYTES).groupBy(F.col("payload_digest").alias("digest")).agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("target")).filter("n > 1 and target is not null").drop("n")
    p = p.join(repeated, F.col("payload_digest") == F.col("digest"), "left")
    revisit = F.col("target").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("target"))
    name = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    return p.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        name(F.col("page_id")).alias("record_id"),
        "target_uri",
        F.lit("2000-01-01T00:00:00Z").alias("warc_date"),
        F.when(revisit, name(F.col("target"))).alias("refers_to"),
        F.concat(F.lit("sha1:"), "payload_digest").alias("payload_digest"),
        F.lit("text/html").alias("content_type"),
        "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )


def pages_of(archive_path: str, spark: SparkSession) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record of archives of page_records.

    Responses are read with their payloads, and their length and digest are those of the bytes read; revisits are read
    by a pushed predicate without any payload, and take both from the response that they refer to, if it agrees with
    the digest in their own headers; else (a response that is missing or isn't the same) they keep the headers'."""
    number = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    archive = spark.read.format("warc")
    plain = archive.schema("record_type string, record_id string, payload binary").load(archive_path).filter("record_type = 'response'")
    responses = plain.select("record_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"))
    again = archive.schema("record_type string, record_id string, refers_to string, payload_digest string, payload_bytes long").load(archive_path).filter("record_type = 'revisit'")
    revisits = again.select("record_id", "refers_to", F.regexp_replace("payload_digest", "^sha1:", "").alias("stated"), F.col("payload_bytes").alias("stated_bytes"))
    there = responses.select(F.col("record_id").alias("target"), F.col("payload_bytes").alias("found_bytes"), F.col("payload_digest").alias("found")).dropDuplicates(["target", "found"])
    told = revisits.join(there, (F.col("refers_to") == F.col("target")) & (F.col("stated") == F.col("found")), "left")
    same = responses.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    return same.unionByName(told.select(number("record_id").alias("page_id"), F.coalesce("found_bytes", "stated_bytes").alias("payload_bytes"), F.coalesce("found", "stated").alias("payload_digest"), F.lit("revisit").alias("record_type"), number("refers_to").alias("refers_to")))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark)
    path = shared_path(spark, "warc")
    page_records(table(spark, sf_dir, "pages")).write.format("warc").mode("append").save(path)
    return pages_of(path, spark)


OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM p),
t AS (SELECT payload_digest AS digest, max(page_id) AS target FROM q WHERE payload_bytes >= 1000 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN target > page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN target > page_id THEN target END AS refers_to
FROM q LEFT JOIN t ON payload_digest = digest
"""
