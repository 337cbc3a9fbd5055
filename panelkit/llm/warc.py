"""WARC archives as a Spark data source (operator 1).

Reading plans one partition for each stretch of a file, takes predicates on the record type and on header fields, looks
at a record's header first and goes past the payloads of records that are not wanted: in archives written here every
record is a gzip member that states its own length, so they are not even read. Writing gives every attempt of a task
files of its own; only files named by a committed manifest are read back, so lost executors and repeated tasks leave
no trace.
"""

from __future__ import annotations

import gzip
import io
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, IsNotNull, StringStartsWith,
    WriterCommitMessage,
)

from panelkit.functions.durable import settle

SCHEMA = (
    "record_type string, record_id string, target_uri string, date string, refers_to string, payload_digest string, "
    "payload_bytes long, payload binary"
)
#: columns that are header fields, and the fields
FIELDS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
    "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest", "payload_bytes": "X-Payload-Length",
}
#: fixed value: the profile of revisits of an equal payload
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
#: a file is closed beyond so many bytes; a partition reads about SPLIT bytes
FILE_BYTES, SPLIT = 256 << 20, 32 << 20
BATCH_BYTES, BATCH_ROWS = 8 << 20, 1000
MANIFEST = "_manifest-"
#: gzip header with an extra field: id "sl", its size, then the member's compressed and plain length
MEMBER = struct.Struct("<10sHBBHII")


def _filesystem(path: str):
    from pyarrow import fs

    found, inner = fs.FileSystem.from_uri(path if "://" in path or not path.startswith("file:") else "file://" + path[5:])
    return found, inner.rstrip("/")


def member(record: bytes, level: int = 6) -> bytes:
    """A gzip member that states its length, unless that is too large for the field."""
    packed = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = packed.compress(record) + packed.flush()
    trailer = struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    total = MEMBER.size + len(body) + len(trailer)
    if max(total, len(record)) >= 1 << 32:
        return b"\x1f\x8b\x08\x00" + bytes(4) + b"\x00\xff" + body + trailer
    head = b"\x1f\x8b\x08\x04" + bytes(4) + b"\x00\xff"
    return MEMBER.pack(head, 12, ord("s"), ord("l"), 8, total, len(record)) + body + trailer


def _clean(value: str) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(row: dict, date: str) -> bytes:
    """The bytes of a record. Null fields are left out; a null payload is empty, revisits have none."""
    kind = row.get("record_type") or "response"
    payload = row.get("payload") or b""
    payload = payload.encode() if isinstance(payload, str) else payload
    size = row.get("payload_bytes")
    size = len(payload) if size is None else size
    block, content = payload, None
    if kind in ("response", "revisit"):
        block, content = HTTP.format(size).encode() + (payload if kind == "response" else b""), "application/http;msgtype=response"
    fields = [("WARC-Type", kind), ("WARC-Record-ID", row.get("record_id") or f"<urn:uuid:{uuid.uuid4()}>"),
              ("WARC-Date", row.get("date") or date), ("WARC-Target-URI", row.get("target_uri")),
              ("WARC-Profile", PROFILE if kind == "revisit" else None), ("WARC-Refers-To", row.get("refers_to")),
              ("WARC-Payload-Digest", row.get("payload_digest") and "sha1:" + row["payload_digest"]),
              ("X-Payload-Length", str(size)), ("Content-Type", content), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {_clean(v)}\r\n" for k, v in fields if v is not None) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


@dataclass
class Stretch(InputPartition):
    file: str
    start: int = 0
    end: int | None = None


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options, schema, overwrite: bool):
        self.path, self.date = options["path"], options.get("date", "1970-01-01T00:00:00Z")
        self.level, self.overwrite = int(options.get("level", 6)), overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = _filesystem(self.path)
        fs.create_dir(folder, recursive=True)
        attempt = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        files: list[dict] = []
        out, size = None, 0
        for batch in iterator:
            for row in batch.to_pylist():
                if out is None or size >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    files.append({"name": f"{attempt}-{len(files)}.warc.gz", "starts": [0]})
                    out, size = fs.open_output_stream(f"{folder}/{files[-1]['name']}", compression=None), 0
                if size - files[-1]["starts"][-1] >= SPLIT:
                    files[-1]["starts"].append(size)
                data = member(record(row, self.date), self.level)
                out.write(data)
                size += len(data)
                files[-1]["size"] = size
        if out is not None:
            out.close()
        return Written(files)

    def commit(self, messages) -> None:
        fs, folder = _filesystem(self.path)
        fs.create_dir(folder, recursive=True)
        old = [f.path for f in _listed(fs, folder) if f.base_name.startswith(MANIFEST)] if self.overwrite else []
        with fs.open_output_stream(f"{folder}/{MANIFEST}{uuid.uuid4().hex}", compression=None) as out:
            out.write(json.dumps([f for m in messages if m for f in m.files]).encode())
        for path in old:
            fs.delete_file(path)

    def abort(self, messages) -> None:
        fs, folder = _filesystem(self.path)
        for m in messages:
            for f in m.files if m else []:
                fs.delete_file(f"{folder}/{f['name']}")


def _listed(fs, folder: str):
    from pyarrow.fs import FileSelector, FileType

    if fs.get_file_info(folder).type == FileType.File:
        return []
    return [f for f in fs.get_file_info(FileSelector(folder, allow_not_found=True)) if f.type == FileType.File]


class WarcReader(DataSourceReader):
    def __init__(self, options, schema):
        self.path = options["path"]
        self.columns = [f.name for f in schema.fields]
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        """Predicates on header fields are decided before a payload is looked at; the others stay with Spark."""
        for f in filters:
            column = getattr(f, "attribute", (None,))[0]
            if column not in FIELDS or len(f.attribute) > 1:
                yield f
            elif isinstance(f, EqualTo):
                self.tests.append((column, "in", {f.value}))
            elif isinstance(f, In):
                self.tests.append((column, "in", set(f.value)))
            elif isinstance(f, StringStartsWith):
                self.tests.append((column, "starts", f.value))
            elif isinstance(f, IsNotNull):
                self.tests.append((column, "known", None))
            else:
                yield f

    def partitions(self):
        fs, folder = _filesystem(self.path)
        files = _listed(fs, folder)
        manifests = [f for f in files if f.base_name.startswith(MANIFEST)]
        if not manifests:
            found = files or [fs.get_file_info(folder)]
            return [Stretch(f.path) for f in found if f.base_name.endswith((".warc", ".warc.gz"))]
        planned = []
        for m in manifests:
            with fs.open_input_stream(m.path, compression=None) as f:
                for file in json.loads(f.read()):
                    starts = file["starts"]
                    planned += [Stretch(f"{folder}/{file['name']}", a, b) for a, b in zip(starts, [*starts[1:], file["size"]])]
        return planned

    def wanted(self, head: dict) -> bool:
        for column, how, value in self.tests:
            own = head.get(column)
            if own is None or (how == "in" and own not in value) or (how == "starts" and not own.startswith(value)):
                return False
        return True

    def read(self, partition: Stretch | None):
        if partition is None:  # what Spark asks for where no partition was planned
            return
        fs, _ = _filesystem(self.path)
        types = {"payload_bytes": pa.int64(), "payload": pa.binary()}
        schema = pa.schema([(c, types.get(c, pa.string())) for c in self.columns])
        rows, size = [], 0
        with fs.open_input_file(partition.file) as f:
            for head, payload in records(f, self.wanted, "payload" in self.columns, partition.start, partition.end):
                rows.append({c: payload if c == "payload" else head.get(c) for c in self.columns})
                size += len(payload or b"")
                if size >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)


def _head(lines: list[bytes]) -> dict:
    """The columns of a record header; names in any case, continued lines joined, the digest without its algorithm."""
    fields: dict[str, str] = {}
    last = None
    for line in lines[1:]:
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in (" ", "\t") and last:
            fields[last] += " " + text.strip()
        elif ":" in text:
            name, value = text.split(":", 1)
            last = name.strip().lower()
            fields[last] = value.strip()
    head: dict = {c: fields.get(f.lower()) for c, f in FIELDS.items()}
    if head["payload_digest"]:
        head["payload_digest"] = head["payload_digest"].split(":", 1)[-1]
    size = head["payload_bytes"]
    head["payload_bytes"] = int(size) if size and size.isascii() and size.isdigit() and len(size) < 19 else None
    length = fields.get("content-length") or ""
    head["_length"] = int(length) if length.isascii() and length.isdigit() else 0
    head["_http"] = (fields.get("content-type") or "").startswith("application/http")
    return head


def _payload(head: dict, block: bytes) -> bytes | None:
    """A record's payload: what follows the HTTP header, or the whole block of other records; revisits have none."""
    if head["record_type"] == "revisit":
        return None
    return block.partition(b"\r\n\r\n")[2] if head["_http"] else block


def records(file, wanted, payloads: bool, start: int = 0, end: int | None = None):
    """Header columns and payload (null if not asked for) of the wanted records of a file or a stretch of it."""
    file.seek(start)
    first = file.read(MEMBER.size)
    file.seek(start)
    if first[:3] == b"\x1f\x8b\x08":
        if len(first) == MEMBER.size and first[3] & 4 and first[12:14] == b"sl":
            yield from _members(file, wanted, payloads, start, end)
            return
        file = gzip.GzipFile(fileobj=file)
    yield from _plain(file, wanted, payloads)


def _members(file, wanted, payloads, at, end):
    """Records that are gzip members of stated length: only their beginning is inflated if they are not wanted."""
    size = file.size() if hasattr(file, "size") else None
    end = size if end is None else end
    while end is None or at < end:
        file.seek(at)
        data = file.read(4096)
        if not data:
            return
        if data[3] & 4 == 0 or data[12:14] != b"sl":  # one too large to state its length
            file.seek(at)
            inflated = gzip.GzipFile(fileobj=file)
            yield from _plain(inflated, wanted, payloads)
            return
        length = MEMBER.unpack(data[:MEMBER.size])[5]
        inflate = zlib.decompressobj(-15)
        begun = inflate.decompress(data[MEMBER.size:length], 65536)
        while b"\r\n\r\n" not in begun and not inflate.eof:  # a header of any length
            rest = inflate.unconsumed_tail or file.read(4096)
            if not rest:
                break
            begun += inflate.decompress(rest, 65536)
        top, _, _ = begun.partition(b"\r\n\r\n")
        head = _head(top.split(b"\r\n"))
        if wanted(head):
            payload = None
            if payloads:
                file.seek(at)
                whole = zlib.decompress(file.read(length)[MEMBER.size:-8], -15)
                offset = len(top) + 4
                payload = _payload(head, whole[offset:offset + head["_length"]])
            yield head, payload
        at += length


def _plain(file, wanted, payloads):
    """Records one after the other in a plain or inflated stream; unwanted blocks are skipped."""
    stream = file if hasattr(file, "readline") and hasattr(file, "peek") else io.BufferedReader(_Raw(file), 1 << 16)
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            continue
        lines = [line]
        while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
            lines.append(line)
        head = _head(lines)
        if wanted(head) and payloads:
            yield head, _payload(head, stream.read(head["_length"]))
            continue
        if wanted(head):
            yield head, None
        left = head["_length"]
        while left > 0 and (skipped := stream.read(min(left, 1 << 20))):
            left -= len(skipped)


class _Raw(io.RawIOBase):
    def __init__(self, file):
        self.file = file

    def readable(self):
        return True

    def readinto(self, buffer):
        data = self.file.read(len(buffer))
        buffer[:len(data)] = data
        return len(data)


class WarcSource(DataSource):
    """spark.read.format("warc").load(folder or file), df.write.format("warc").mode("append").save(folder)."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA if self.options.get("payload", "true") == "true" else SCHEMA.rpartition(",")[0]

    def reader(self, schema):
        return WarcReader(dict(self.options), schema)

    def writer(self, schema, overwrite):
        return WarcWriter(dict(self.options), schema, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


#: payloads of at least so many bytes are stored once
REVISIT_BYTES = 1000


def page_records(pages: DataFrame) -> DataFrame:
    """Records of pages (page_id, url, html): of equal payloads of REVISIT_BYTES or more the one of the largest page_id
    is a response, the others revisit it; all smaller ones are responses.

    Payloads are told apart by SHA-1 and length. Rows that repeat the largest id are responses each; rows without an id
    revisit the largest one, or are responses if none has an id. Which payloads repeat is found from their digests
    alone; that table is broadcast if it is small, else pages meet it by digest, where a hot one is split as a skewed
    join.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    known = pages.select("page_id", "url", payload.alias("payload")).withColumns(
        {"payload_digest": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long")}
    )
    repeated = settle(
        known.filter(F.col("payload_bytes") >= REVISIT_BYTES)
        .groupBy(F.col("payload_digest").alias("_digest"), F.col("payload_bytes").alias("_bytes"))
        .agg(F.count("*").alias("_n"), F.max("page_id").alias("_first")).filter("_n > 1 and _first is not null")
    )
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    again = F.col("_first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_first"))
    return known.join(repeated, F.expr("payload_digest = _digest and payload_bytes = _bytes"), "left").select(
        F.when(again, "revisit").otherwise("response").alias("record_type"), name("page_id").alias("record_id"),
        F.col("url").alias("target_uri"), F.when(again, name("_first")).alias("refers_to"), "payload_digest", "payload_bytes",
        F.when(~again, F.col("payload")).alias("payload"),
    )


def page_number(column: str):
    """The page_id in a record's name; null for other names."""
    return F.expr(f"try_cast(regexp_extract({column}, '^<urn:page:(-?[0-9]+)>$', 1) as bigint)")
