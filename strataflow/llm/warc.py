"""WARC archives with a two-level capture index.

Pages are sorted by their reversed-host key and written as WARC files, one per task; beside each
file lies its index: the sorted capture lines in compressed blocks of ``BLOCK_LINES``, and a sparse
directory that holds every block's first key. Pages are read back by key: binary search in
the directory, a range read of one block, binary search in the block, a range read of the record.

Files are written through ``pyarrow.fs`` into the shared folder. Every task attempt writes files of its
own name and reports them only when they are complete, so lost executors and repeated tasks leave at
most files that no index names.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import json
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.tokens import bound_batches
from strataflow.storage import materialize, new_path

BLOCK_LINES = 512
# A payload of so many bytes or more that was captured before is a revisit.
MIN_REVISIT_BYTES = 0
# An archive is closed when it has so many bytes; the task goes on with another.
ARCHIVE_BYTES = 1 << 30
GZIP_LEVEL = 9

WARC_DATE = "2025-01-01T00:00:00Z"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def host_key(url: str | None) -> str:
    """Key that sorts pages of a site together: reversed host, port, path and query; no scheme, ``www``, fragment."""
    try:
        parts = urlsplit((url or "").strip())
        host, port = (parts.hostname or ""), parts.port
    except ValueError:
        return f"){(url or '').strip()}"
    labels = host.removeprefix("www.").split(".")
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(labels)) + (f":{port}" if port else "") + ")" + path


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(value: object) -> str:
    """A header value on one line; anything else is percent-encoded."""
    return "".join(c if " " <= c <= "~" and c != "%" else "".join(f"%{b:02X}" for b in c.encode("utf-8")) for c in str(value))


def _record(page_id: int | None, url: str | None, size: int, digest: str, payload: bytes, extra: list[str]) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if extra else 'response'}",
        f"WARC-Record-ID: <{_record_id(page_id, digest)}>",
        f"WARC-Date: {WARC_DATE}", f"WARC-Target-URI: {_header(url or '')}",
        "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Page-ID: {'' if page_id is None else page_id}", *extra, f"Content-Length: {len(http) + len(payload)}",
    ]
    return gzip.compress("\r\n".join(lines).encode("ascii") + b"\r\n\r\n" + http + payload + b"\r\n\r\n", GZIP_LEVEL, mtime=0)


def _record_id(page_id: int | None, digest: str) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}"


def response_record(page_id: int | None, url: str | None, payload: bytes) -> bytes:
    """One gzip member with the whole payload."""
    return _record(page_id, url, len(payload), payload_digest(payload), payload, [])


def revisit_record(page_id: int | None, url: str | None, size: int, digest: str, refers_to: int) -> bytes:
    """One gzip member whose block is the HTTP header alone, with the length of the payload seen before."""
    return _record(page_id, url, size, digest, b"", [
        f"WARC-Refers-To: <{_record_id(refers_to, digest)}>", f"WARC-Refers-To-Page-ID: {refers_to}",
        f"WARC-Profile: {_REVISIT_PROFILE}"])


def parse_record(member: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """WARC header fields, HTTP header and payload of a gzip member."""
    raw = zlib.decompress(member, wbits=31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "")
                  for line in head.decode("ascii").split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, http, payload


class _Archive:
    """One WARC file and its index, written in key order."""

    def __init__(self, folder: str, name: str):
        self.fs, self.root = fs.FileSystem.from_uri(folder)
        self.fs.create_dir(self.root, recursive=True)
        self.name = name
        self.out = self.fs.open_output_stream(f"{self.root}/{name}.warc.gz", compression=None)
        self.size, self.lines, self.blocks, self.directory, self.index_size = 0, [], io.BytesIO(), [], 0
        self.index = self.fs.open_output_stream(f"{self.root}/{name}.cdx.gz", compression=None)

    def add(self, key: str, order: int, record: bytes) -> None:
        self.out.write(record)
        self.lines.append((key, order, self.size, len(record)))
        self.size += len(record)
        if len(self.lines) >= BLOCK_LINES:
            self._close_block()

    def _close_block(self) -> None:
        block = gzip.compress("\n".join(json.dumps(x) for x in self.lines).encode(), GZIP_LEVEL, mtime=0)
        self.directory.append((*self.lines[0][:2], self.index_size, len(block)))
        self.index.write(block)
        self.index_size += len(block)
        self.lines = []

    def close(self) -> None:
        if self.lines:
            self._close_block()
        self.out.close()
        self.index.close()
        with self.fs.open_output_stream(f"{self.root}/{self.name}.idx", compression=None) as out:
            out.write(json.dumps(self.directory).encode())


_CAPTURES = pa.schema([("name", pa.string()), ("key", pa.string()), ("order", pa.int64()), ("bytes", pa.int64())])

# Compressed records that one task reads back; captures themselves are too small to tell a task's work.
READ_BYTES = 8 << 20


def _write(folder: str):
    """Rows sorted by key into archives; reports every capture when its archive is complete."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, keys, sizes = None, [], []

        def closed() -> pa.RecordBatch:
            archive.close()
            return pa.record_batch(
                [pa.array([archive.name] * len(keys)), pa.array(keys), pa.array(range(len(keys)), pa.int64()),
                 pa.array(sizes, pa.int64())], schema=_CAPTURES)

        for batch in batches:
            rows = zip(*(batch[c].to_pylist() for c in ("key", "page_id", "url", "digest", "size", "member", "refers_to")))
            for key, page_id, url, digest, size, member, refers_to in rows:
                if archive is None:
                    archive, keys, sizes = _Archive(folder, uuid.uuid4().hex), [], []
                record = member if refers_to is None else revisit_record(page_id, url, size, digest, refers_to)
                archive.add(key, len(keys), record)
                keys.append(key)
                sizes.append(len(record))
                if archive.size >= ARCHIVE_BYTES:
                    yield closed()
                    archive = None
        if archive is not None:
            yield closed()

    return run


class CaptureIndex:
    """Lookups in one archive by ``(key, order)``. Holds the sparse directory and the last block."""

    def __init__(self, folder: str, name: str):
        self.fs, root = fs.FileSystem.from_uri(folder)
        with self.fs.open_input_stream(f"{root}/{name}.idx", compression=None) as f:
            self.directory = [(k, o, at, size) for k, o, at, size in json.loads(f.read())]
        self.index = self.fs.open_input_file(f"{root}/{name}.cdx.gz")
        self.archive = self.fs.open_input_file(f"{root}/{name}.warc.gz")
        self.block_number, self.block = None, []

    def _lines(self, number: int) -> list:
        if number != self.block_number:
            _, _, at, size = self.directory[number]
            self.block = [tuple(json.loads(x)) for x in zlib.decompress(self.index.read_at(size, at), wbits=31).split(b"\n")]
            self.block_number = number
        return self.block

    def find(self, key: str, order: int) -> bytes | None:
        number = bisect_right(self.directory, (key, order), key=lambda d: d[:2]) - 1
        if number < 0:
            return None
        lines = self._lines(number)
        i = bisect_left(lines, (key, order), key=lambda x: x[:2])
        if i == len(lines) or lines[i][:2] != (key, order):
            return None
        return self.archive.read_at(lines[i][3], lines[i][2])

    def close(self) -> None:
        self.index.close()
        self.archive.close()


_READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _read(folder: str, payloads: bool):
    """Lookups sorted by archive, key and order; one archive is open at a time."""
    types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, index = None, None
        for batch in batches:
            rows = []
            for name, key, order in zip(*(batch[c].to_pylist() for c in ("name", "key", "order"))):
                if name != opened:
                    if index:
                        index.close()
                    opened, index = name, CaptureIndex(folder, name)
                member = index.find(key, order)
                if member is None:
                    raise LookupError(f"no capture of {key!r} ({order}) in {name}")
                fields, http, payload = parse_record(member)
                size = int(http.rpartition(b"Content-Length: ")[2].split(b"\r\n")[0])
                digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
                if kind == "response" and (len(payload), payload_digest(payload)) != (size, digest):
                    raise ValueError(f"damaged record of {key!r} in {name}")
                page, refers = fields["WARC-Page-ID"], fields.get("WARC-Refers-To-Page-ID")
                rows.append((int(page) if page else None, unquote(fields["WARC-Target-URI"]), size, digest, kind,
                             int(refers) if refers else None, payload if kind == "response" else None))
            columns = list(zip(*rows)) if rows else [()] * len(types)
            width = len(types) if payloads else len(types) - 1
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns[:width], types)], names=names[:width])
        if index:
            index.close()

    return run


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys and response records, made and compressed where the page is read."""
    for batch in batches:
        urls, payloads = batch["url"].to_pylist(), [(h or "").encode("utf-8") for h in batch["html"].to_pylist()]
        yield pa.record_batch([
            batch["page_id"], batch["url"], batch["sha1"], pa.array([host_key(u) for u in urls], pa.string()),
            pa.array([payload_digest(p) for p in payloads], pa.string()), pa.array([len(p) for p in payloads], pa.int64()),
            pa.array([response_record(i, u, p) for i, u, p in zip(batch["page_id"].to_pylist(), urls, payloads)], pa.binary()),
        ], names=["page_id", "url", "sha1", "key", "digest", "size", "member"])


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write every row of ``pages (page_id, url, html)``; returns the written captures ``name, key, order, bytes``.

    Equal payloads have one length and SHA-1. Of payloads of ``min_revisit_bytes`` or more, the one with the
    smallest ``page_id`` is a response and others revisit it; rows that repeat that ``page_id`` are
    responses too, and so are rows without ``page_id`` if no equal payload has one. A null html is an
    empty payload, a null url an empty one; an empty table gives no archive. A record is held whole in
    memory, one at a time. Other columns are ignored.
    """
    bound_batches(pages.sparkSession)
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.col("html").cast("string").alias("html"))
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    hashed = plain.withColumn("sha1", F.sha1(payload)).withColumn("size", F.octet_length(payload).cast("long"))
    first = (
        hashed.where(F.col("size") >= min_revisit_bytes).groupBy("sha1", "size")
        .agg(F.min("page_id").alias("r"), F.count("*").alias("copies")).where("copies > 1 and r is not null")
        .select("sha1", "size", "r")
    )
    # Compressed records move instead of pages: once to their copies, once into the order of the archives.
    made = hashed.select("page_id", "url", "html", "sha1").mapInArrow(
        _records, "page_id long, url string, sha1 string, key string, digest string, size long, member binary")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("r")), F.col("r"))
    told = made.join(first, ["sha1", "size"], "left").withColumn("refers_to", refers).select(
        "key", "page_id", "url", "digest", "size", F.when(F.col("refers_to").isNull(), F.col("member")).alias("member"), "refers_to")
    ordered = told.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id")
    return materialize(ordered.mapInArrow(_write(folder), "name string, key string, order long, bytes long"), "warc_captures")


def read_archives(captures: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """Records of ``captures (name, key, order, bytes)``, found through the index and read back from the archives.

    ``page_id, url, payload_bytes, payload_digest, record_type, refers_to`` (and ``payload`` of responses).
    Length and digest of a response are checked against its payload; a revisit tells those of the payload
    that it refers to.
    """
    total = captures.agg(F.sum("bytes").alias("bytes")).first()["bytes"] or 0
    # A number given here is not merged again by the rows' own size.
    sorted_ = captures.repartitionByRange(-(-total // READ_BYTES) or 1, "name", "key", "order").sortWithinPartitions("name", "key", "order")
    return sorted_.mapInArrow(_read(folder, payloads), _READ + ", payload binary" * payloads)


def round_trip(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Archive ``pages`` in ``folder`` (default: a new one beside the other intermediate tables) and read them back."""
    folder = folder or new_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), folder)
