"""WARC archives: written by tasks, one gzip member per record, and read back by byte ranges.

A reading task looks for the gzip magic in its range, takes a candidate for a member if its
first bytes decode to a WARC header, and owns the records that start in its range; it reads on past
the range's end to finish the last one. So a large archive is read by many tasks, none of which needs
an index.

Files are reached through Arrow's file systems, which know local, Hadoop and object-store
addresses. A writing task's file has a name of its own; only files in the stored manifest, that is of
tasks that ended well, are read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill.llm.common import columns, stored
from assaymill.session import shared_folder

#: Bytes of an archive after which a task begins the next one, and of a reading task's range.
ARCHIVE, RANGE = 1 << 28, 1 << 23
#: Bytes that are read from the store, searched and decoded at once.
BUFFER, AT_ONCE = 1 << 20, 1 << 14
MAGIC = b"\x1f\x8b\x08"
LEVEL = 3
# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
_ID = "urn:x-page:"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(url: str) -> str:
    """The address in one header line: control characters, blanks and % as percent codes."""
    return "".join(
        c if c > " " and c != "%" and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url
    )


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One record; a revisit has the response's HTTP header but not its payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    lines = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_ID}{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_uri(url)}")
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <{_ID}{refers_to}>", f"WARC-Profile: {PROFILE}"]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _writer(folder: str, archive_bytes: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        path, out = None, None

        def manifest() -> pa.RecordBatch:
            size = out.tell()
            out.close()
            return pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([size], pa.int64())], names=["path", "bytes"]
            )

        for batch in batches:
            ids, urls, pages, refers = (batch.column(c) for c in ("page_id", "url", "html", "refers_to"))
            for i in range(batch.num_rows):
                if out is None:
                    path = f"{root}/{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(path, compression=None)
                payload = (pages[i].as_py() or "").encode()
                raw = record(ids[i].as_py(), urls[i].as_py(), payload, refers[i].as_py())
                gzip = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                out.write(gzip.compress(raw) + gzip.flush())
                if out.tell() >= archive_bytes:
                    yield manifest()
                    out = None
        if out is not None:
            yield manifest()

    return of


class _Members:
    """WARC members that start in ``start:stop`` of a file, and the records in them."""

    def __init__(self, file, start: int, stop: int):
        self.file, self.start, self.stop = file, start, stop
        self.base, self.buffer = 0, b""

    def _read(self, at: int, n: int) -> bytes:
        if not self.base <= at <= at + n <= self.base + len(self.buffer):
            self.file.seek(at)
            self.base, self.buffer = at, self.file.read(max(n, BUFFER))
        return self.buffer[at - self.base : at - self.base + n]

    def candidates(self, at: int) -> Iterator[int]:
        """Places of the magic in the rest of the range, those across a read's border too."""
        while at < self.stop:
            data = self._read(at, AT_ONCE + len(MAGIC) - 1)
            found = data.find(MAGIC)
            while found >= 0 and found < AT_ONCE and at + found < self.stop:
                yield at + found
                found = data.find(MAGIC, found + 1)
            at += AT_ONCE

    def member(self, at: int) -> tuple[bytes, int] | None:
        """The decoded member at a place and where it ends; None if it is no WARC record."""
        gzip, parts, here, size = zlib.decompressobj(31), [], at, 0
        try:
            while not gzip.eof:
                data = self._read(here, AT_ONCE)
                if not data:
                    return None
                here += len(data)
                parts.append(gzip.decompress(data))
                if size < len(VERSION) <= size + len(parts[-1]) and not b"".join(parts).startswith(b"WARC/"):
                    return None
                size += len(parts[-1])
        except zlib.error:
            return None
        raw = b"".join(parts)
        return (raw, here - len(gzip.unused_data)) if raw.startswith(b"WARC/") else None

    def __iter__(self) -> Iterator[bytes]:
        at = self.start
        while at < self.stop:
            for place in self.candidates(at):
                found = self.member(place)
                if found:
                    raw, at = found
                    yield raw
                    break
            else:
                return


def _headers(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = block.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")[1:]
    return {k.lower(): v for k, v in (line.split(": ", 1) for line in lines if ": " in line)}, rest


def _page(reference: str | None) -> int | None:
    number = (reference or "").strip("<>").removeprefix(_ID)
    return int(number) if number else None


def _plain(uri: str | None) -> str | None:
    from urllib.parse import unquote

    return None if uri is None else unquote(uri)


def parse(raw: bytes, with_payload: bool) -> tuple:
    """Page, address, kind, reference, digest, payload size and payload of a record.

    A response's digest is taken from its payload and must be the one in its header.
    """
    head, rest = _headers(raw)
    block = rest[: int(head["content-length"])]
    http, payload = _headers(block)
    digest = head["warc-payload-digest"].removeprefix("sha1:")
    kind = head["warc-type"]
    if kind == "response" and sha1_base32(payload) != digest:
        raise ValueError(f"record {head['warc-record-id']}: the payload does not fit its digest")
    return (
        _page(head["warc-record-id"]),
        _plain(head.get("warc-target-uri")),
        kind,
        _page(head.get("warc-refers-to")),
        digest,
        int(http["content-length"]),
        payload if with_payload and kind == "response" else None,
    )


_FIELDS = {
    "page_id": pa.int64(),
    "url": pa.string(),
    "record_type": pa.string(),
    "refers_to": pa.int64(),
    "payload_digest": pa.string(),
    "payload_bytes": pa.int64(),
    "payload": pa.binary(),
}


def _reader(folder: str, with_payload: bool):
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        values = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(_FIELDS.values())]
        return pa.RecordBatch.from_arrays(values, names=list(_FIELDS))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for part in batch.to_pylist():
                with store.open_input_file(part["path"]) as file:
                    rows, held = [], 0
                    for raw in _Members(file, part["start"], part["stop"]):
                        rows.append(parse(raw, with_payload))
                        held += len(raw) if with_payload else 100
                        if held > BUFFER * 8 or len(rows) >= 10_000:
                            yield batch_of(rows)
                            rows, held = [], 0
                    yield batch_of(rows)

    return of


def write_archives(pages: DataFrame, archive_bytes: int = ARCHIVE) -> tuple[str, DataFrame]:
    """The folder of the archives and their manifest: ``path`` and ``bytes``.

    Of pages with equal payloads, the one with the largest id is a response and the others
    revisit it; rows that repeat the largest id are responses too, as are all of a
    group without ids. A null page has an empty payload.
    """
    folder = shared_folder(pages.sparkSession, "warc")
    rows = columns(pages, page_id="page_id", url="url", html="html").withColumn(
        "key", F.sha2(F.coalesce("html", F.lit("")), 256)
    )
    groups = rows.groupBy("key").agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
    groups = stored(groups.where("n > 1").drop("n"), "equal-payloads")
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root)
    manifest = (
        rows.join(groups, "key", "left")
        .withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("last")), F.col("last")))
        .select("page_id", "url", "html", "refers_to")
        .mapInArrow(_writer(folder, archive_bytes), "path string, bytes bigint")
    )
    return folder, stored(manifest, "warc-manifest")


def read_archives(
    folder: str, manifest: DataFrame, range_bytes: int = RANGE, with_payload: bool = False
) -> DataFrame:
    """A row per record of the archives in the manifest, in ranges of ``range_bytes`` per task."""
    ranges = manifest.where("bytes > 0").select(
        "path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))).alias("start")
    )
    ranges = ranges.select("path", "start", F.least(F.col("start") + range_bytes, F.col("bytes")).alias("stop"))
    tasks = manifest.agg(F.sum(F.ceil(F.col("bytes") / range_bytes))).first()[0] or 1
    schema = (
        "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string,"
        " payload_bytes bigint, payload binary"
    )
    return ranges.repartition(int(min(tasks, 100_000))).mapInArrow(_reader(folder, with_payload), schema)


def archived(pages: DataFrame) -> DataFrame:
    """One row per page, as the archives tell it after they were written.

    Null addresses stay null, rows without an id are records of their own, repeated rows each; an
    empty table gives no archive and no rows. Other columns are not looked at.
    """
    folder, manifest = write_archives(pages)
    return read_archives(folder, manifest).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"
    )
