"""WARC archives of gzip members: a writer with revisit records, and a reader that splits files by bytes.

A writing task makes one file of its own name; the manifest, a table with a row for each task that
succeeded, says which files count, so retried tasks leave nothing behind that is read. A reading
task scans its byte range for gzip magic and decodes the header of each candidate; what doesn't
decode to a WARC record is passed over. It owns the records that start inside its range and reads
past the end of the range to finish the last one.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.llm.text import scratch, store

SPLIT_BYTES = 8 << 20
_READ, _STEP = 1 << 20, 1 << 14
_MAGIC = b"\x1f\x8b\x08"
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = "path string, at long, record_type string, record_id string, refers_to string, target_uri string, payload_digest string, payload_bytes long, payload binary"


def file_system(path: str):
    """File system and path of a URI that Python can open in tasks as well: local or shared files, or object stores."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, first: int | None, revisit: bool) -> bytes:
    """A gzip member that holds one WARC record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {_DATE}",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
        "Content-Type: application/http;msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:  # no control characters in a header
        head.append("WARC-Target-URI: " + "".join(c if c >= " " else f"%{ord(c):02X}" for c in url))
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{first}>"]
    packed = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packed.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packed.flush()


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write a record for each row of ``pages``; returns the manifest: path, bytes and records of each file.

    Of equal payloads of ``least_bytes`` or more the one with the smallest page_id is the response,
    others revisit it. Rows without page_id revisit one that has an id, and are responses if none
    has; rows repeated under the smallest page_id are all responses. Null html is an empty payload.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
        F.unhex(F.sha2(payload, 256)).alias("key"),
    )
    keys = rows.select("page_id", "key", F.length("payload").alias("size"))
    again = (
        keys.filter(F.col("size") >= least_bytes)
        .groupBy("key")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 AND first IS NOT NULL")
        .select("key", "first")
    )
    # Only repeated payloads are joined; adaptive execution splits one that many pages share.
    dealt = rows.join(again, "key", "left").select(
        "page_id",
        "url",
        "payload",
        "first",
        (F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))).alias("revisit"),
    )
    files = f"{folder}/archives"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(files if "://" in files else files.replace("file:", "file://", 1))
        system.create_dir(base, recursive=True)
        name = f"part-{uuid.uuid4().hex}.warc.gz"
        size = count = 0
        with system.open_output_stream(f"{base}/{name}", compression=None) as out:
            for batch in batches:
                for values in zip(*(batch[c] for c in batch.schema.names), strict=True):
                    member = record(*(v.as_py() for v in values))
                    out.write(member)
                    size, count = size + len(member), count + 1
        yield pa.RecordBatch.from_pydict({"path": [f"{files}/{name}"], "bytes": [size], "records": [count]})

    return store(dealt.mapInArrow(write, "path string, bytes long, records long"), f"{folder}/manifest")


class _Window:
    """A file's bytes from some place on, read as they are needed."""

    def __init__(self, file, start: int):
        self.file, self.start, self.data = file, start, b""
        file.seek(start)

    def more(self) -> bool:
        read = self.file.read(_READ)
        self.data += read
        return bool(read)

    def drop(self, until: int) -> None:
        self.data = self.data[until - self.start :]
        self.start = until


def decode(window: _Window, at: int) -> tuple[bytes, int] | None:
    """The contents and the end of the member at ``at`` if it is a whole WARC record; else None."""
    inflate = zlib.decompressobj(31)
    parts, done, checked = [], at - window.start, False
    while not inflate.eof:
        if done >= len(window.data) and not window.more():
            return None
        try:
            parts.append(inflate.decompress(window.data[done : done + _STEP]))
        except zlib.error:
            return None
        done = min(done + _STEP, len(window.data))
        if not checked and sum(map(len, parts)) >= 8:
            checked = True
            if not b"".join(parts).startswith(b"WARC/1."):
                return None
    whole = b"".join(parts)
    if not whole.startswith(b"WARC/1.") or b"\r\n\r\n" not in whole:
        return None
    return whole, window.start + done - len(inflate.unused_data)


def records(file, start: int, stop: int) -> Iterator[tuple[int, bytes]]:
    """Offset and contents of the records that start at ``start`` or after, and before ``stop``."""
    window, at = _Window(file, start), start
    while at < stop:
        place = window.data.find(_MAGIC, at - window.start)
        if place < 0:
            at = max(at, window.start + len(window.data) - 2)  # the magic may lie across two reads
            window.drop(at)
            if not window.more():
                return
            continue
        at = window.start + place
        if at >= stop:
            return
        window.drop(at)
        found = decode(window, at)
        if found is None:
            at += 1
            continue
        yield at, found[0]
        at = found[1]
        window.drop(at)


def parse(whole: bytes) -> tuple:
    """Type, id, refers-to, uri, digest, payload length and payload of a record."""
    head, _, block = whole.partition(b"\r\n\r\n")
    fields = dict(line.decode().split(": ", 1) for line in head.split(b"\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = dict(line.decode().split(": ", 1) for line in http.split(b"\r\n")[1:])["Content-Length"]
    return (
        fields["WARC-Type"],
        fields["WARC-Record-ID"],
        fields.get("WARC-Refers-To"),
        fields.get("WARC-Target-URI"),
        fields["WARC-Payload-Digest"].removeprefix("sha1:"),
        int(size),
        None if fields["WARC-Type"] == "revisit" else payload,
    )


def read_archives(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """A row per record of the files of ``manifest`` (path, bytes): where it lies, its fields and its payload."""
    names = [c.split()[0] for c in _RECORD.split(", ")]
    kinds = pa.schema(
        [(n, pa.int64() if n in ("at", "payload_bytes") else pa.binary() if n == "payload" else pa.string()) for n in names]
    )
    ranges = manifest.filter("bytes > 0").select(
        "path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start")
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch["path"].to_pylist(), batch["start"].to_pylist(), strict=True):
                system, name = file_system(path if "://" in path else path.replace("file:", "file://", 1))
                with system.open_input_file(name) as file:
                    out, size = [], 0
                    for at, whole in records(file, start, start + split_bytes):
                        out.append((path, at, *parse(whole)))
                        size += len(whole)
                        if size > 4 * _READ:
                            yield _batch(out, kinds)
                            out, size = [], 0
                    yield _batch(out, kinds)

    # One range a task: ranges are dealt evenly, whatever files they come from.
    return ranges.repartition("path", "start").mapInArrow(read, _RECORD)


def _batch(rows: list[tuple], kinds: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.types, strict=True)], schema=kinds)


def archive_round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives and read them back: the records, with page_id and the response's page_id.

    No rows make no records. Other columns of ``pages`` are not looked at.
    """
    manifest = write_archives(pages, scratch(pages.sparkSession), least_bytes)
    number = lambda c: F.regexp_extract(c, "<urn:page:(-?[0-9]+)>", 1)
    whole = lambda c: F.nullif(number(c), F.lit("")).cast("long")
    return read_archives(manifest).withColumns({"page_id": whole("record_id"), "refers_to": whole("refers_to")})
