"""WARC archives of pages: written from the tasks, read back sequentially.

Each record is a gzip member of its own. The first page (least ``page_id``) of
equal payloads is a ``response``; the others are ``revisit`` records that name
it and repeat only the HTTP headers, so their ``Content-Length`` still tells the
payload's size. The reader inflates members one after another from fixed-size
chunks, frames each record by its ``Content-Length`` and checks the digests.
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

from tidemark.llm.shared import open_folder, partitions, ready, settle
from tidemark.session import scratch_path

#: An archive ends after the record that takes it beyond this size.
ARCHIVE_BYTES = 1 << 30
CHUNK = 1 << 20
LEVEL = 3

ARCHIVES = "path string, n_records long, n_bytes long"
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, payload binary"
)


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _header_safe(value: str) -> str:
    return value.replace("\r", "%0D").replace("\n", "%0A")


def _record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_id(record_id: str) -> int | None:
    number = record_id.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record(
    page_id: int | None, url: str | None, html: str | None, first: int | None, revisit: bool
) -> bytes:
    """One WARC record, not yet compressed."""
    payload = (html or "").encode()
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_safe(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest(payload)}")
    lines.append(f"WARC-Block-Digest: sha1:{digest(block)}")
    if revisit:
        lines.append(f"WARC-Refers-To: {_record_id(first)}")
        lines.append(
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        )
    lines.append("Content-Type: application/http; msgtype=response")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _headers(raw: bytes) -> tuple[str, dict[str, str]]:
    first, *rest = raw.decode().split("\r\n")
    return first, {k.lower(): v for k, _, v in (line.partition(": ") for line in rest)}


def members(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """Inflated members one by one; a member may span chunks and a chunk hold many."""
    unpack, parts = None, []
    for chunk in chunks:
        while chunk:
            if unpack is None:
                unpack = zlib.decompressobj(31)
            parts.append(unpack.decompress(chunk))
            chunk = unpack.unused_data
            if unpack.eof:
                yield b"".join(parts)
                unpack, parts = None, []
    if unpack is not None:
        raise ValueError("the archive ends inside a record")


def parse(data: bytes) -> dict:
    """A record's fields; raises on broken framing or a wrong digest."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, fields = _headers(head)
    size = int(fields["content-length"])
    block = rest[:size]
    if not gap or not version.startswith("WARC/") or rest[size:] != b"\r\n\r\n":
        raise ValueError("broken record")
    if fields["warc-block-digest"] != f"sha1:{digest(block)}":
        raise ValueError("wrong block digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    _, http_fields = _headers(http)
    kind, length = fields["warc-type"], int(http_fields["content-length"])
    said = fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or digest(payload) != said):
        raise ValueError("wrong payload digest")
    refers = fields.get("warc-refers-to")
    return {
        "page_id": _page_id(fields["warc-record-id"]),
        "url": fields.get("warc-target-uri"),
        "record_type": kind,
        "refers_to": _page_id(refers) if refers else None,
        "payload_bytes": length,
        "payload_digest": said,
        "payload": payload if kind == "response" else None,
    }


def write(pages: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``page_id, url, html`` rows as archives; returns the archives' list.

    A null ``html`` is an empty payload. Among equal payloads a null id comes after
    all others; rows that share the least id are all responses. Archives have names of
    their own, and only the listed ones count: a repeated task leaves an unlisted file.
    """
    spark = ready(pages.sparkSession)
    folder = folder or scratch_path(spark, "archives")
    html = F.coalesce(pages["html"].cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        pages["url"].cast("string").alias("url"),
        html.alias("html"),
        F.sha1(html).alias("sum"),
        F.octet_length(html).alias("size"),
    )
    firsts = (
        pages.select(F.col("page_id").cast("long").alias("page_id"), html.alias("html"))
        .select("page_id", F.sha1("html").alias("sum"), F.octet_length("html").alias("size"))
        .groupBy("sum", "size")
        .agg(F.min("page_id").alias("first"))
    )
    todo = rows.join(firsts, ["sum", "size"]).select(
        "page_id", "url", "html", "first", (~F.col("page_id").eqNullSafe(F.col("first"))).alias("again")
    )

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = open_folder(folder)
        sink, name, n, size, done = None, "", 0, 0, []

        def close() -> None:
            sink.close()
            done.append((f"{folder}/{name}", n, size))

        for batch in batches:
            for values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if sink is None:
                    store.create_dir(base, recursive=True)
                    name, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    sink = store.open_output_stream(f"{base}/{name}", compression=None)
                data = member(record(*values))
                sink.write(data)
                n, size = n + 1, size + len(data)
                if size >= archive_bytes:
                    close()
                    sink = None
        if sink is not None:
            close()
        if done:
            path, n_records, n_bytes = (list(x) for x in zip(*done, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(path), pa.array(n_records, pa.int64()), pa.array(n_bytes, pa.int64())],
                ["path", "n_records", "n_bytes"],
            )

    return settle(todo.mapInArrow(save, ARCHIVES), "archive-list")


def read(archives: DataFrame, *, payloads: bool = True) -> DataFrame:
    """All records of the listed archives; without ``payloads`` that column is null."""
    spark = ready(archives.sparkSession)

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("page_id", pa.int64()),
                ("url", pa.string()),
                ("record_type", pa.string()),
                ("refers_to", pa.int64()),
                ("payload_bytes", pa.int64()),
                ("payload_digest", pa.string()),
                ("payload", pa.binary()),
            ]
        )
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                store, path = open_folder(uri)
                rows, size = [], 0
                with store.open_input_stream(path, compression=None) as f:
                    for data in members(iter(lambda f=f: f.read(CHUNK), b"")):
                        row = parse(data)
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                        size += len(row["payload"] or b"") + 200
                        if size > 8 * CHUNK:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    spread = archives.select("path").repartitionByRange(partitions(spark), "path")
    return spread.mapInArrow(load, RECORDS)
