"""WARC archives with an index: write records, then read selected ones by coalesced byte ranges.

Writing: each task streams its pages into archive files of its own below the
shared folder, one gzip member per record, and returns an index row (path,
offset, length, page, URL, digest, type) per record.  The index is written as a
table; only files that it names belong to the archive, so files of failed or
repeated task attempts do no harm.

Reading: index rows, sorted by file and offset, are merged into byte ranges
(neighbours at most ``max_gap`` apart, at most ``max_read`` long), each of which
is one read; records are cut from it by the index.

Of records with equal payloads of at least ``min_revisit`` bytes the one with
the largest page_id is the response; the others are revisits that refer to it
and carry no payload, only its digest and length.

The shared folder must be reachable by ``pyarrow.fs`` (a mounted folder, S3,
GCS, or HDFS with its client library).

Defined cases: NULL html is an empty payload; a NULL url gives a record without
target; a page without page_id gets a record id from its digest, is a response
and is never referred to; rows that repeat the largest page_id are each a
response; control characters and blanks in a url are percent-encoded in the
archive (the index has the url as it was); extra columns are ignored; an empty
table gives an empty index.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecraft.llm.common import materialise
from ratecraft.session import scratch_path

MIN_REVISIT = 1000
MAX_FILE = 1 << 30
MAX_READ = 8 << 20
MAX_GAP = 64 << 10
DATE = "2026-01-01T00:00:00Z"

# fixed values of the format
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_INDEX = ("path string, offset long, length long, page_id long, url string, payload_digest string, "
          "payload_bytes long, record_type string")
_RECORD = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
           "refers_to long, payload binary")


def _fs(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _record_id(page_id, digest: str) -> str:
    return f"<urn:page:{page_id}>" if page_id is not None else f"<urn:uuid:{uuid.UUID(digest[:32])}>"


def record(page_id, url, payload: bytes, refers_to, date: str) -> tuple[bytes, str]:
    """(one WARC record, hex SHA-1 of its payload)."""
    digest = hashlib.sha1(payload).hexdigest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = [VERSION, f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {_record_id(page_id, digest)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if refers_to is not None:
        head += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: {_record_id(refers_to, digest)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", digest


def parse(data: bytes) -> tuple:
    """The fields of _RECORD from one record; a payload that does not match its digest raises."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    http, _, payload = rest[:int(fields["Content-Length"])].partition(b"\r\n\r\n")
    size = int(re.search(rb"(?i)\r\ncontent-length: (\d+)", http)[1])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    page = lambda name: int(m[1]) if (m := re.fullmatch(r"<urn:page:(-?\d+)>", fields.get(name, ""))) else None
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return page("WARC-Record-ID"), fields.get("WARC-Target-URI"), size, digest, kind, page("WARC-Refers-To"), payload if kind == "response" else None


def write_archive(pages: DataFrame, min_revisit: int = MIN_REVISIT, max_file: int = MAX_FILE, date: str = DATE) -> DataFrame:
    """Write the archive files of all pages; the index, as a table in the shared folder."""
    folder = scratch_path(pages.sparkSession, "warc")
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), "url", html.alias("html"),
                        F.sha1(html).alias("digest"), F.octet_length(html).cast("long").alias("size"))
    shared = materialise(rows.where(F.col("size") >= min_revisit).groupBy("digest", "size")
                         .agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
                         .where(F.col("n") > 1).select("digest", "size", "keeper"), "warc-shared")
    rows = rows.join(shared, ["digest", "size"], "left").select(
        "page_id", "url", "html", F.when(F.col("page_id") != F.col("keeper"), F.col("keeper")).alias("refers_to"))

    def write(batches):
        out = path = None
        at = 0
        try:
            for batch in batches:
                found = []
                for page_id, url, text, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if out is None or at >= max_file:
                        if out is not None:
                            out.close()
                        path, at = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                        fs, place = _fs(path)
                        fs.create_dir(place.rpartition("/")[0], recursive=True)
                        out = fs.open_output_stream(place, compression=None)
                    payload = text.encode()
                    data, digest = record(page_id, url, payload, refers_to, date)
                    packed = zlib.compressobj(wbits=31)
                    data = packed.compress(data) + packed.flush()
                    out.write(data)
                    found.append((path, at, len(data), page_id, url, digest, len(payload),
                                  "response" if refers_to is None else "revisit"))
                    at += len(data)
                yield _batch(found, _INDEX)
        finally:
            if out is not None:
                out.close()

    return materialise(rows.mapInArrow(write, _INDEX), "warc-index")


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    fields = [(n, kinds[k]) for n, k in (c.split() for c in schema.split(", "))]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def byte_ranges(rows: list[tuple[str, int, int]], max_read: int = MAX_READ, max_gap: int = MAX_GAP):
    """(path, start, end, records) from (path, offset, length) in order: neighbours become one read."""
    run: list[tuple[int, int]] = []
    at = start = end = None
    for path, offset, length in rows:
        if run and (path != at or offset - end > max_gap or max(end, offset + length) - start > max_read):
            yield at, start, end, run
            run = []
        if not run:
            at, start, end = path, offset, offset
        run.append((offset, length))
        end = max(end, offset + length)
    if run:
        yield at, start, end, run


def read_records(index: DataFrame, payloads: bool = True, max_read: int = MAX_READ, max_gap: int = MAX_GAP) -> DataFrame:
    """The records that ``index`` selects, read from the archive files, about ``max_read`` bytes a task."""
    def read(batches):
        opened = (None, None)
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            for path, start, end, run in byte_ranges(rows, max_read, max_gap):
                if opened[0] != path:
                    fs, place = _fs(path)
                    opened = (path, fs.open_input_file(place))
                data = opened[1].read_at(end - start, start)
                found = [parse(zlib.decompress(data[o - start:o - start + n], wbits=31)) for o, n in run]
                yield _batch(found if payloads else [r[:-1] + (None,) for r in found], _RECORD)

    # dealt by the bytes to read: of the index alone, a task would take very many records
    selected = index.select("path", "offset", "length")
    parts = max(1, -(-(selected.agg(F.sum("length")).first()[0] or 0) // max_read))
    ordered = selected.repartitionByRange(parts, "path", "offset").sortWithinPartitions("path", "offset")
    return ordered.mapInArrow(read, _RECORD)


def round_trip(pages: DataFrame) -> DataFrame:
    """The contract's columns, as read back from the archives."""
    return read_records(write_archive(pages), payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
shared AS (
  SELECT payload_digest, payload_bytes, max(page_id) AS keeper, count(*) AS n FROM payloads
  WHERE payload_bytes >= 1000 GROUP BY ALL)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN n > 1 AND p.page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n > 1 AND p.page_id <> keeper THEN keeper END AS refers_to
FROM payloads p LEFT JOIN shared s ON p.payload_digest = s.payload_digest AND p.payload_bytes = s.payload_bytes
"""
