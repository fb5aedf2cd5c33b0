r"""Web archives: writing ARC, converting ARC 1 and 2 to WARC, and reading WARC back.

An archive file is one row of text while it is made, a few MB of records, and Spark's text writer
stores it gzip-compressed in the shared folder; ``binaryFile`` reads it again. Records are found by
their declared lengths only, so a payload may hold anything that looks like a header.

ARC. The first record is ``filedesc://``; its block names the version. A version 1 header line is
``url ip date type length``, a version 2 line ``url ip date type status checksum location offset
filename length``. The document is an HTTP response, and a newline ends the record.

WARC. ``response`` records keep the HTTP response; identifiers are name-based UUIDs of the record's
place in the archive (file, offset) and its page, dates become ISO 8601, digests are base32 SHA-1. Of records with equal
payloads the one with the smallest page is the response and others become ``revisit`` records
with the HTTP header only.

Sizes: ``FILE_BYTES`` bounds a file, but for one longer record. Which pages revisit which is a
join of digests; payloads are not shuffled for it.

Defined cases: a null html is the empty payload, a null url is ``unknown:``; blanks and control
characters of a url are percent-encoded; equal rows with one page id are all responses; a null
page id never is the smallest and never a revisit; an empty table gives no record.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from askloom.llm.common import utf8
from askloom.session import scratch_path

FILE_BYTES = 8_000_000
PAGE_HEADER = b"X-Page-Id"
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
NAMESPACE = uuid.UUID("6f0f3d0e-3f0b-4d53-9d0c-6c5d0a5b7c11")
WARC_SCHEMA = (
    "page_id long, url string, date string, record_type string, record_id string, refers_to_id string, "
    "payload_bytes long, payload_digest string"
)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def safe_url(url: str | None) -> str:
    """One word for a header line."""
    if not url:
        return "unknown:"
    return re.sub(r"[\s\x00-\x20\x7f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url)


# -- ARC


def arc_file_header(version: int, date: str) -> bytes:
    block = f"{version} 0 askloom\n{ARC_FIELDS[version]}\n".encode()
    rest = "text/plain" if version == 1 else "text/plain 200 - - 0 pages.arc"
    return f"filedesc://pages.arc 0.0.0.0 {date} {rest} {len(block)}\n".encode() + block + b"\n"


def arc_record(version: int, url: str, date: str, document: bytes, offset: int) -> bytes:
    rest = "text/html"
    if version == 2:
        rest += f" 200 {zlib.crc32(document):08x} - {offset} pages.arc"
    return f"{url} 0.0.0.0 {date} {rest} {len(document)}\n".encode() + document + b"\n"


def http_response(page: int | None, payload: bytes) -> bytes:
    page_line = PAGE_HEADER + b": " + (b"-" if page is None else str(page).encode())
    return (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
        + str(len(payload)).encode() + b"\r\n" + page_line + b"\r\n\r\n" + payload
    )


def write_arc(
    pages: DataFrame, path: str, *, id_col: str = "page_id", url: str = "url", html: str = "html",
    date: str = "20240101000000", file_bytes: int = FILE_BYTES,
) -> None:
    """The pages as ARC files, in turn of version 1 and 2, about ``file_bytes`` each."""
    rows = pages.select(F.col(id_col).cast("long"), F.col(url).cast("string"), utf8(html))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        version, parts, held = 1, [], 0

        def done():
            return pa.RecordBatch.from_arrays([pa.array([b"".join(parts)[:-1].decode()])], ["value"])

        for batch in batches:
            for page, link, body in zip(*((v.as_py() for v in c) for c in batch.columns)):
                if not parts:
                    parts = [arc_file_header(version, date)]
                    held = len(parts[0])
                parts.append(arc_record(version, safe_url(link), date, http_response(page, body), held))
                held += len(parts[-1])
                if held >= file_bytes:
                    yield done()
                    version, parts = 3 - version, []
        if parts:
            yield done()

    # One row is one file; the writer's line end is the newline behind the last record.
    (
        rows.mapInArrow(make, "value string").write.option("maxRecordsPerFile", 1)
        .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(path)
    )


def parse_arc(data: bytes) -> Iterator[tuple[int, str, str, bytes]]:
    """(offset, url, date, document) of every record, by the version that the file declares."""
    at, version = 0, None
    while at < len(data):
        end = data.index(b"\n", at)
        fields = data[at:end].decode().split(" ")
        size = int(fields[-1])
        block = data[end + 1: end + 1 + size]
        if version is None:
            if not fields[0].startswith("filedesc://"):
                raise ValueError("an ARC file begins with filedesc://")
            version = int(block.split(b" ", 1)[0])
            if version not in ARC_FIELDS:
                raise ValueError(f"unknown ARC version {version}")
        else:
            if len(fields) != len(ARC_FIELDS[version].split(" ")):
                raise ValueError(f"not a header line of version {version}: {data[at:end]!r}")
            yield at, fields[0], fields[2], block
        at = end + 1 + size + 1  # the newline behind the record


def split_http(document: bytes) -> tuple[bytes, dict[bytes, bytes], bytes]:
    """(header with its empty line, its fields by lower-case name, payload)."""
    end = document.find(b"\r\n\r\n")
    end = len(document) if end < 0 else end + 4
    head = document[:end]
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if colon:
            fields[name.strip().lower()] = value.strip()
    return head, fields, document[end:]


def page_of(fields: dict[bytes, bytes]) -> int | None:
    value = fields.get(PAGE_HEADER.lower(), b"-")
    return None if value == b"-" else int(value)


# -- WARC


def record_id(file: str, offset: int, page: int | None) -> str:
    """Name-based, so that a repeated conversion of a file gives the same identifiers."""
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'{file} {offset} {page}')}>"


def iso_date(arc: str) -> str:
    d = arc.ljust(14, "0")
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def warc_record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [("WARC-Type", kind), *headers, ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0]!r}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        size = int(fields["Content-Length"])
        yield fields, data[end + 4: end + 4 + size]
        at = end + 4 + size + 4


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _rows_batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=names)


def _unpacked(packed: bytes) -> bytes:
    return zlib.decompress(packed, 31) if packed else b""


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def arc_index(spark: SparkSession, path: str) -> DataFrame:
    """``file, offset, page_id, payload_bytes, payload_digest, record_id`` of every ARC record."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, packed in zip(*((v.as_py() for v in c) for c in batch.columns)):
                rows = []
                for offset, _, _, document in parse_arc(_unpacked(packed)):
                    _, fields, payload = split_http(document)
                    page = page_of(fields)
                    rows.append((file, offset, page, sha1_base32(payload), record_id(_name(file), offset, page)))
                yield _rows_batch(rows, names, types)

    names = ["file", "offset", "page_id", "payload_digest", "record_id"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    return _files(spark, path).mapInArrow(
        scan, "file string, offset long, page_id long, payload_digest string, record_id string"
    )


def revisits(index: DataFrame) -> DataFrame:
    """``file, offset, refers_to`` (a record id) of the records that repeat a smaller page's payload."""
    first = index.groupBy("payload_digest").agg(
        F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "record_id"))).alias("_first")
    )
    return (
        index.join(first, "payload_digest")
        .where(F.col("page_id") > F.col("_first.page_id"))
        .select("file", "offset", F.col("_first.record_id").alias("refers_to"))
    )


def convert_arc(spark: SparkSession, arc_path: str, warc_path: str) -> None:
    """Write a WARC file for every ARC file of a folder."""
    again = revisits(arc_index(spark, arc_path)).groupBy("file").agg(
        F.collect_list(F.struct("offset", "refers_to")).alias("again")  # at most the records of a file
    )
    files = _files(spark, arc_path).withColumnRenamed("path", "file").join(again, "file", "left")

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, packed, known in zip(*((v.as_py() for v in c) for c in batch.columns)):
                refers = {r["offset"]: r["refers_to"] for r in known or ()}
                name, out, date = _name(file), [], None
                for offset, url, day, document in parse_arc(_unpacked(packed)):
                    head, fields, payload = split_http(document)
                    date = iso_date(day)
                    headers = [
                        ("WARC-Record-ID", record_id(name, offset, page_of(fields))),
                        ("WARC-Date", date), ("WARC-Target-URI", url),
                        ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"),
                    ]
                    kind = "revisit" if offset in refers else "response"
                    if kind == "revisit":
                        headers += [
                            ("WARC-Refers-To", refers[offset]),
                            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                        ]
                    block = head if kind == "revisit" else document
                    headers += [
                        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
                        ("Content-Type", "application/http; msgtype=response"),
                    ]
                    out.append(warc_record(kind, headers, block))
                info = f"software: askloom\r\nconverted-from: {name}\r\n".encode()
                first = warc_record("warcinfo", [
                    ("WARC-Record-ID", record_id(name, -1, None)), ("WARC-Date", date or "1970-01-01T00:00:00Z"),
                    ("Content-Type", "application/warc-fields"),
                ], info)
                # The writer ends the row with the last newline.
                value = b"".join([first, *out])[:-1].decode()
                yield pa.RecordBatch.from_arrays([pa.array([value])], ["value"])

    (
        files.select("file", "content", "again").mapInArrow(convert, "value string")
        .write.option("maxRecordsPerFile", 1).option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").text(warc_path)
    )


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per response or revisit record of the archives, with ``refers_to`` as a page."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in (v.as_py() for v in batch.column(0)):
                rows = []
                for f, block in parse_warc(_unpacked(packed)):
                    if f["WARC-Type"] == "warcinfo":
                        continue
                    _, http, payload = split_http(block)
                    digest = f["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(http[b"content-length"])
                    if f["WARC-Type"] == "response" and (len(payload) != size or sha1_base32(payload) != digest):
                        raise ValueError(f"damaged record {f['WARC-Record-ID']}")
                    rows.append((page_of(http), f["WARC-Target-URI"], f["WARC-Date"], f["WARC-Type"],
                                 f["WARC-Record-ID"], f.get("WARC-Refers-To"), size, digest))
                yield _rows_batch(rows, names, types)

    names = [c.split()[0] for c in WARC_SCHEMA.split(", ")]
    types = [pa.int64() if c.endswith("long") else pa.string() for c in WARC_SCHEMA.split(", ")]
    records = _files(spark, path).select("content").mapInArrow(scan, WARC_SCHEMA)
    # Responses that something refers to: narrow rows, looked up by identifier.
    targets = records.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to")
    )
    return records.join(targets, "refers_to_id", "left").select(
        *[c for c in records.columns if c != "refers_to_id"], "refers_to_id", "refers_to"
    )


def archive_pages(pages: DataFrame, **options) -> DataFrame:
    """Pages to ARC, ARC to WARC, and the records as they are read back from the WARC files."""
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc, **options)
    convert_arc(spark, arc, warc)
    return read_warc(spark, warc)
