"""Legacy ARC archives: write, parse by declared lengths, convert to WARC, read back.

ARC files start with a version block whose second line tells the version and whose third line names the header
fields: version 1 has ``URL IP-address Archive-date Content-type Archive-length``, version 2 adds ``Result-code
Checksum Location Offset Filename`` before the length. Records are parsed by these and by their declared
length, never by searching for separators. The converter derives each WARC record's identifier (a name-based UUID),
date (from the 14 digits), type and SHA-256 digests; of records with equal payloads of ``min_bytes`` or more, all
but that of the smallest page id (ties: archive, then offset) become ``revisit`` records that refer to it.

Bytes stay bytes from the archive read to the archive written, so pages may be in any encoding, images, or compressed.
A WARC archive is a sequence of gzip members, one a record, so that readers can seek to a record.

Archives are files of the shared folder, written by Spark's text writer (one row per archive) and read by
its binary file reader, so any Hadoop file system serves. An archive closes at ``target_bytes``, which bounds what a
task holds; a foreign archive is read as one value, so it must fit a task (2 GB is the reader's limit). Deduplication shuffles one short row per record (digest, page id, place), combined per digest before
the shuffle; revisits go back to their archive as a list, joined by path. Payloads are not shuffled, unless that
list is too big to broadcast.

Nulls and edge cases: a null payload is empty; a null url is written as ``unknown:``; a null page id writes no id
and ranks after all others; repeated rows are records each. White space and control characters in urls are
percent-encoded. Other columns are ignored. An empty table gives an empty result. Long pages are whole records; an
archive grows past ``target_bytes`` by its last page at most. Ties of the page id go by archive and place.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.session import scratch_path

TARGET_BYTES, MIN_BYTES = 8 << 20, 100
PIECE = 16 << 10  # bytes fed to a gzip member at once
_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
_SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def http_block(page_id: object, payload: str) -> str:
    n = len(payload.encode("utf-8", "surrogatepass"))
    of_page = "" if page_id is None else f"X-Page-Id: {page_id}\r\n"
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{of_page}Content-Length: {n}\r\n\r\n"


def arc_head(version: int, name: str, date: str) -> str:
    """The version block that opens an archive."""
    body = f"{version} 0 lakeload\n{_FIELDS[version]}\n"
    more = f" 200 - - 0 {name}" if version == 2 else ""
    return f"filedesc://{name} 0.0.0.0 {date} text/plain{more} {len(body)}\n{body}"


def arc_record(version: int, name: str, date: str, at: int, page: object, url: str | None, html: str) -> str:
    block = http_block(page, html)
    n = len(block.encode()) + len(html.encode("utf-8", "surrogatepass"))
    where = quote(url, safe="!#$%&'()*+,/:;=?@[]~-._") if url else "unknown:"
    more = f" 200 - - {at} {name}" if version == 2 else ""
    return f"\n{where} 0.0.0.0 {date} text/html{more} {n}\n{block}{html}"


def write_arc(pages: DataFrame, path: str, id_col="page_id", url_col="url", html_col="html", date="20240101000000", target=TARGET_BYTES) -> None:
    """Write the pages as ARC archives (versions 1 and 2 in turn), one file each, under ``path``."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, number = [], 0, 0
        row = lambda: pa.RecordBatch.from_arrays([pa.array(["".join(parts)])], names=["value"])
        for b in batches:
            for page, url, html in zip(*(c.to_pylist() for c in b.columns)):
                if not parts:
                    number += 1
                    version, name = 1 + number % 2, f"pages-{TaskContext.get().partitionId():06d}-{number:05d}.arc"
                    parts.append(arc_head(version, name, date))
                    size = len(parts[0])
                parts.append(arc_record(version, name, date, size, page, url, html or ""))
                size += len(parts[-1])
                if size >= target:
                    yield row()
                    parts = []
        if parts:
            yield row()

    rows = pages.select(F.col(id_col), F.col(url_col), F.col(html_col)).mapInArrow(build, "value string")
    rows.write.option("maxRecordsPerFile", 1).option("compression", "gzip").text(path)


def _content(data: bytes) -> bytes:
    """The bytes of all gzip members, or ``data`` if it has none; zeros after a member are padding.

    The members are fed in short pieces: what a member leaves over is copied, so feeding all the rest to each (as
    ``gzip.decompress`` does) would take time in the square of their number."""
    if data[:2] != b"\x1f\x8b":
        return data
    parts, at, view = [], 0, memoryview(data)
    while at < len(data):
        z = zlib.decompressobj(31)
        while not z.eof:
            piece = view[at : at + PIECE]
            if not piece:
                raise EOFError("the last gzip member does not end")
            parts.append(z.decompress(piece))
            at += len(piece) - len(z.unused_data)
        while data[at : at + 1] == b"\0":
            at += 1
    return b"".join(parts)


def arc_records(data: bytes) -> Iterator[dict]:
    """Records of an ARC file: at (where it starts), url, ip, date, mime, block (and the version-2 fields); the version block first."""
    at, fields = 0, None
    while True:
        while data[at : at + 1] in (b"\n", b"\r"):
            at += 1
        if at >= len(data):
            return
        start, end = at, data.find(b"\n", at)
        if end < 0:
            raise ValueError(f"ARC header at {start} does not end")
        header = data[at:end].rstrip(b"\r")
        if fields is None:  # the version block's own header has the fields that the block is about to name
            names = data[end + 1 :].split(b"\n", 2)[1].split()
            fields = [n.decode().lower() for n in names]
        values = header.decode("utf-8", "replace").rsplit(" ", len(fields) - 1)
        if len(values) != len(fields):
            raise ValueError(f"ARC header at {start} has {len(values)} of {len(fields)} fields")
        row = dict(zip(fields, values))
        n = int(row["archive-length"])
        block = data[end + 1 : end + 1 + n]
        if len(block) < n:
            raise ValueError(f"ARC record at {start} declares {n} bytes, {len(block)} are left")
        yield {**row, "at": start, "version_block": header.startswith(b"filedesc:"), "block": block}
        at = end + 1 + n


def http_parts(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields, header bytes, payload of an HTTP response block; a block of another kind is all payload."""
    if not block.startswith(b"HTTP/"):
        return {}, b"", block
    head, _, payload = block.partition(b"\r\n\r\n")
    lines = (x.decode("utf-8", "replace").partition(":") for x in head.split(b"\r\n")[1:])
    return {k.strip().lower(): v.strip() for k, _, v in lines}, head + b"\r\n\r\n", payload


def _page(fields: dict[str, str]) -> int | None:
    v = fields.get("x-page-id")
    return int(v) if v else None


def warc_record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record without the two line ends that close it."""
    lines = [f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(block)}"]
    return "WARC/1.1\r\n".encode() + "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block


def record_id(url: str, page: object, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_SPACE, f'{page} {digest}' if page is not None else f'{url} {digest}')}>"


def convert(record: dict, refers_to: dict | None) -> bytes:
    """The WARC equivalent of an ARC record; ``refers_to`` (page, known) makes it a revisit."""
    d = record["archive-date"].ljust(14, "0")
    date = f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"
    block, url = record["block"], record["url"]
    sha = lambda b: hashlib.sha256(b).hexdigest()
    if record["version_block"]:
        headers = [("WARC-Record-ID", record_id(url, None, sha(block))), ("WARC-Date", date), ("WARC-Filename", url[len("filedesc://") :])]
        return warc_record("warcinfo", [*headers, ("Content-Type", "text/plain")], block)
    fields, head, payload = http_parts(block)
    digest, page = sha(payload), _page(fields)
    headers = [
        ("WARC-Record-ID", record_id(url, page, digest)), ("WARC-Date", date), ("WARC-Target-URI", url),
        ("WARC-IP-Address", record["ip-address"]), ("WARC-Payload-Digest", f"sha256:{digest}"),
    ]
    if refers_to is not None:
        block = head
        headers += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", record_id(url, refers_to["page"], digest)),
            ("X-Payload-Length", str(len(payload))),  # old responses may declare none, or another one
        ]
        if refers_to["page"] is not None:
            headers.append(("X-Refers-To-Page-Id", str(refers_to["page"])))
    headers += [("WARC-Block-Digest", f"sha256:{sha(block)}")]
    headers += [("Content-Type", "application/http; msgtype=response" if head else record["content-type"])]
    return warc_record("revisit" if refers_to is not None else "response" if head else "resource", headers, block)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, content) -> (path, offset, page, bytes, digest) of the ARC records."""
    for b in batches:
        for path, data in zip(*(c.to_pylist() for c in b.columns)):
            rows = []
            for r in arc_records(_content(data)):
                if not r["version_block"]:
                    fields, _, payload = http_parts(r["block"])
                    rows.append((path, r["at"], _page(fields), len(payload), hashlib.sha256(payload).digest()))
            cols = list(zip(*rows)) if rows else [()] * 5
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            names = ["path", "offset", "page", "bytes", "digest"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)


def member(data: bytes) -> bytes:
    """One gzip member."""
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


LAST = member(b"")  # ends an archive: an empty member, whose last byte (zero) is the one that the text writer adds


def _to_warc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(content, revisits) -> a WARC archive each, without its last byte."""
    for b in batches:
        for data, revisits in zip(*(c.to_pylist() for c in b.columns)):
            known = {r["offset"]: r for r in revisits or ()}
            records = [member(convert(r, known.get(r["at"])) + b"\r\n\r\n") for r in arc_records(_content(data))]
            if records:
                out = b"".join([*records, LAST[:-1]])
                yield pa.RecordBatch.from_arrays([pa.array([out], pa.binary())], names=["value"])


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path)


def arc_to_warc(spark: SparkSession, arc: str, warc: str, min_bytes: int = MIN_BYTES) -> None:
    """Convert every archive under ``arc`` to one under ``warc``."""
    files = _files(spark, arc).select("path", "content")
    rows = scratch_path(spark, "arc-digests")
    files.mapInArrow(_digests, "path string, offset long, page long, bytes long, digest binary").write.parquet(rows)
    rows = spark.read.parquet(rows).filter(F.col("bytes") >= min_bytes)
    place = F.struct(F.col("page").isNull().alias("none"), "page", "path", "offset")
    first = rows.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    revisits = rows.join(first, "digest").filter(place != F.col("first"))
    revisits = revisits.select("path", F.struct("offset", F.col("first.page").alias("page")).alias("r"))
    by_file = scratch_path(spark, "revisits")  # written, so that Spark knows its size
    revisits.groupBy("path").agg(F.collect_list("r").alias("revisits")).write.parquet(by_file)
    joined = files.join(spark.read.parquet(by_file), "path", "left")
    archives = joined.select("content", "revisits").mapInArrow(_to_warc, "value binary")
    text = archives.select(F.col("value").cast("string"))  # the same bytes, whatever they are
    text.write.option("maxRecordsPerFile", 1).option("compression", "none").option("lineSep", "\0").text(warc)


def warc_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while at < len(data):
        if data[at : at + 5] != b"WARC/":
            raise ValueError(f"no WARC record at {at}")
        end = data.index(b"\r\n\r\n", at)
        lines = (x.decode("utf-8", "replace").partition(":") for x in data[at:end].split(b"\r\n")[1:])
        headers = {k.strip().lower(): v.strip() for k, _, v in lines}
        start, n = end + 4, int(headers["content-length"])
        yield headers, data[start : start + n]
        at = start + n + 4


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "warc_date", "record_id"]
    for b in batches:
        for data in b.column(0).to_pylist():
            rows = []
            for h, block in warc_records(_content(data)):
                kind = h["warc-type"]
                if kind == "warcinfo":
                    continue
                fields, _, payload = http_parts(block)
                digest = h["warc-payload-digest"].partition(":")[2]
                size = int(h["x-payload-length"]) if kind == "revisit" else len(payload)
                if kind != "revisit" and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"payload of {h['warc-record-id']} does not match its digest")
                to = h.get("x-refers-to-page-id")
                rows.append((_page(fields), size, digest, kind, int(to) if to else None, h["warc-target-uri"], h["warc-date"], h["warc-record-id"]))
            cols = list(zip(*rows)) if rows else [()] * 8
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """A row per record but warcinfo; digests of payloads are verified."""
    schema = (
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "url string, warc_date string, record_id string"
    )
    return _files(spark, path).select("content").mapInArrow(_read, schema)


def pages_round_trip(pages: DataFrame, target: int = TARGET_BYTES) -> DataFrame:
    """Pages -> ARC archives -> WARC archives -> rows."""
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc, target=target)
    arc_to_warc(spark, arc, warc)
    return read_warc(spark, warc)


ORACLE_SQL = """
SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest,
  CASE WHEN strlen(coalesce(html, '')) >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN strlen(coalesce(html, '')) >= 100 AND page_id <> first THEN first END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)"""
