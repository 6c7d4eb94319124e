"""Legacy archives (ARC, header versions 1 and 2) converted to WARC, with revisit records for equal payloads.

Archives are written and read by Spark's text source in binary-clean form: the record separator is the line separator,
and files are gzip streams, which one task reads whole and in order. Readers trust declared lengths only, so a payload
may hold separators, header look-alikes or any other bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from itertools import groupby
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revmill.llm.shelf import new_path, record_batches, remove_path, table

# Fixed values of the two formats.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
ARC_END = "\n"
WARC_VERSION = "WARC/1.1"
WARC_END = "\r\n\r\n"
PAYLOAD_LENGTH = "X-Payload-Length"  # of the payload that a revisit leaves out; HTTP heads need not tell it
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARC_ROW = pa.schema(
    [("part", pa.string()), ("seq", pa.int64()), ("url", pa.string()), ("ip", pa.string()), ("date", pa.string())]
    + [("mime", pa.string()), ("head", pa.binary()), ("payload", pa.binary()), ("digest", pa.string()), ("payload_bytes", pa.int64())]
    + [("page_id", pa.int64()), ("record_id", pa.string())]
)
ARC_DDL = (
    "part string, seq long, url string, ip string, date string, mime string, head binary, payload binary, digest string, "
    "payload_bytes long, page_id long, record_id string"
)
WARC_ROW = pa.schema(
    [("record_id", pa.string()), ("record_type", pa.string()), ("date", pa.string()), ("url", pa.string())]
    + [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    + [("refers_to_id", pa.string()), ("payload", pa.binary())]
)
WARC_DDL = (
    "record_id string, record_type string, date string, url string, page_id long, payload_bytes long, "
    "payload_digest string, refers_to_id string, payload binary"
)


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


class ByteStream:
    """Bytes of one archive, fed in chunks; holds one chunk and the record being read."""

    def __init__(self, chunks: Iterator[bytes]):
        self.chunks, self.buffer, self.at = chunks, b"", 0

    def _grow(self) -> bool:
        more = next(self.chunks, None)
        if more is None:
            return False
        self.buffer, self.at = self.buffer[self.at :] + more, 0
        return True

    def skip(self, space: bytes) -> bool:
        """Skip these bytes; False at the end of the stream."""
        while True:
            while self.at < len(self.buffer) and self.buffer[self.at] in space:
                self.at += 1
            if self.at < len(self.buffer):
                return True
            if not self._grow():
                return False

    def until(self, mark: bytes) -> bytes:
        start = self.at
        while (found := self.buffer.find(mark, start)) < 0:
            start = max(0, len(self.buffer) - self.at - len(mark) + 1)
            if not self._grow():
                raise ValueError("archive ends inside a record header")
        out, self.at = self.buffer[self.at : found], found + len(mark)
        return out

    def take(self, n: int) -> bytes:
        parts, missing = [], n
        while True:
            part = self.buffer[self.at : self.at + missing]
            parts.append(part)
            self.at += len(part)
            missing -= len(part)
            if not missing:
                return b"".join(parts)
            if not self._grow():
                raise ValueError("archive ends inside a record")


def parse_arc(stream: ByteStream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of one ARC file. The version block names the fields of every header line that follows."""
    if not stream.skip(b"\n"):
        return
    length = int(stream.until(b"\n").rsplit(b" ", 1)[1])
    block = stream.take(length).split(b"\n")
    version, names = int(block[0].split()[0]), block[1].decode().split()
    if ARC_FIELDS.get(version) != " ".join(names):
        raise ValueError(f"unknown ARC header {version}: {names}")
    while stream.skip(b"\n"):
        # Only the URL, the first field, can hold blanks in damaged files.
        values = stream.until(b"\n").decode("utf-8", "replace").rsplit(" ", len(names) - 1)
        record = dict(zip(names, values))
        yield record, stream.take(int(record["Archive-length"]))


def parse_warc(stream: ByteStream) -> Iterator[tuple[dict[str, str], bytes]]:
    while stream.skip(b"\r\n"):
        lines = stream.until(b"\r\n\r\n").decode().split("\r\n")
        if not lines[0].startswith("WARC/1."):
            raise ValueError(f"not a WARC header: {lines[0][:40]!r}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        yield fields, stream.take(int(fields["Content-Length"]))


PAGE_ID = re.compile(r"-?[0-9]{1,18}")
HTTP_END = re.compile(rb"\r?\n\r?\n")


def http_parts(block: bytes) -> tuple[bytes | None, bytes]:
    """Head, with the blank line that ends it, and payload of an HTTP response; other blocks have no head.

    A head ends at the first blank line, with CRLF or bare LF. A block that breaks off before it is passed on whole.
    """
    found = HTTP_END.search(block) if block.startswith(b"HTTP/") else None
    return (block[: found.end()], block[found.end() :]) if found else (None, block)


def http_fields(head: bytes | None) -> dict[str, str]:
    lines = (head or b"").decode("latin-1").replace("\r\n", "\n").split("\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:]) if k}


def page_number(fields: dict[str, str]) -> int | None:
    page = fields.get("x-page-id", "")
    return int(page) if PAGE_ID.fullmatch(page) else None


def _streams(batches: Iterator[pa.RecordBatch], end: str) -> Iterator[tuple[str, ByteStream]]:
    """The archives of a task, one after the other. Rows of a file are adjacent and in order."""
    mark = end.encode()

    def chunks():
        for batch in batches:
            parts, values = batch.column("part").to_pylist(), batch.column("value").to_pylist()
            for part, rows in groupby(zip(parts, values), key=lambda r: r[0]):
                yield part, mark.join([v for _, v in rows]) + mark

    for part, own in groupby(chunks(), key=lambda c: c[0]):
        yield part, ByteStream(c for _, c in own)


def _pieces(spark: SparkSession, path: str, end: str) -> DataFrame:
    return spark.read.option("lineSep", end).text(path).select(
        F.col("_metadata.file_path").alias("part"),
        F.col("value").cast("binary").alias("value"),
    )


def _write_archive(records: DataFrame, path: str, end: str) -> None:
    """Records (one binary column, whole and in order) as gzip files of this separator."""
    records.select(F.col("record").cast("string")).write.option("lineSep", end).option("compression", "gzip").option(
        "zlib.compress.level", "BEST_SPEED"
    ).text(path)


def write_arc(
    pages: DataFrame, path: str, ip: str = "192.0.2.1", date: str = "20240101000000", version: int | None = None
) -> None:
    """Pages (page_id, url, html) as a legacy crawl: one ARC file for each partition, an HTTP response for each row.

    version None alternates versions 1 and 2 between files. A null url is written as "-", a null html as an empty body,
    a null page_id as no X-Page-Id header. Blanks and control characters of a url are percent-encoded.
    """
    row = pa.schema([("record", pa.binary())])

    def records(batches, kind, name):
        intro = f"{kind} 0 revmill\n{ARC_FIELDS[kind]}\n"
        first = f"filedesc://{name} 0.0.0.0 {date} text/plain {len(intro)}\n{intro}".encode()
        at = len(first) + 1
        yield (first,)
        for batch in batches:
            for page, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                html = html or b""
                own = "" if page is None else f"X-Page-Id: {page}\r\n"
                body = (
                    f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                    f"Content-Length: {len(html)}\r\n{own}\r\n"
                ).encode() + html
                address = quote(url, safe="!#$%&'()*+,/:;=?@[]~") if url else "-"
                more = f" 200 {sha1_base32(html)} - {at} {name}" if kind == 2 else ""
                out = f"{address} {ip} {date} text/html{more} {len(body)}\n".encode() + body
                at += len(out) + 1
                yield (out,)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        yield from record_batches(records(batches, version or 1 + part % 2, f"crawl-{part:05d}.arc.gz"), row)

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").cast("binary").alias("html"),
    )
    _write_archive(rows.mapInArrow(write, "record binary"), path, ARC_END)


def read_arc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records of all ARC files below path; part (the file's path) and seq are a record's address.

    head is null for what is no HTTP response: other schemes, as dns:, and bodies without a head. Their payload is the block.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for part, stream in _streams(batches, ARC_END):
                for seq, (record, body) in enumerate(parse_arc(stream)):
                    web = record["URL"].lower().startswith(("http:", "https:")) or record["URL"] == "-"
                    head, payload = http_parts(body) if web else (None, body)
                    page = page_number(http_fields(head))
                    url = None if record["URL"] == "-" else record["URL"]
                    # The same archive always gives the same identifiers.
                    name = f"{part}/{seq} {record['URL']} {record['Archive-date']} {page}"
                    yield (
                        part, seq, url, record["IP-address"], record["Archive-date"], record["Content-type"], head,
                        payload if payloads else None, sha1_base32(payload), len(payload),
                        page, f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}",
                    )

        yield from record_batches(rows(), ARC_ROW)

    return _pieces(spark, path, ARC_END).mapInArrow(read, ARC_DDL)


def warc_date(arc: str) -> str:
    return f"{arc[:4]}-{arc[4:6]}-{arc[6:8]}T{arc[8:10]}:{arc[10:12]}:{arc[12:14]}Z"


def _warc_records(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bytes]]:
    part = TaskContext.get().partitionId()
    started = False

    def record(fields: list[tuple[str, str | None]], block: bytes) -> tuple[bytes]:
        fields = [*fields, ("Content-Length", str(len(block)))]
        lines = [WARC_VERSION, *(f"{k}: {v}" for k, v in fields if v is not None)]
        return ("\r\n".join(lines).encode() + b"\r\n\r\n" + block,)

    for batch in batches:
        for row in batch.to_pylist():
            date = warc_date(row["date"])
            if not started:
                started = True
                name = f"warcinfo/{part} {date}"
                block = b"software: revmill\r\nformat: WARC File Format 1.1\r\nconformsTo: ARC conversion\r\n"
                yield record(
                    [("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>")]
                    + [("WARC-Date", date), ("Content-Type", "application/warc-fields")],
                    block,
                )
            revisit, web = row["refers_id"] is not None, row["head"] is not None
            block = (row["head"] or b"") + (b"" if revisit else row["payload"])
            mime = row["mime"] if "/" in row["mime"] else "application/octet-stream"
            fields = [
                ("WARC-Type", "revisit" if revisit else "response" if web else "resource"),
                ("WARC-Record-ID", f"<{row['record_id']}>"),
                ("WARC-Date", date),
                ("WARC-Target-URI", row["url"]),
                ("WARC-IP-Address", row["ip"]),
                ("Content-Type", "application/http;msgtype=response" if web else mime),
                ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
                ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
            ]
            if revisit:
                fields += [
                    (PAYLOAD_LENGTH, str(row["payload_bytes"])),
                    ("WARC-Profile", REVISIT_PROFILE),
                    ("WARC-Refers-To", f"<{row['refers_id']}>"),
                    ("WARC-Refers-To-Target-URI", row["refers_url"]),
                    ("WARC-Refers-To-Date", warc_date(row["refers_date"])),
                ]
            yield record(fields, block)


def convert_arc(spark: SparkSession, arc_path: str, warc_path: str, min_bytes: int = 0) -> None:
    """ARC files to WARC files. Of records with equal payloads of at least min_bytes, the one with the smallest page id
    is a response and the others revisit it; smaller payloads are all responses. What is no HTTP response becomes a
    resource record of its declared type with the whole block, and neither revisits nor is revisited.

    A record without a page id comes after all others; among equal ids the first in the archive is the response.
    The first pass reads digests only. Copies are found by an aggregate over narrow rows, which combines before the
    exchange, so a payload that a third of all pages share costs no large task; payloads move once, by their address.
    """
    first = read_arc(spark, arc_path, payloads=False)
    order = F.struct(
        F.col("page_id").isNull().alias("last"), "page_id", "part", "seq", "record_id", "url", "date",
    )
    web = first.where("head IS NOT NULL")
    heads = web.where(F.col("payload_bytes") >= min_bytes).groupBy("digest", "payload_bytes").agg(
        F.min(order).alias("head"), F.count("*").alias("n")
    )
    revisits = (
        web.select("part", "seq", "digest", "payload_bytes")
        .join(heads.where("n > 1").drop("n"), ["digest", "payload_bytes"])
        .where((F.col("part") != F.col("head.part")) | (F.col("seq") != F.col("head.seq")))
        .select(
            "part", "seq", F.col("head.record_id").alias("refers_id"),
            F.col("head.url").alias("refers_url"), F.col("head.date").alias("refers_date"),
        )
    )
    row = pa.schema([("record", pa.binary())])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from record_batches(_warc_records(batches), row)

    records = read_arc(spark, arc_path).join(revisits.hint("shuffle_hash"), ["part", "seq"], "left")
    _write_archive(records.mapInArrow(write, "record binary"), warc_path, WARC_END)


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Response, revisit and resource records of all WARC files below path. A payload that its digest contradicts is an error."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for _, stream in _streams(batches, WARC_END):
                for fields, block in parse_warc(stream):
                    kind = fields["WARC-Type"]
                    if kind not in ("response", "revisit", "resource"):
                        continue
                    web = fields.get("Content-Type", "").startswith("application/http")
                    head, payload = http_parts(block) if web and kind != "resource" else (None, block)
                    http = http_fields(head)
                    digest = fields.get("WARC-Payload-Digest", "").removeprefix("sha1:")
                    if kind != "revisit" and sha1_base32(payload) != (digest := digest or sha1_base32(payload)):
                        raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")
                    length = fields.get(PAYLOAD_LENGTH, http.get("content-length"))
                    refers = fields.get("WARC-Refers-To")
                    yield (
                        fields["WARC-Record-ID"].strip("<>"), kind, fields["WARC-Date"], fields.get("WARC-Target-URI"),
                        page_number(http),
                        len(payload) if kind != "revisit" else None if length is None else int(length), digest,
                        refers and refers.strip("<>"), payload if payloads and kind != "revisit" else None,
                    )

        yield from record_batches(rows(), WARC_ROW)

    return _pieces(spark, path, WARC_END).mapInArrow(read, WARC_DDL)


def op4_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as ARC, converted to WARC, read back: one row for each page."""
    arc, warc = new_path(spark, "arc"), new_path(spark, "warc")
    write_arc(table(spark, sf_dir, "pages"), arc)
    convert_arc(spark, arc, warc)
    remove_path(spark, arc)
    records = read_warc(spark, warc, payloads=False).drop("payload")
    target = records.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to_id"), F.col("page_id").alias("refers_to")
    )
    return records.join(target, "refers_to_id", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


SQL_OP4 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS n, upper(sha1(h)) AS x, min(page_id) OVER (PARTITION BY h) AS first FROM p),
b AS (SELECT *, list_transform(range(8), lambda i: ('0x' || substr(x, 1 + 5 * i, 5))::INTEGER) AS v FROM d)
SELECT page_id, n AS payload_bytes,
  list_aggregate(list_transform(v, lambda q: concat(
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((q >> 15) & 31), 1),
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((q >> 10) & 31), 1),
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((q >> 5) & 31), 1),
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (q & 31), 1))), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM b
"""
