import hashlib

import pytest
from pyspark.sql import functions as F

from revmill.llm import warc as W
from revmill.llm.shelf import new_path

SCHEMA = "page_id long, url string, html string, extra string"
BODIES = [
    "<p>plain</p>",
    "ends with blank lines\r\n\r\n\r\n",
    "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n",
    "http://x 1.2.3.4 20200101000000 text/html 5\nhello\n",
    "",
    None,
    "<p>plain</p>",
    "\n",
    "ünï 漢字 😀\r",
    "long " * 200_000,
    "<p>plain</p>",
    "\r\n",
]


def pages(spark):
    rows = [(100 - i, f"http://h.example/{i}?q=a b", t, "e") for i, t in enumerate(BODIES)]
    rows += [(None, None, "no id", None), (3, "", "same id", None), (3, "", "same id", None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def convert(spark, df, version=None, min_bytes=0):
    arc, warc = new_path(spark, "t-arc"), new_path(spark, "t-warc")
    W.write_arc(df, arc, version=version)
    W.convert_arc(spark, arc, warc, min_bytes)
    return arc, W.read_warc(spark, warc).collect()


@pytest.mark.parametrize("version", [1, 2, None])
def test_round_trip(spark, version):
    arc, records = convert(spark, pages(spark), version)
    assert len(records) == 15
    by_id = {r.record_id: r for r in records}
    assert len(by_id) == 15
    want = {100 - i: (t or "").encode() for i, t in enumerate(BODIES)} | {None: b"no id", 3: b"same id"}
    for r in records:
        data = want[r.page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(data), W.sha1_base32(data))
        if r.record_type == "response":
            assert bytes(r.payload) == data and r.refers_to_id is None
        else:
            assert by_id[r.refers_to_id].record_type == "response"
            assert by_id[r.refers_to_id].payload_digest == r.payload_digest
    heads = {r.payload_digest: r.page_id for r in records if r.record_type == "response"}
    assert len(heads) == len({hashlib.sha1(d).digest() for d in want.values()}) == len([r for r in records if r.record_type == "response"])
    assert heads[W.sha1_base32(b"<p>plain</p>")] == 90 and heads[W.sha1_base32(b"")] == 95
    urls = {r.page_id: r.url for r in records}
    assert urls[100] == "http://h.example/0?q=a%20b" and urls[None] is None


def test_same_archive_same_identifiers(spark):
    arc, first = convert(spark, pages(spark))
    warc = new_path(spark, "t-warc")
    W.convert_arc(spark, arc, warc)
    again = W.read_warc(spark, warc).collect()
    assert sorted(r.record_id for r in again) == sorted(r.record_id for r in first)


def test_smaller_payloads_are_all_responses(spark):
    _, records = convert(spark, pages(spark), min_bytes=12)
    kinds = {(r.payload_bytes, r.record_type) for r in records}
    assert (12, "revisit") in kinds and (0, "revisit") not in kinds and (7, "revisit") not in kinds


def test_bytes_that_are_no_text(spark):
    df = spark.range(4).select(
        F.col("id").alias("page_id"), F.lit("http://a").alias("url"), F.unhex(F.lit("FFFE0D0A0D0A80")).cast("string").alias("html")
    )
    _, records = convert(spark, df)
    assert {bytes(r.payload) for r in records if r.payload is not None} == {bytes.fromhex("FFFE0D0A0D0A80")}
    assert sorted(r.record_type for r in records) == ["response", "revisit", "revisit", "revisit"]


def test_header_versions():
    for version, fields in W.ARC_FIELDS.items():
        intro = f"{version} 0 o\n{fields}\n"
        more = " 200 X - 9 f" if version == 2 else ""
        data = f"filedesc://f 0.0.0.0 20200101000000 text/plain {len(intro)}\n{intro}\nhttp://a b 1.1.1.1 20200101000000 text/html{more} 3\nabc\n"
        for step in (1, 7, 1000):
            chunks = (data.encode()[i : i + step] for i in range(0, len(data), step))
            ((record, body),) = W.parse_arc(W.ByteStream(chunks))
            assert body == b"abc" and record["URL"] == "http://a b" and record["IP-address"] == "1.1.1.1"


def test_unknown_header_and_damage():
    bad = b"filedesc://f 0.0.0.0 20200101000000 text/plain 12\n9 0 o\nA B C\n\n"
    with pytest.raises(ValueError, match="unknown ARC header"):
        list(W.parse_arc(W.ByteStream(iter([bad]))))
    with pytest.raises(ValueError, match="ends inside"):
        list(W.parse_warc(W.ByteStream(iter([b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc"]))))


def test_empty(spark):
    assert convert(spark, spark.createDataFrame([], SCHEMA))[1] == []


def test_legacy_records(spark):
    """dns: records, bodies without a head and heads with bare LF, in files of any name, as other crawlers wrote them."""
    dns = [b"20200101000000\na.example. 60 IN A 192.0.2.1\n", b"20200101000000\nb.example. 60 IN A 192.0.2.2\n"]
    old = b"<html>no head</html>"
    bare = b"HTTP/1.0 200 OK\nContent-Type: text/plain\n\nsame body\n\nrest"
    crlf = b"HTTP/1.1 200 OK\r\nContent-Type: text/plain\r\n\r\nsame body\n\nrest"
    cut = b"HTTP/1.1 200 OK\r\nX-Page-Id: 7"
    records = [
        ("dns:a.example", "text/dns", dns[0]), ("dns:b.example", "text/dns", dns[1]), ("http://a/old", "text/html", old),
        ("http://a/bare", "text/plain", bare), ("http://a/crlf", "text/plain", crlf), ("http://a/cut", "no-type", cut),
    ]
    intro = f"1 0 o\n{W.ARC_FIELDS[1]}\n"
    text = f"filedesc://f 0.0.0.0 20200101000000 text/plain {len(intro)}\n{intro}\n"
    for url, mime, body in records:
        text += f"{url} 192.0.2.1 20200101000000 {mime} {len(body)}\n{body.decode()}\n"
    folder, warc = new_path(spark, "t-arc"), new_path(spark, "t-warc")
    for name in ("first", "second"):
        row = spark.createDataFrame([(text[:-1],)], "record string").coalesce(1)
        row.write.option("lineSep", "\n").option("compression", "gzip").text(f"{folder}/crawl={name}")
    W.convert_arc(spark, f"{folder}/*", warc)
    got = W.read_warc(spark, warc).collect()
    assert len(got) == 12 and len({r.record_id for r in got}) == 12
    by_url = {}
    for r in got:
        by_url.setdefault(r.url, []).append(r)
    for url, body in (("dns:a.example", dns[0]), ("dns:b.example", dns[1]), ("http://a/old", old), ("http://a/cut", cut)):
        assert [(r.record_type, bytes(r.payload), r.payload_bytes) for r in by_url[url]] == [("resource", body, len(body))] * 2
    pages = by_url["http://a/bare"] + by_url["http://a/crlf"]
    assert sorted(r.record_type for r in pages) == ["response", "revisit", "revisit", "revisit"]
    assert {(r.payload_bytes, r.payload_digest) for r in pages} == {(15, W.sha1_base32(b"same body\n\nrest"))}
    whole = "".join(r.value for r in spark.read.option("lineSep", W.WARC_END).text(warc).collect())
    assert whole.count("Content-Type: text/dns") == 4 and whole.count("Content-Type: application/octet-stream") == 2
