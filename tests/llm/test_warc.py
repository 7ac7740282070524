"""ARC and WARC archives: formats by hand, and round trips."""

from __future__ import annotations

import gzip

import pytest
from pyspark.sql import functions as F

from yieldlens.llm import warc

V1 = b"1 0 crawler\nURL IP-address Archive-date Content-type Archive-length\n"
V2 = b"2 0 crawler\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n"
ANSWER = b"HTTP/1.0 200 OK\r\nX-Page-Id: 3\r\n\r\nbody\x00\xff\n\n"


def described(said: bytes) -> bytes:
    return b"filedesc://a.arc 0.0.0.0 19990101000000 text/plain %d\n%s\n" % (len(said), said)


def one(version: int, url: bytes, mime: bytes, block: bytes, date: bytes = b"20010203040506") -> bytes:
    more = b" 200 - - 0 a.arc" if version == 2 else b""
    return b"%s 1.2.3.4 %s %s%s %d\n%s\n" % (url, date, mime, more, len(block), block)


def test_both_versions_and_joined_archives():
    content = described(V1) + one(1, b"http://a/", b"text/html; charset=x", ANSWER) + one(1, b"dns:a", b"text/dns", b"1.2.3.4 \n")
    content += described(V2) + one(2, b"http://b/", b"text/html", b"") + b"\n" + one(2, b"http://c/", b"a b c", b"x\n")
    for data in (content, gzip.compress(content), gzip.compress(content[:100]) + gzip.compress(content[100:])):
        got = list(warc.arc_records(data))
        assert [(f["url"], f["mime"], block) for _, f, block in got] == [
            ("http://a/", "text/html; charset=x", ANSWER), ("dns:a", "text/dns", b"1.2.3.4 \n"), ("http://b/", "text/html", b""), ("http://c/", "a b c", b"x\n"),
        ]
        assert got[2][1]["status"] == "200" and "status" not in got[0][1]
        assert all(content[offset:].startswith(f["url"].encode()) for offset, f, _ in got)


@pytest.mark.parametrize("bad", [b"http://a 1.2.3.4 20010101000000 text/html 3\nabc\n", described(V1) + b"broken line\n", described(V1) + one(1, b"u", b"m", b"abc")[:-3]])
def test_broken_archives_fail(bad):
    with pytest.raises(ValueError):
        list(warc.arc_records(bad))


def test_heads_and_dates():
    assert warc._http(ANSWER) == (True, ANSWER[: ANSWER.index(b"body")], b"body\x00\xff\n\n")
    assert warc._http(b"plain") == (False, b"", b"plain") and warc._http(b"HTTP/1.0 200 OK") == (True, b"HTTP/1.0 200 OK", b"")
    # The head ends at the first blank line, whatever stands in the body.
    assert warc._http(b"HTTP/1.0 200 OK\nA: b\n\nbody\r\n\r\nmore") == (True, b"HTTP/1.0 200 OK\nA: b\n\n", b"body\r\n\r\nmore")
    times = {"200102030405": "2001-02-03T04:05:00Z", "20010203": "2001-02-03T00:00:00Z", "2001": "2001-01-01T00:00:00Z", "20011303040506": None, "2001020": None, "": None}
    assert {d: warc._iso(d) for d in times} == {d: t or "1970-01-01T00:00:00Z" for d, t in times.items()}
    assert warc._iso("20010203040506") == "2001-02-03T04:05:06Z" and warc._iso("soon") == "1970-01-01T00:00:00Z"


def test_conversion(spark, tmp_path):
    (tmp_path / "arc").mkdir()
    head = b"HTTP/1.1 200 OK\r\nX-Page-Id: %d\r\n\r\n"
    same = [one(1, b"http://s/%d" % i, b"text/html", head % i + b"same") for i in (5, 9, 7)]
    other = [one(1, b"dns:x", b"text/dns", b"same"), one(1, b"http://e/1", b"text/html", head % 1), one(1, b"http://e/2", b"text/html", head % 2)]
    (tmp_path / "arc" / "1.arc").write_bytes(described(V1) + b"".join(same[:2] + other))
    (tmp_path / "arc" / "2.arc.gz").write_bytes(gzip.compress(described(V1) + same[2] + one(1, b"http://b/", b"image/x", head % 8 + bytes(range(256)))))
    page = F.regexp_extract("head", r"\r\nX-Page-Id: (-?[0-9]+)\r\n", 1).try_cast("long")
    read = warc.read_arc(spark, str(tmp_path / "arc"))
    assert read.count() == 7 and read.select("record_id").distinct().count() == 7
    for least, empties in ((0, {"revisit", "response"}), (1, {"response"})):
        warc.write_warc(read, str(tmp_path / f"warc{least}"), page, least)
        rows = warc.read_warc(spark, str(tmp_path / f"warc{least}")).withColumn("page", page).collect()
        by = {r.url: r for r in rows}
        assert len(rows) == 7 and by["dns:x"].record_type == "resource"
        assert [by[f"http://s/{i}"].record_type for i in (5, 7, 9)] == ["revisit", "revisit", "response"]
        assert {by["http://e/1"].record_type, by["http://e/2"].record_type} == empties and by["http://e/2"].record_type == "response"
        full = by["http://s/9"]
        assert by["http://s/5"].refers_to == full.record_id and by["http://s/5"].declared_digest == full.payload_digest == warc.digest(b"same")
        assert full.date == "2001-02-03T04:05:06Z" and full.payload_bytes == 4 and full.page == 9
        assert by["http://b/"].payload_digest == warc.digest(bytes(range(256)))
        assert all(r.declared_block_digest in (None, r.block_digest) for r in rows)


def test_nulls_in_any_field(spark, tmp_path):
    names = ("url", "ip", "date", "mime", "version", "block")
    whole = ("http://a/", "1.2.3.4", "20010203040506", "text/plain", 1, bytearray(b"block"))
    rows = [whole, *[tuple(None if i == k else v for i, v in enumerate(whole)) for k in range(6)]]
    schema = ", ".join(f"{n} {k}" for n, k in zip(names, ("string", "string", "string", "string", "int", "binary"), strict=True))
    warc.write_arc(spark.createDataFrame(rows, schema), str(tmp_path / "arc"))
    read = warc.read_arc(spark, str(tmp_path / "arc"))
    assert read.count() == 7 and read.filter("length(block) = 5").count() == 6
    gone = read.limit(1)
    for column in ("url", "ip", "date", "mime", "block", "head"):
        gone = gone.unionByName(read.limit(1).withColumn(column, F.lit(None).cast(dict(read.dtypes)[column])))
    warc.write_warc(gone, str(tmp_path / "warc"), F.lit(1))
    assert warc.read_warc(spark, str(tmp_path / "warc")).count() == 7


def test_all_pages_against_plain_python(spark):
    import base64
    import hashlib

    from tests.conftest import SMALL
    from yieldlens.llm.queries import op5_arc_to_warc

    pages = [(r.page_id, (r.html or "").encode()) for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()]
    last = {}
    for page, payload in pages:
        last[payload] = max(page, last.get(payload, page))
    wanted = sorted(
        (p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), *(("response", -1) if last[b] == p else ("revisit", last[b]))) for p, b in pages
    )
    got = sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, -1 if r.refers_to is None else r.refers_to) for r in op5_arc_to_warc(spark, SMALL).collect())
    assert got == wanted


def test_pages_with_nulls_copies_and_odd_addresses(spark, tmp_path):
    from yieldlens.llm.queries import op5_arc_to_warc

    rows = [(1, "http://a b/\n", "<p>é</p>"), (2, None, None), (3, "", ""), (4, "http://a", "<p>é</p>"), (None, "http://n", "<p>é</p>"), (5, "x", "WARC/1.1\r\n\r\n"), (5, "x", "WARC/1.1\r\n\r\n")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted((r.page_id or 0, r.payload_bytes, r.record_type, r.refers_to) for r in op5_arc_to_warc(spark, str(tmp_path)).collect())
    assert got == [(0, 9, "revisit", 4), (1, 9, "revisit", 4), (2, 0, "revisit", 3), (3, 0, "response", None), (4, 9, "response", None)] + sorted([(5, 12, "response", None), (5, 12, "revisit", 5)], key=str)
    spark.createDataFrame([], "page_id long, url string, html string").write.parquet(str(tmp_path / "none" / "pages.parquet"))
    assert op5_arc_to_warc(spark, str(tmp_path / "none")).count() == 0
