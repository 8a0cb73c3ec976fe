"""Archives: both versions, payloads of all kinds, damaged files, and the read-back."""

import base64
import hashlib

import pytest

from starloom.llm.warc import (
    LineStream, archived, convert, digest, parse_arc, parse_warc, read_warc, warc_record,
)
from starloom.session import scratch_path

VERSION_1 = (b"filedesc://old.arc 0.0.0.0 19970101000000 text/plain 78\n1 0 Some Archive\n"
             b"URL IP-address Archive-date Content-type Archive-length\n\n\n\n\n\n\n\n")


def split(data):
    lines = data.split(b"\n")
    return iter(lines[:-1] if lines[-1] == b"" else lines)


def block_of(body, page=None):
    head = b"HTTP/1.0 200 OK\r\nContent-Type: text/html\r\n"
    return head + (f"X-Page-Id: {page}\r\n".encode() if page is not None else b"") + b"\r\n" + body


def arc(version, records, short=0):
    fields = {1: "URL IP-address Archive-date Content-type Archive-length",
              2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"}
    about = f"{version} 0 x\n{fields[version]}\n".encode()
    more = b" 200 - - 0 f.arc" if version == 2 else b""
    out = b"filedesc://f.arc 0.0.0.0 20240101000000 text/plain" + more + f" {len(about)}\n".encode() + about + b"\n"
    for url, block in records:
        out += url + b" 1.2.3.4 20240102030405 text/html" + more + f" {len(block) - short}\n".encode() + block + b"\n"
    return out


@pytest.mark.parametrize("version", [1, 2])
def test_records_by_declared_length(version):
    bodies = [b"", b"\n", b"a\nb\r\n\r\nhttp://x 1.2.3.4 20240102030405 text/html 5\n", "é\n\n".encode(), b"\r\n"]
    records = [(f"http://h/{k}".encode(), block_of(b, k)) for k, b in enumerate(bodies)]
    got = list(parse_arc(split(arc(version, records))))
    assert [r["payload"] for r in got] == bodies and [r["page_id"] for r in got] == list(range(5))
    assert [r["url"] for r in got] == [f"http://h/{k}" for k in range(5)] and not any(r["cut"] for r in got)


def test_damaged_archives():
    records = [(b"http://h/0", block_of(b"abcdef", 0)), (b"http://h/1", block_of(b"xyz", 1))]
    short = list(parse_arc(split(arc(1, records, short=2))))
    assert [r["payload"] for r in short] == [b"abcd", b"x"]
    data = arc(2, records)
    cut = list(parse_arc(split(data[:-3])))
    assert cut[0]["payload"] == b"abcdef" and cut[1]["cut"] and cut[1]["payload"] == b"x"
    assert list(parse_arc(split(b""))) == [] and list(parse_arc(split(b"no archive\nat all\n"))) == []
    assert list(parse_arc(split(VERSION_1))) == []


def test_stream():
    s = LineStream(iter([b"ab", b"", b"cd"]))
    assert s.take(1) == b"a" and s.line() == b"b" and s.line() == b"" and s.take(2) == b"cd"
    assert s.line() == b"" and s.line() is None


def test_records_round_trip():
    record = {"url": "http://h/é", "date": "20240102030405", "mime": "text/html", "page_id": 7,
              "head": b"HTTP/1.0 200 OK\r\n\r\n", "payload": b"WARC/1.1\r\n\r\n\n", "cut": False}
    response = {"url": "http://h/o", "date": "2024", "page_id": 9}
    one, two = warc_record(record, digest(record["payload"]), None), warc_record(record, "X", response)
    a, b = parse_warc(split(one + b"\r\n\r\n" + two + b"\r\n\r\n"))
    assert a["block"] == record["head"] + record["payload"] and b["block"] == record["head"]
    assert a["headers"]["WARC-Type"] == "response" and a["headers"]["WARC-Date"] == "2024-01-02T03:04:05Z"
    assert b["headers"]["X-Refers-To-Page"] == "9" and b["headers"]["WARC-Refers-To"].startswith("<urn:uuid:")
    assert b["headers"]["WARC-Refers-To-Date"] == "2024-01-01T00:00:00Z"


def test_pages_come_back(spark):
    pages = [(1, "http://a/ b", "<p>é</p>\r\n\r\nWARC/1.1\r\n"), (2, None, None), (3, "http://a", ""),
             (4, "u", "same"), (9, "u", "same"), (5, "u", "same"), (9, "v", "same"), (None, "u", "x"), (None, "u", "same"),
             (-3, "neg", "other"), (10, "long", "ab\n" * 700_000)]
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id bigint, url string, html string, payload_digest string")
    got = archived(df.repartition(3)).collect()
    assert len(got) == len(pages) and all(r.intact for r in got)
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append((r.payload_bytes, r.payload_digest, r.record_type, r.refers_to))

    def named(html):
        raw = (html or "").encode()
        return len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode()

    assert by[1] == [(*named(pages[0][2]), "response", None)]
    assert by[2] == [(*named(""), "revisit", 3)] and by[3] == [(*named(""), "response", None)]
    assert by[4] == by[5] == [(*named("same"), "revisit", 9)]
    assert sorted(by[9], key=str) == sorted([(*named("same"), "response", None), (*named("same"), "revisit", 9)], key=str)
    assert sorted(by[None], key=str) == sorted([(*named("x"), "response", None), (*named("same"), "revisit", 9)], key=str)
    assert by[-3][0][2] == "response" and by[10] == [(*named(pages[10][2]), "response", None)]
    ids = {r.record_id for r in got}
    assert len(ids) >= len(pages) - 1
    assert archived(df.limit(0)).collect() == []


def test_foreign_archive(spark):
    folder = scratch_path(spark, "foreign")
    spark.createDataFrame([(VERSION_1.decode(),)], "v string").coalesce(1).write.option("compression", "gzip").text(folder)
    out = scratch_path(spark, "out")
    convert(spark, folder, out)
    assert read_warc(spark, out).collect() == []
