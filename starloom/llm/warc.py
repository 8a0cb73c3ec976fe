"""Legacy archives (ARC) to WARC.

An ARC file begins with a version block, which names the fields of the record lines: five in
version 1, ten in version 2. A record is one such line and as many bytes as it declares. Files
are read as lines that end in LF and put together again by declared length, so payloads may
hold anything, and a task never holds more than one record and one batch of lines. The files
are gzip, which Spark does not split: the lines of a file reach one task, in order.

Converting takes two passes over the archive. The first reads only (digest, page id) of each
record and picks the response of each group of equal payloads, pre-aggregated per task. The
second writes the records; the others of a group become revisits without payload.

Defined cases: a null html or url is empty. An empty payload has a digest like any other. A null
page_id is written without its header and sorts below all others. Rows that repeat a page_id
with one payload: the first in the archive is the response. Fewer bytes than declared: the
record is marked `cut` and kept as it is. More bytes than declared: the surplus is skipped up
to the next line that is a record line. An empty table gives files without records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.session import scratch_path, written

# The record lines of the two versions.
FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename "
       "Archive-length",
}
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
PAGE, BODY_LENGTH = "X-Page-Id", "Content-Length"
FIRST_DAY = datetime(2024, 1, 1, tzinfo=timezone.utc)


class LineStream:
    """A byte stream over lines that have lost their LF."""

    def __init__(self, lines: Iterator[bytes]):
        self.lines, self.left = iter(lines), b""

    def line(self) -> bytes | None:
        head, self.left = self.left, b""
        at = head.find(b"\n")
        if at >= 0:
            self.left = head[at + 1:]
            return head[:at]
        line = next(self.lines, None)
        return (head or None) if line is None else head + line

    def take(self, size: int) -> bytes:
        parts, have = [self.left], len(self.left)
        while have < size and (line := next(self.lines, None)) is not None:
            parts += [line, b"\n"]
            have += len(line) + 1
        data = b"".join(parts)
        self.left = data[size:]
        return data[:size]


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def split_http(block: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Headers by name, the header bytes with their blank line, the payload."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap or not head.startswith(b"HTTP/"):
        return {}, b"", block
    pairs = (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {k: v.strip() for k, _, v in pairs}, head + gap, body


def quoted(url: str | None) -> str:
    """The URL as one field: blanks and control characters as %XX."""
    url = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    return url or "-"


def unquoted(url: str) -> str:
    return "" if url == "-" else url


def arc_records(rows, version: int, name: str) -> Iterator[bytes]:
    """The version block and a record for each (page_id, url, html), without the closing LF."""
    about = f"{version} 0 starloom\n{FIELDS[version]}\n"
    begin = FIRST_DAY.strftime("%Y%m%d%H%M%S")
    more = "" if version == 1 else f" 200 - - 0 {name}"
    yield f"filedesc://{name} 0.0.0.0 {begin} text/plain{more} {len(about)}\n{about}".encode()
    offset = 0
    for page_id, url, html in rows:
        body = (html or "").encode("utf-8", "surrogatepass")
        head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        if page_id is not None:
            head += f"{PAGE}: {page_id}\r\n"
        block = f"{head}{BODY_LENGTH}: {len(body)}\r\n\r\n".encode() + body
        date = (FIRST_DAY + timedelta(seconds=(page_id or 0) % 10**9)).strftime("%Y%m%d%H%M%S")
        more = "" if version == 1 else f" 200 {digest(body)} - {offset} {name}"
        line = f"{quoted(url)} 0.0.0.0 {date} text/html{more} {len(block)}\n".encode()
        offset += len(line) + len(block) + 1
        yield line + block


def parse_arc(lines: Iterator[bytes]) -> Iterator[dict]:
    """The records of one ARC file, after its version block."""
    stream, fields = LineStream(lines), None
    while (line := stream.line()) is not None:
        parts = line.decode("utf-8", "replace").split(" ")
        if line.startswith(b"filedesc://") and parts[-1].isdigit():
            about = stream.take(int(parts[-1])).decode("utf-8", "replace").split("\n")
            fields = about[1].split() if len(about) > 1 else None
        elif fields and len(parts) == len(fields) and parts[-1].isdigit():
            record = dict(zip(fields, parts))
            length = int(parts[-1])
            block = stream.take(length)
            if block and len(block) < length and block.endswith(b"\n"):
                block = block[:-1]  # the LF that ends the file
            headers, head, payload = split_http(block)
            page = headers.get(PAGE, "")
            yield {
                "url": unquoted(record["URL"]),
                "date": record["Archive-date"],
                "mime": record["Content-type"],
                "page_id": int(page) if re.fullmatch(r"-?\d+", page) else None,
                "head": head,
                "payload": payload,
                "cut": len(block) < length,
            }


def write_arc(pages: DataFrame, path: str) -> None:
    """One ARC file for each partition, of version 1 or 2 in turn."""

    def pack(batches):
        part = TaskContext.get().partitionId()
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        held, size = [], 0
        for record in arc_records(rows, 1 + part % 2, f"legacy-{part:05d}.arc"):
            held.append(record)
            size += len(record)
            if size > 1 << 21:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["value"])
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], ["value"])

    records = pages.select("page_id", "url", "html").mapInArrow(pack, "value binary")
    _write_bytes(records, path, "\n")


def _write_bytes(records: DataFrame, path: str, end: str) -> None:
    """Each value and the closing bytes: Spark's text files write a string's bytes as they are."""
    text = records.select(F.col("value").cast("string"))
    text.write.options(**GZIP).option("lineSep", end).text(path)


def _read_lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_name").alias("file"), F.col("value").cast("binary").alias("line")
    )


def _by_file(batches, parse) -> Iterator[tuple[str, int, dict]]:
    """(file, number in the file, record): the lines of a file follow each other in a task."""
    lines = (x for b in batches for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
    for file, group in groupby(lines, key=lambda x: x[0]):
        for n, record in enumerate(parse(line for _, line in group)):
            yield file, n, record


def _batches(rows: Iterator[tuple], schema: pa.Schema, sizes) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sizes(row)
        if size > 1 << 21 or len(held) >= 4096:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema
            )
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema
        )


def _iso(date: str) -> str:
    """14 digits (or fewer) to a WARC date."""
    digits = (re.sub(r"\D", "", date) + "00000101000000"[len(re.sub(r"\D", "", date)):])[:14]
    try:
        at = datetime.strptime(digits, "%Y%m%d%H%M%S")
    except ValueError:
        at = FIRST_DAY
    return at.strftime("%Y-%m-%dT%H:%M:%SZ")


def record_id(url: str, date: str, page_id, payload_digest: str) -> str:
    name = f"{url} {date} {'' if page_id is None else page_id} sha1:{payload_digest}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def warc_record(record: dict, payload_digest: str, response: dict | None) -> bytes:
    """A response, or a revisit of `response` (its url, date and page id)."""
    date = _iso(record["date"])
    block = record["head"] + (b"" if response else record["payload"])
    kind = "revisit" if response else "response"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(record['url'], date, record['page_id'], payload_digest)}",
        f"WARC-Target-URI: {record['url']}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{payload_digest}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        f"WARC-Identified-Payload-Type: {record['mime']}",
        f"X-Payload-Length: {len(record['payload'])}",
    ]
    if record["page_id"] is not None:
        lines.append(f"{PAGE}: {record['page_id']}")
    if record["cut"]:
        lines.append("WARC-Truncated: unspecified")
    if response:
        at = _iso(response["date"])
        to = record_id(response["url"], at, response["page_id"], payload_digest)
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {to}",
            f"WARC-Refers-To-Target-URI: {response['url']}",
            f"WARC-Refers-To-Date: {at}",
        ]
        if response["page_id"] is not None:
            lines.append(f"X-Refers-To-Page: {response['page_id']}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block


def parse_warc(lines: Iterator[bytes]) -> Iterator[dict]:
    stream = LineStream(lines)
    while (line := stream.line()) is not None:
        if not line.startswith(b"WARC/"):
            continue
        headers = {}
        while (line := stream.line()) not in (None, b"\r", b""):
            name, _, value = line.decode("utf-8", "replace").rstrip("\r").partition(":")
            headers[name.strip()] = value.strip()
        block = stream.take(int(headers.get("Content-Length", "0")))
        yield {"headers": headers, "block": block}


def convert(spark: SparkSession, arc: str, warc: str) -> None:
    """Write the records of the ARC files in folder `arc` as WARC files to folder `warc`."""
    light = pa.schema([
        ("file", pa.string()), ("n", pa.int64()), ("page_id", pa.int64()),
        ("url", pa.string()), ("date", pa.string()), ("digest", pa.string()),
    ])
    full = pa.schema([*light, ("mime", pa.string()), ("head", pa.binary()),
                      ("payload", pa.binary()), ("cut", pa.bool_())])

    def read(batches, whole):
        def rows():
            for file, n, r in _by_file(batches, parse_arc):
                row = (file, n, r["page_id"], r["url"], r["date"], digest(r["payload"]))
                yield (*row, r["mime"], r["head"], r["payload"], r["cut"]) if whole else row

        return _batches(rows(), full if whole else light, lambda r: len(r[8]) if whole else 100)

    lines = _read_lines(spark, arc)
    ddl = "file string, n bigint, page_id bigint, url string, date string, digest string"
    keys = lines.mapInArrow(lambda b: read(b, False), ddl)
    # The largest page id, and of its repeats the first in the archive.
    first = F.struct("page_id", F.col("file"), (-F.col("n")).alias("back"), "url", "date")
    groups = keys.groupBy("digest").agg(F.max(first).alias("first"), F.count("*").alias("members"))
    repeated = written(groups.where("members > 1").select("digest", "first"), "repeated")
    records = lines.mapInArrow(
        lambda b: read(b, True),
        f"{ddl}, mime string, head binary, payload binary, cut boolean",
    )
    joined = records.join(repeated, "digest", "left")
    itself = (F.col("first.file") == F.col("file")) & (F.col("first.back") == -F.col("n"))
    other = F.col("first").isNotNull() & ~F.coalesce(itself, F.lit(False))
    to = [F.when(other, F.col(f"first.{c}")).alias(f"to_{c}") for c in ("page_id", "url", "date")]
    # A revisit goes on without its payload: only the length is needed.
    chosen = joined.select("page_id", "url", "date", "digest", "mime", "head", "payload", "cut",
                           other.alias("other"), *to)

    def pack(batches):
        def rows():
            for b in batches:
                for r in b.to_pylist():
                    to = {c: r[f"to_{c}"] for c in ("page_id", "url", "date")} if r["other"] else None
                    yield (warc_record(r, r["digest"], to),)

        return _batches(rows(), pa.schema([("value", pa.binary())]), lambda r: len(r[0]))

    _write_bytes(chosen.mapInArrow(pack, "value binary"), warc, "\r\n\r\n")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """What the WARC files say of each record; a response's payload is measured and digested."""
    schema = pa.schema([
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("record_id", pa.string()),
        ("target_uri", pa.string()), ("warc_date", pa.string()), ("intact", pa.bool_()),
    ])

    def read(batches):
        def rows():
            for _, _, r in _by_file(batches, parse_warc):
                h, kind = r["headers"], r["headers"].get("WARC-Type")
                _, _, payload = split_http(r["block"])
                said = h.get("WARC-Payload-Digest", "").removeprefix("sha1:")
                found = digest(payload) if kind == "response" else said
                size = len(payload) if kind == "response" else int(h.get("X-Payload-Length", 0))
                block = h.get("WARC-Block-Digest") == f"sha1:{digest(r['block'])}"
                page, to = h.get(PAGE), h.get("X-Refers-To-Page")
                yield (int(page) if page else None, size, found, kind, int(to) if to else None,
                       h.get("WARC-Record-ID"), h.get("WARC-Target-URI"), h.get("WARC-Date"),
                       block and found == said)

        return _batches(rows(), schema, lambda r: 200)

    return _read_lines(spark, path).mapInArrow(
        read,
        "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
        "refers_to bigint, record_id string, target_uri string, warc_date string, intact boolean",
    )


def archived(pages: DataFrame) -> DataFrame:
    """Pages to ARC files, these to WARC files, and the WARC records as a table."""
    spark = pages.sparkSession
    arc, warc = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    write_arc(pages, arc)
    convert(spark, arc, warc)
    return read_warc(spark, warc)
