"""Legacy ARC archives to WARC: parse the old records by version and length, write equivalent new ones, read them back.

Archives are ordinary files in a folder, written by Spark's own committers and read by its own readers, so
any store that Spark reaches will do and a lost executor leaves no half-written archive behind.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Callable, Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yieldlens.llm.storage import Workspace

BATCH_BYTES = 8 << 20
MOST_RECORDS = 20_000
_NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "arc-record")
# Ends an HTTP head, whichever line ends the server used.
_BLANK_LINE = re.compile(rb"\r?\n\r?\n")

# Fields of a record's header line by the version that the archive's first record names.
ARC_FIELDS = {
    1: ("url", "ip", "date", "mime", "length"),
    2: ("url", "ip", "date", "mime", "status", "checksum", "location", "offset", "filename", "length"),
}

_ARC = (
    "record_id string, archive string, offset bigint, url string, ip string, date string, mime string, "
    "http boolean, head string, block binary, block_digest string, payload_bytes bigint, payload_digest string"
)
_WARC = (
    "record_id string, record_type string, url string, date string, refers_to string, declared_digest string, "
    "head string, block_digest string, declared_block_digest string, payload_bytes bigint, payload_digest string"
)


def digest(data: bytes) -> str:
    """SHA-1 in base32, as archives state it."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _opened(content: bytes):
    return gzip.GzipFile(fileobj=io.BytesIO(content)) if content[:2] == b"\x1f\x8b" else io.BytesIO(content)


def _exactly(file, length: int) -> bytes:
    data = file.read(length)
    if len(data) != length:
        raise ValueError(f"archive ends within a record: {len(data)} of {length} bytes")
    return data


def arc_records(content: bytes) -> Iterator[tuple[int, dict, bytes]]:
    """Offset, header fields and block of every record but those that describe the archive.

    An archive's first record describes it; where archives were joined, more such records follow. Their
    line has the five fields of version 1 in either version, and the line that their block begins with
    tells the version of the records behind. Types may hold blanks, so a line is read from both ends.
    """
    file = _opened(content)
    version, at = 0, 0
    while line := file.readline():
        offset, at = at, at + len(line)
        if not line.strip():
            continue
        described = line.startswith(b"filedesc:")
        if not version and not described:
            raise ValueError("an ARC archive begins with a filedesc record")
        names = ARC_FIELDS[1 if described else version]
        parts = line.rstrip(b"\r\n").split(b" ")
        behind = len(names) - names.index("mime") - 1
        if len(parts) < len(names) or not parts[-1].isdigit():
            raise ValueError(f"no header of an ARC {version or 1} record at {offset}: {line[:200]!r}")
        values = [*parts[:3], b" ".join(parts[3 : len(parts) - behind]), *parts[len(parts) - behind :]]
        fields = {n: v.decode("utf-8", "replace") for n, v in zip(names, values, strict=True)}
        block = _exactly(file, int(parts[-1]))
        at += len(block)
        if described:
            version = int(block.split(b" ", 1)[0])
        else:
            yield offset, fields, block


def _http(block: bytes) -> tuple[bool, bytes, bytes]:
    """Whether the block is an HTTP answer, its head with the blank line, and its payload."""
    if not block.startswith(b"HTTP/"):
        return False, b"", block
    end = _BLANK_LINE.search(block)
    return True, block[: end.end()] if end else block, block[end.end() :] if end else b""


def _iso(date: str) -> str:
    """The digits of a date, from the year to the second, as the time that WARC writes.

    What is left out at the end is the first month or day, or zero; what cannot be read becomes the epoch.
    """
    digits = date[:14]
    if not re.fullmatch(r"[0-9]{4}(?:[0-9]{2}){0,5}", digits):
        return "1970-01-01T00:00:00Z"
    try:
        full = digits + "00000101000000"[len(digits) :]
        return datetime.strptime(full, "%Y%m%d%H%M%S").replace(tzinfo=UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return "1970-01-01T00:00:00Z"


def _batches(rows: Iterator[tuple], kinds: pa.Schema, size: Callable[[tuple], int]) -> Iterator[pa.RecordBatch]:
    kept, held = [], 0
    for row in rows:
        kept.append(row)
        held += size(row) + 200
        if held >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept, strict=True), kinds, strict=True)], schema=kinds)
            kept, held = [], 0
    if kept:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*kept, strict=True), kinds, strict=True)], schema=kinds)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in ddl.split(", "))])


def read_arc(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all ARC archives in a folder, plain or gzip, without those that describe archives."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for path, content in zip(*batch.columns, strict=True):
                    archive = path.as_py().rsplit("/", 1)[-1]
                    for offset, fields, block in arc_records(content.as_py()):
                        http, head, payload = _http(block)
                        yield (
                            f"urn:uuid:{uuid.uuid5(_NAMES, f'{archive}#{offset}')}", archive, offset, fields["url"], fields["ip"],
                            _iso(fields["date"]), fields["mime"], http, head.decode("latin-1"), block, digest(block),
                            len(payload), digest(payload),
                        )

        yield from _batches(rows(), _arrow(_ARC), lambda row: len(row[9]))

    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(parse, _ARC)


def write_warc(records: DataFrame, folder: str, order: Column, least_bytes: int = 0) -> None:
    """Write ``read_arc``'s records as WARC 1.1 archives.

    Of records whose payloads are equal and have at least ``least_bytes``, the one that comes last by
    ``order`` (null first; then by identifier) is a response, the others are revisits that refer to it and
    keep only their HTTP head. All smaller ones are responses. Records without an HTTP head are resources.

    A null url, ip or type gives no such line, a null date the epoch, a null block or head an empty one; repeated rows give
    a record each; no records give an empty folder.
    """
    records = records.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in (("block", b""), ("head", ""), ("date", "1970-01-01T00:00:00Z"))})
    records = records.withColumn("_order", order)
    named = F.struct("_order", "record_id", "url", "date")
    known = (
        records.filter(F.col("http") & (F.col("payload_bytes") >= least_bytes))
        .groupBy("payload_digest")
        .agg(F.max(named).alias("last"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("payload_digest", "last")
    )
    # Stored first: where few payloads have copies, no record needs to be shuffled to meet them.
    known = Workspace(records.sparkSession, "copies").keep(known, "known")
    joined = records.join(known, "payload_digest", "left")
    again = F.col("last").isNotNull() & (F.col("payload_bytes") >= least_bytes) & F.col("http")
    again = again & (F.col("last.record_id") != F.col("record_id"))
    head = F.encode("head", "iso-8859-1")
    block = F.when(again, head).otherwise(F.col("block"))

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    lines = [
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(again, "revisit").when(F.col("http"), "response").otherwise("resource")),
        line("WARC-Record-ID", F.concat(F.lit("<"), "record_id", F.lit(">"))),
        line("WARC-Date", F.col("date")),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-IP-Address", F.col("ip")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_digest")),
        F.when(~again, line("WARC-Block-Digest", F.concat(F.lit("sha1:"), "block_digest"))).otherwise(""),
        F.when(
            again,
            F.concat(
                line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                line("WARC-Refers-To", F.concat(F.lit("<"), "last.record_id", F.lit(">"))),
                line("WARC-Refers-To-Target-URI", F.col("last.url")),
                line("WARC-Refers-To-Date", F.col("last.date")),
            ),
        ).otherwise(""),
        line("Content-Type", F.when(F.col("http"), "application/http; msgtype=response").otherwise(F.col("mime"))),
        line("Content-Length", F.length(block).cast("string")),
        F.lit("\r\n"),
    ]
    # The writer ends each record with a line feed, the last byte of the two line ends due there.
    record = F.concat(F.encode(F.concat(*lines), "utf-8"), block, F.encode(F.lit("\r\n\r"), "utf-8"))
    _write(joined.select(record.cast("string").alias("value")), folder)


def _write(records: DataFrame, folder: str) -> None:
    records.write.option("lineSep", "\n").option("maxRecordsPerFile", MOST_RECORDS).text(folder, compression="gzip")


def write_arc(pages: DataFrame, folder: str) -> None:
    """Write old archives: ``url``, ``ip``, ``date`` (14 digits), ``mime``, ``version`` (1 or 2) and ``block`` of each record.

    Every record carries the archive's description before it, as an archive of one; readers take any
    number of such archives one after the other. The old format has no way to leave a field out: a null url or
    type becomes ``-``, a null ip ``0.0.0.0``, a null date the epoch, a null version 1, a null block an empty one.
    Repeated rows give a record each; no pages give an empty folder.
    """
    absent = (("url", "-"), ("ip", "0.0.0.0"), ("date", "19700101000000"), ("mime", "-"), ("version", 1), ("block", b""))
    pages = pages.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in absent})
    said = F.when(
        F.col("version") == 1, F.lit("1 0 pages\nURL IP-address Archive-date Content-type Archive-length\n")
    ).otherwise(
        "2 0 pages\nURL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length\n"
    )
    first = F.concat(
        F.lit("filedesc://pages.arc 0.0.0.0 "), "date", F.lit(" text/plain "), F.length(said).cast("string"), F.lit("\n"), said, F.lit("\n")
    )
    more = F.when(F.col("version") == 2, F.lit(" 200 - - 0 pages.arc")).otherwise("")
    header = F.concat(
        "url", F.lit(" "), "ip", F.lit(" "), "date", F.lit(" "), "mime", more, F.lit(" "), F.length("block").cast("string"), F.lit("\n")
    )
    record = F.concat(F.encode(F.concat(first, header), "utf-8"), F.col("block"))
    _write(pages.select(record.cast("string").alias("value")), folder)


def warc_records(content: bytes) -> Iterator[tuple[dict, bytes]]:
    """Header fields, by lower-case name, and block of every record of an archive."""
    file = _opened(content)
    while line := file.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record begins with {line[:100]!r}")
        fields = {}
        while (line := file.readline()).strip():
            name, _, value = line.decode().partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, _exactly(file, int(fields["content-length"]))


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all WARC archives in a folder, with sizes and digests taken from what was read."""

    def bare(value: str | None) -> str | None:
        return value and value.removeprefix("sha1:").strip("<>")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for content in batch.column(0):
                    for fields, block in warc_records(content.as_py()):
                        http, head, payload = _http(block)
                        yield (
                            bare(fields.get("warc-record-id")), fields.get("warc-type"), fields.get("warc-target-uri"), fields.get("warc-date"),
                            bare(fields.get("warc-refers-to")), bare(fields.get("warc-payload-digest")), head.decode("latin-1"),
                            digest(block), bare(fields.get("warc-block-digest")), len(payload), digest(payload),
                        )

        yield from _batches(rows(), _arrow(_WARC), lambda row: len(row[6]))

    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(parse, _WARC)
