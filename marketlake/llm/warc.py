"""WARC archives: write pages as records, and read archives back with salvage.

Writing is plain DataFrame code: a record is one string, and Spark's text writer puts them into files of a
bounded number of records. A page whose payload of at least 1000 bytes equals that of a page with a larger id is a
revisit record without payload that names the other one; all other pages are response records.

Reading takes each archive (plain, or gzip with one or more members) as one row of Spark's binary reader, so a task
holds one of up to 1 GB; the writer's files are far smaller, longer ones are refused as one gap. The salvage reader checks every
record: version line, header lines, Content-Length, the blank lines after the block, and the payload digest.
Where a check fails it searches for the next gzip member that unpacks to a record, or for the next version line
that starts a sound record, goes on from there, and returns the bytes between as a quarantined gap with its
reason. A gzip member that breaks off gives the records before the break.

Defined cases for writing: a null html is an empty payload; control characters and blanks in an url are percent-encoded and a null
url gives no WARC-Target-URI; rows that repeat a page_id and a payload are records each, of one type; a null
page_id is never the original of another page; an empty table gives an archive without records; other columns are ignored.
For reading: an empty file has no records and no gaps; a file that is no archive at all is one gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators.joins import join_dimension
from marketlake.session import new_folder, stored

LEAST_SHARED_BYTES = 1000
FILE_BYTES = 16 << 20
MOST_BYTES = 1 << 30  # of an archive that a task reads at once
WARC_DATE = "2024-01-01T00:00:00Z"  # written where no capture time is known

# Fixed values of the format.
_VERSION = re.compile(rb"WARC/\d+\.\d+\r?\n")
_GZIP = b"\x1f\x8b\x08"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_END = "\r\n\r\n"


def _digests(pages: DataFrame) -> DataFrame:
    payload = F.coalesce("html", F.lit("")).cast("binary")
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"),
        F.sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("bytes"),
    )


def _base32(hex_digest) -> F.Column:
    """A hex SHA-1 as base 32, as WARC headers have it: 160 bits are 32 letters of 5 bits."""
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"  # fixed value
    bits = F.concat(*(F.lpad(F.conv(F.substring(hex_digest, 1 + 10 * i, 10), 16, 2), 40, "0") for i in range(4)))
    letters = [F.substring(F.lit(alphabet), F.conv(F.substring(bits, 1 + 5 * i, 5), 2, 10).cast("int") + 1, F.lit(1)) for i in range(32)]
    return F.concat(*letters)


def write_pages(pages: DataFrame, folder: str, file_bytes: int = FILE_BYTES, compression: str = "none") -> None:
    """Write a record per page (page_id, url, html) to archives in ``folder``."""
    rows = _digests(pages)
    shared = stored(
        rows.filter(F.col("bytes") >= LEAST_SHARED_BYTES).groupBy("digest")
        .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("copies")).filter("copies > 1").select("digest", "original"),
        "originals",
    )
    rows = join_dimension(rows, shared, "digest", "left")
    total, count = pages.agg(F.coalesce(F.sum(F.octet_length("html")), F.lit(0)), F.count(F.lit(1))).first()
    revisit = F.coalesce(F.col("original") != F.col("page_id"), F.col("original").isNotNull()) & (F.col("bytes") >= LEAST_SHARED_BYTES)
    name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("none")), F.lit(">"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("bytes").cast("string"), F.lit(_END)
    )
    block = F.when(revisit, http).otherwise(F.concat(http, "html"))
    # Characters that would end a header line.
    url = F.col("url")
    for code in (*range(33), 127):
        url = F.replace(url, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), name,
        F.lit(f"\r\nWARC-Date: {WARC_DATE}"),
        F.coalesce(F.concat(F.lit("\r\nWARC-Target-URI: "), url), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha1:"), _base32(F.col("digest")),
        F.when(revisit, F.concat(
            F.lit(f"\r\nWARC-Profile: {_REVISIT_PROFILE}\r\nWARC-Refers-To: <urn:page:"), F.col("original").cast("string"), F.lit(">")
        )).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit(_END),
    )
    a_file = max(1, min(count, file_bytes * count // max(1, total + 600 * count)))
    rows.select(F.concat(head, block).alias("record")).write.option("lineSep", _END).option(
        "compression", compression
    ).option("maxRecordsPerFile", a_file).text(folder)


@dataclass
class Record:
    """A record, or (with a reason) a quarantined gap, at its place in the archive."""

    offset: int
    length: int
    headers: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""
    reason: str | None = None
    http_length: int | None = None  # of the full payload, by a revisit's HTTP headers
    digest: str | None = None  # the SHA-1 that the headers claim, in hex


class Damaged(Exception):
    """Why the bytes at a place are not a sound record."""


def _payload(headers: dict[str, str], block: bytes) -> bytes:
    if headers.get("content-type", "").startswith("application/http"):
        end = block.find(b"\r\n\r\n")
        if end < 0:
            raise Damaged("no end of the HTTP headers")
        return block[end + 4:]
    return block


def _number(digits: str | bytes) -> int:
    """A length in a header; raises Damaged unless it is one that a file can have."""
    if not digits.isascii() or not digits.isdigit() or len(digits) > 18:
        raise Damaged("no readable length")
    return int(digits)


def _sha1(value: str) -> str | None:
    """The SHA-1 that a digest header claims, in hex, from base 32 or hex of either case; None for another algorithm,
    which is taken as it is. Raises Damaged if it cannot be read."""
    kind, _, digest = value.partition(":")
    if kind.lower() != "sha1":
        return None
    try:
        found = base64.b32decode(digest, casefold=True) if len(digest) == 32 else bytes.fromhex(digest)
    except ValueError:
        found = b""
    if len(found) != 20:
        raise Damaged("a digest that cannot be read")
    return found.hex()


def parse_record(data: bytes, start: int) -> tuple[Record, int]:
    """The record at a place and where it ends; raises Damaged, whatever the bytes are."""
    try:
        return _parsed(data, start)
    except (ArithmeticError, LookupError, TypeError, ValueError) as found:
        raise Damaged(f"unreadable: {type(found).__name__}") from found


def _parsed(data: bytes, start: int) -> tuple[Record, int]:
    version = _VERSION.match(data, start)
    if not version:
        raise Damaged("no version line")
    head_end = re.compile(rb"\r?\n\r?\n").search(data, version.end() - 1)
    if not head_end:
        raise Damaged("no end of the headers")
    headers: dict[str, str] = {}
    for line in data[version.end():head_end.start()].splitlines():
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise Damaged("a header line without a name")
        headers[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    end = head_end.end() + _number(headers.get("content-length", ""))
    if end > len(data):
        raise Damaged("the block is cut off")
    if data[end:end + 4] != b"\r\n\r\n":
        raise Damaged("no blank lines after the block")
    payload = _payload(headers, data[head_end.end():end])
    record = Record(start, end + 4 - start, headers, payload, digest=_sha1(headers.get("warc-payload-digest", "")))
    if headers.get("warc-type") == "revisit":
        told = re.search(rb"(?mi)^content-length:[ \t]*(\d+)", data[head_end.end():end - len(payload)])
        record.http_length = _number(told[1]) if told else None
    elif record.digest and record.digest != hashlib.sha1(payload).hexdigest():
        raise Damaged("the payload digest differs")
    return record, end + 4


def salvage_plain(data: bytes, base: int = 0) -> Iterator[Record]:
    """Records and gaps of uncompressed bytes; offsets count from ``base``."""
    place, gap, reason = 0, None, None
    while place < len(data):
        try:
            record, end = parse_record(data, place)
        except Damaged as found:
            if gap is None:
                gap, reason = place, str(found)
            following = _VERSION.search(data, place + 1)
            place = following.start() if following else len(data)
            continue
        if gap is not None:
            yield Record(base + gap, place - gap, reason=reason)
            gap = None
        record.offset += base
        yield record
        place = end
    if gap is not None:
        yield Record(base + gap, len(data) - gap, reason=reason)


def _member(data: bytes, start: int) -> tuple[bytes, int, str | None]:
    """What a gzip member at a place unpacks to, where it ends, and what is wrong with it."""
    unpack = zlib.decompressobj(31)
    out, view, place = [], memoryview(data), start
    try:
        while not unpack.eof and place < len(data):
            out.append(unpack.decompress(view[place:place + (1 << 16)]))
            place += 1 << 16
    except zlib.error as found:
        return b"".join(out), place, f"gzip: {found}"
    if not unpack.eof:
        return b"".join(out), len(data), "gzip: the member is cut off"
    return b"".join(out), min(place, len(data)) - len(unpack.unused_data), None


def salvage_gzip(data: bytes) -> Iterator[Record]:
    """Records and gaps of gzip members. Offset and length are those of the member in the archive; records of a
    member with several share them."""
    place, gap, reason = 0, None, None
    while place < len(data):
        found, fault = [], "no gzip member"
        end = place
        if data.startswith(_GZIP, place):
            unpacked, end, fault = _member(data, place)
            if unpacked.startswith(b"WARC/"):
                found = list(salvage_plain(unpacked))
                if fault and found and found[-1].reason:
                    found.pop()  # the record that broke off is part of the gap
            elif not fault:
                fault = "a member without a record"
        if found and not fault:
            if gap is not None:
                yield Record(gap, place - gap, reason=reason)
                gap = None
            for record in found:
                record.offset, record.length = place, end - place
                yield record
            place = end
            continue
        if found:  # the records before the break are sound
            if gap is not None:
                yield Record(gap, place - gap, reason=reason)
                gap = None
            for record in found:
                record.offset, record.length = place, 0
                yield record
        if gap is None:
            gap, reason = place, fault
        place = _next_member(data, place + 1)
    if gap is not None:
        yield Record(gap, len(data) - gap, reason=reason)


def _next_member(data: bytes, place: int) -> int:
    """Where the next gzip member that starts with a version line begins."""
    while (place := data.find(_GZIP, place)) >= 0:
        try:
            if zlib.decompressobj(31).decompress(data[place:place + 4096], 64).startswith(b"WARC/"):
                return place
        except zlib.error:
            pass
        place += 1
    return len(data)


def salvage(data: bytes) -> Iterator[Record]:
    """Records and gaps of an archive's bytes."""
    packed = data.startswith(_GZIP) or (not _VERSION.match(data) and _next_member(data, 0) < len(data))
    return salvage_gzip(data) if packed else salvage_plain(data)


_FIELDS = pa.schema([
    ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("gap_reason", pa.string()),
    ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("payload_digest", pa.string()),
    ("refers_to", pa.string()), ("payload_length", pa.int64()), ("payload", pa.binary()),
])
_BATCH_BYTES = 8 << 20


def _row(archive: str, record: Record, with_payload: bool) -> tuple:
    headers = record.headers
    size = len(record.payload) if record.http_length is None else record.http_length
    return (
        archive, record.offset, record.length, record.reason, headers.get("warc-type"), headers.get("warc-record-id"),
        headers.get("warc-target-uri"), record.digest, headers.get("warc-refers-to"),
        None if record.reason else size, record.payload if with_payload and not record.reason else None,
    )


def read_archives(spark: SparkSession, folder: str, with_payload: bool = True, most_bytes: int = MOST_BYTES) -> DataFrame:
    """A row per record and per quarantined gap (``gap_reason`` not null) of all archives in a folder. An archive of
    more than ``most_bytes`` is not read: it is one gap."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [[] for _ in _FIELDS]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _FIELDS)], schema=_FIELDS)

        for files in batches:
            for path, content in zip(files.column(0).to_pylist(), files.column(1)):
                rows, size = [], 0
                for record in salvage(content.as_py()):
                    rows.append(_row(path, record, with_payload))
                    size += len(record.payload) * with_payload + 500
                    if size > _BATCH_BYTES:
                        yield batch(rows)
                        rows, size = [], 0
                yield batch(rows)

    kinds = (
        "archive string, offset long, length long, gap_reason string, record_type string, record_id string, target_uri string, "
        "payload_digest string, refers_to string, payload_length long, payload binary"
    )
    files = spark.read.format("binaryFile").load(folder)
    read_whole = files.filter(F.col("length") <= most_bytes).select("path", "content").mapInArrow(read, kinds)
    refused = files.filter(F.col("length") > most_bytes).select(
        F.col("path").alias("archive"), F.lit(0).cast("long").alias("offset"), "length", F.lit("the archive is too long").alias("gap_reason")
    )
    return read_whole.unionByName(refused, allowMissingColumns=True)


def quarantined(records: DataFrame) -> DataFrame:
    """The log of gaps: archive, offset, length, gap_reason."""
    return records.filter("gap_reason is not null").select("archive", "offset", "length", "gap_reason")


def page_id_of(name) -> F.Column:
    """The page id in a record id that ``write_pages`` made, else null."""
    return F.expr(f"try_cast(regexp_extract({name}, '^<urn:page:(-?[0-9]+)>$', 1) as long)")


def archive_pages(pages: DataFrame) -> DataFrame:
    """Write the pages to new archives in the shared folder and read these back."""
    folder = new_folder(pages.sparkSession, "warc")
    write_pages(pages, folder)
    return read_archives(pages.sparkSession, folder, with_payload=False)
