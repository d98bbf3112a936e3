"""Legacy archives: ARC records to WARC records, and WARC files written and read.

An ARC file is a version block followed by records. Each record is one header line, whose fields depend on the version,
a body of exactly the declared length, and a line feed. ``parse_arc`` reads them by those declared lengths;
``to_warc`` makes the equivalent WARC records: identifiers from a hash of the record (the same input gives the
same archive), the timestamp in ISO form, response for HTTP messages and resource for anything else, and digests of block
and payload. A payload that was archived before becomes a revisit, which keeps the HTTP header and drops the payload.

Files are written by Spark's text writer with the record separator of WARC as its line separator: executors need no shared
file system of their own and a task that is tried again leaves no double. Files hold about ``bytes_per_file`` bytes, and a reader holds one of them.
Readers take gzip files of any number of members; ``read_arc`` gives a legacy file's records as a table.

Pages: null or empty html is an empty payload; a null url is written as an empty target and read back so; a null page_id is written
as '-' and read back as null, and never is the page that others revisit. Repeated rows are one record
each, and rows that repeat the response's id are responses too. Extra columns are ignored; an empty
table gives an empty archive.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import arrow_map, fresh_path

# Fields of the header line by version of the format.
ARC_FIELDS = {
    1: ("url", "ip", "date", "type", "length"),
    2: ("url", "ip", "date", "type", "result", "checksum", "location", "offset", "filename", "length"),
}
SEPARATOR = "\r\n\r\n"
LEAST_REVISIT = 100
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass
class Record:
    """A record of either kind: its header fields and its body."""

    fields: dict[str, str]
    body: bytes = b""
    kind: str = field(default="")


class ArchiveError(ValueError):
    """The bytes are not a well-formed archive."""


def arc_bytes(records: list[Record], version: int = 1, date: str = "20240101000000") -> bytes:
    """An ARC file of that version."""
    names = ARC_FIELDS[version]
    head = f"{version} 0 ledgerloom\n{' '.join({'url': 'URL', 'ip': 'IP-address', 'date': 'Archive-date', 'type': 'Content-type', 'result': 'Result-code', 'length': 'Archive-length'}.get(n, n.capitalize()) for n in names)}\n".encode()
    first = {"url": "filedesc://pages.arc", "ip": "0.0.0.0", "date": date, "type": "text/plain", "length": str(len(head))}
    out = [" ".join(first.get(n, "-") for n in names).encode() + b"\n" + head + b"\n"]
    for r in records:
        out.append(" ".join((r.fields | {"length": str(len(r.body))}).get(n, "-") for n in names).encode() + b"\n" + r.body + b"\n")
    return b"".join(out)


def parse_arc(data: bytes) -> Iterator[Record]:
    """Records of an ARC file. The version block tells which fields a header line has; lengths tell where bodies end."""
    at, names = 0, ARC_FIELDS[1]
    while at < len(data):
        if data[at : at + 1] == b"\n":
            at += 1
            continue
        end = data.find(b"\n", at)
        if end < 0:
            raise ArchiveError("a header line is cut off")
        values = data[at:end].decode("utf-8", "surrogateescape").rstrip("\r").split(" ")
        first = values[0].startswith("filedesc://")
        if first:
            names = ARC_FIELDS[2] if len(values) == len(ARC_FIELDS[2]) else ARC_FIELDS[1]
        if len(values) != len(names) or not values[-1].isdigit():
            raise ArchiveError(f"a header line has {len(values)} fields, not {len(names)}")
        start, length = end + 1, int(values[-1])
        if start + length > len(data):
            raise ArchiveError("a body is shorter than declared")
        body = data[start : start + length]
        at = start + length
        if first:
            version = body.split(b" ", 1)[0]
            if not version.isdigit() or int(version) not in ARC_FIELDS:
                raise ArchiveError("unknown version")
            names = ARC_FIELDS[int(version)]
            continue
        yield Record(dict(zip(names, values, strict=True)), body)


def split_http(body: bytes) -> tuple[bytes, bytes] | None:
    """Header with its blank line, and payload, of an HTTP message."""
    if not body.startswith(b"HTTP/"):
        return None
    end = body.find(b"\r\n\r\n")
    return (body[: end + 4], body[end + 4 :]) if end >= 0 else None


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256('|'.join(parts).encode('utf-8', 'surrogateescape')).digest()[:16], version=4)}>"


def iso_date(date: str) -> str:
    d = date + "00000101000000"[len(date) :]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def to_warc(r: Record, refers_to: str | None = None, extra: dict[str, str] | None = None, known_id: str | None = None) -> Record:
    """The WARC record of an ARC record; with refers_to a revisit of the record of that id."""
    http = split_http(r.body)
    payload = http[1] if http else r.body
    kind = "revisit" if refers_to else "response" if http else "resource"
    block = http[0] if refers_to and http else b"" if refers_to else r.body
    sha = lambda b: "sha256:" + hashlib.sha256(b).hexdigest()
    out = {
        "WARC-Type": kind,
        "WARC-Record-ID": known_id or record_id(r.fields["url"], r.fields["date"], sha(r.body)),
        "WARC-Date": iso_date(r.fields["date"]),
        "WARC-Target-URI": r.fields["url"],
        "WARC-IP-Address": r.fields["ip"],
        "Content-Type": "application/http; msgtype=response" if http else r.fields["type"],
        "WARC-Payload-Digest": sha(payload),
        "WARC-Block-Digest": sha(block),
    }
    if refers_to:
        out |= {"WARC-Refers-To": refers_to, "WARC-Profile": REVISIT_PROFILE}
    return Record(out | (extra or {}) | {"Content-Length": str(len(block))}, block, kind)


def warc_bytes(r: Record) -> bytes:
    """Header and block, without the separator that follows a record."""
    return "".join(["WARC/1.1\r\n", *(f"{k}: {v}\r\n" for k, v in r.fields.items()), "\r\n"]).encode("utf-8", "surrogateescape") + r.body


def parse_warc(data: bytes) -> Iterator[Record]:
    """Records of a WARC file, by their Content-Length; digests of blocks are checked."""
    at = 0
    while at < len(data):
        end = data.find(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "surrogateescape").split("\r\n")
        if end < 0 or not lines[0].startswith("WARC/"):
            raise ArchiveError("a record does not begin with its version")
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        start, length = end + 4, int(fields["Content-Length"])
        block = data[start : start + length]
        if len(block) != length or data[start + length : start + length + 4] != b"\r\n\r\n":
            raise ArchiveError("a block does not end where its length says")
        if fields["WARC-Block-Digest"] != "sha256:" + hashlib.sha256(block).hexdigest():
            raise ArchiveError("a block does not match its digest")
        yield Record(fields, block, fields["WARC-Type"])
        at = start + length + 4


def page_id_of(r: Record) -> int | None:
    """The page_id that the archived HTTP header carries."""
    for line in r.body.split(b"\r\n\r\n", 1)[0].split(b"\r\n"):
        if line.lower().startswith(b"x-page-id: "):
            value = line.split(b": ", 1)[1]
            return None if value == b"-" else int(value)
    return None


def page_arc(page: str, url: str | None, html: bytes, date: str = "20240101000000") -> Record:
    """The ARC record of a page: an HTTP message whose header carries the page_id."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: {page}\r\nContent-Length: {len(html)}\r\n\r\n".encode()
    return Record({"url": quote(url or "", safe=":/?#[]@!$&'()*+,;=%~") or "-", "ip": "0.0.0.0", "date": date, "type": "text/html", "result": "200"}, head + html)


def first_holders(pages: DataFrame) -> DataFrame:
    """pages(page_id, url, html) with _wa_first: the smallest page_id that holds an equal payload of LEAST_REVISIT bytes, where that is held twice."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("html"), F.unhex(F.sha2(payload, 256)).alias("_wa_digest"))
    long_enough = (F.octet_length("html") >= LEAST_REVISIT) & F.col("page_id").isNotNull()
    held = rows.where(long_enough).groupBy("_wa_digest").agg(F.min("page_id").alias("_wa_first"), F.count("*").alias("n")).where("n > 1").drop("n")
    # The join is on the digest alone, so that a payload held by a third of all pages can be split over tasks.
    return rows.join(held, "_wa_digest", "left").select("page_id", "url", "html", F.when(F.octet_length("html") >= LEAST_REVISIT, F.col("_wa_first")).alias("_wa_first"))


def write_pages(pages: DataFrame, path: str, bytes_per_file: int = 16 << 20) -> None:
    """Pages as ARC records, converted and written as WARC files under path, of about so many bytes each: as many records as that holds of their mean size."""
    rows = first_holders(pages)
    mean = pages.agg(F.avg(F.octet_length("html"))).first()[0] or 0
    records_per_file = max(1, min(10_000, int(bytes_per_file / (mean + 1024))))

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        ids, urls = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for i, (page, url, html, first) in enumerate(zip(ids, urls, batch.column(2).cast(pa.binary()).to_pylist(), batch.column(3).to_pylist(), strict=True)):
            name = "-" if page is None else str(page)
            # Both versions of the header line are written, by turns, and parsed back by their own fields.
            arc = next(parse_arc(arc_bytes([page_arc(name, url, html)], version=1 + i % 2)))
            refers = None if first is None or first == page else record_id("page", str(first))
            out.append(warc_bytes(to_warc(arc, refers, {"WARC-Refers-To-Page": str(first)} if refers else None, record_id("page", name))))
        return pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    records = arrow_map(rows, f, "value binary")
    text = records.select(F.col("value").cast("string").alias("value"))
    text.write.option("lineSep", SEPARATOR).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)


def inflated(content: bytes) -> bytes:
    """What gzip members hold, however many there are (archives often have one a record); other bytes as they are."""
    out = []
    while content[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        out.append(member.decompress(content))
        if not member.eof:
            raise ArchiveError("a gzip member is cut off")
        content = member.unused_data
    return b"".join(out) if out else content


def read_arc(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """One row a record of legacy files, plain or gzip, whole or a member a record, as its equivalent: record_id, record_type, date, url, ip, content_type, payload_digest, block_digest, block."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select("content")
    names = ("WARC-Record-ID", "WARC-Type", "WARC-Date", "WARC-Target-URI", "WARC-IP-Address", "Content-Type", "WARC-Payload-Digest", "WARC-Block-Digest")
    columns = ["record_id", "record_type", "date", "url", "ip", "content_type", "payload_digest", "block_digest", "block"]

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [to_warc(r) for content in batch.column(0) for r in parse_arc(inflated(content.as_py()))]
        values = [pa.array([r.fields[n] for r in found], pa.string()) for n in names]
        return pa.RecordBatch.from_arrays([*values, pa.array([r.body for r in found], pa.binary())], columns)

    return arrow_map(files, f, ", ".join(f"{c} string" for c in columns[:-1]) + ", block binary")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row a record: page_id, record_id, record_type, payload_bytes, payload_digest, refers_to, refers_page, url."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").option("recursiveFileLookup", "true").load(path).select("content")

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for content in batch.column(0):
            for r in parse_warc(inflated(content.as_py())):
                http = split_http(r.body)
                length = len(http[1]) if http and r.kind != "revisit" else 0
                if r.kind == "revisit":
                    length = next(int(x.split(b": ")[1]) for x in r.body.split(b"\r\n") if x.startswith(b"Content-Length: "))
                elif http and r.fields["WARC-Payload-Digest"] != "sha256:" + hashlib.sha256(http[1]).hexdigest():
                    raise ArchiveError("a payload does not match its digest")
                url = r.fields["WARC-Target-URI"]
                out.append((page_id_of(r), r.fields["WARC-Record-ID"], r.kind, length, r.fields["WARC-Payload-Digest"].split(":")[1], r.fields.get("WARC-Refers-To"),
                            int(r.fields["WARC-Refers-To-Page"]) if "WARC-Refers-To-Page" in r.fields else None, "" if url == "-" else unquote(url)))
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
        columns = list(zip(*out, strict=True)) or [()] * 8
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["page_id", "record_id", "record_type", "payload_bytes", "payload_digest", "refers_to", "refers_page", "url"])

    return arrow_map(files, f, "page_id long, record_id string, record_type string, payload_bytes long, payload_digest string, refers_to string, refers_page long, url string")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write pages to archives in the shared folder and read them back."""
    path = fresh_path(pages.sparkSession, "warc")
    write_pages(pages, path)
    rows = read_archives(pages.sparkSession, path)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", F.col("refers_page").alias("refers_to"), "record_id", "url")
