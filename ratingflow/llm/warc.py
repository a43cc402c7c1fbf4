"""WARC archives: pages written as records, archives read back and salvaged.

``write`` makes one record a page.  Of pages with the same payload the one
with the largest id is a ``response`` record that holds it; the others are
``revisit`` records, whose block ends with the HTTP header and which name the
response they refer to.  ``read`` checks every record; where a check fails it
searches for the next gzip member or version line that begins a valid record,
recovers the records from there on, and returns the bytes left out as a gap.

An archive is a file of a Spark text writer: a record's bytes are a row less
their last byte, which the writer adds as line separator (the newline that
ends a record, or the zero that ends a gzip member below 16 MiB; after a
longer member the zero is padding, which readers skip).

Inputs: a null html is an empty payload, a null url gives no target URI and
control characters and blanks of others are percent-encoded; rows that repeat
a page_id, or have none, are records of their own (null is the smallest id; of
equal pages of the largest id one is the response); other columns are not
read.  An archive is read by one task, so ``write`` bounds their size; Spark
refuses files of 2 GB and more.  Transfer encodings are not undone.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingflow.llm.common import discard, saved

#: Payload bytes of an archive, about; records are never split over archives.
ARCHIVE_BYTES = 32 << 20
#: Payload bytes that a batch of read records holds before it is passed on.
_BATCH_BYTES = 4 << 20
#: Compressed bytes given to the inflater at a time.
_FEED = 1 << 16
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_VERSION = re.compile(rb"WARC/1\.[01]\r\n")
_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def digest(data: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# ---- writing

def record(kind: str, record_id: str, block: bytes, date: str, more: dict[str, str]) -> bytes:
    """The bytes of a WARC record."""
    lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}",
             *(f"{name}: {value}" for name, value in more.items()),
             f"WARC-Block-Digest: sha1:{digest(block)}", f"Content-Length: {len(block)}"]
    return b"".join([b"WARC/1.1\r\n", "\r\n".join(lines).encode(), b"\r\n\r\n", block, b"\r\n\r\n"])


def page_record(page: str, url: str | None, payload: bytes, refers_to: str | None, date: str) -> bytes:
    """A page's response record, or its revisit record of page ``refers_to``."""
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    more = {} if url is None else {"WARC-Target-URI": _UNSAFE.sub(lambda m: f"%{ord(m.group()):02X}", url)}
    more |= {"WARC-Payload-Digest": f"sha1:{digest(payload)}", "Content-Type": "application/http;msgtype=response"}
    if refers_to is None:
        return record("response", f"urn:page:{page}", block + payload, date, more)
    more |= {"WARC-Refers-To": f"<urn:page:{refers_to}>", "WARC-Profile": _PROFILE}
    return record("revisit", f"urn:page:{page}", block, date, more)


def member(data: bytes, level: int = 6) -> bytes:
    """``data`` as a gzip member."""
    deflate = zlib.compressobj(level, zlib.DEFLATED, 31)
    return deflate.compress(data) + deflate.flush()


def _keyed(pages: DataFrame) -> DataFrame:
    """(key, page_id, url, html); ``key`` is a text that no two rows share, the
    page_id unless some id repeats or is null."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    ids = rows.groupBy("page_id").agg(F.count(F.lit(1)).alias("n"))
    if ids.where("n > 1 or page_id is null").isEmpty():
        return rows.withColumn("key", F.col("page_id").cast("string"))
    row = F.format_string("%s:%d", F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.monotonically_increasing_id())
    return saved(rows.withColumn("key", row), "keyed-pages")


def write(pages: DataFrame, path: str, min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES,
          compress: bool = True, date: str | None = None) -> None:
    """Write a record for every row of (page_id, url, html) to archives under
    ``path``.  Payloads of fewer than ``min_bytes`` are all response records."""
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    keyed = _keyed(pages)
    sums = saved(keyed.select("key", "page_id", F.octet_length("html").cast("long").alias("n"),
                              F.unhex(F.sha2(F.encode("html", "UTF-8"), 256)).alias("sha")), "payload-sums")
    rows, size = sums.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    archives = 1 + (size + 512 * rows) // archive_bytes
    # one row a payload that repeats, written so that the join below sees two
    # plain exchanges and Spark can split the rows of a frequent payload
    large = sums.where(F.col("n") >= min_bytes)
    lead = saved(large.groupBy("sha").agg(F.count(F.lit(1)).alias("copies"), F.max(F.struct("page_id", "key")).alias("lead"))
                 .where("copies > 1").select("sha", F.col("lead.key").alias("refers_to")), "payload-leads")
    revisits = saved(large.join(lead, "sha").where("key != refers_to").select("key", "refers_to"), "revisits")
    discard(sums, lead)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            for key, url, html, refers_to in zip(*(batch.column(c) for c in ("key", "url", "html", "refers_to"))):
                data = page_record(key.as_py(), url.as_py(), html.as_py().encode(), refers_to.as_py(), date)
                if compress:
                    data = member(data)
                out.append(data[:-1] if data[-1:] == end else data)
                held += len(data)
                if held > _BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])

    end = b"\0" if compress else b"\n"
    # dealt out by page, evenly however often a payload repeats
    made = keyed.repartition(archives, "key").join(revisits.repartition(archives, "key"), "key", "left")
    made = made.select("key", "url", "html", "refers_to").mapInArrow(pack, "value binary")
    made.select(F.col("value").cast("string").alias("value")).write.option("lineSep", end.decode()).text(path)
    discard(revisits)
    if hasattr(keyed, "_saved_at"):
        discard(keyed)


def page_of(record_id: Column) -> Column:
    """The page_id in a record's id; null if there is none."""
    return F.regexp_extract(record_id, "^urn:page:(-?[0-9]+)", 1).try_cast("long")


# ---- reading

class Damaged(ValueError):
    """A record that fails a check; the text says which."""


@dataclass
class Record:
    kind: str
    record_id: str | None
    refers_to: str | None
    uri: str | None
    date: str | None
    payload: bytes | None
    payload_bytes: int | None
    payload_digest: str | None
    start: int = 0
    stop: int = 0
    fields: dict[str, str] = field(default_factory=dict, repr=False)


def _headers(data: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    name = None
    for line in data.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged("header line without a colon")
        name = name.strip().lower()
        out[name] = value.strip()
    return out


def _bare(value: str | None) -> str | None:
    return value.strip("<>") if value else None


def _sha1(value: str | None) -> str | None:
    """The digest of a ``sha1:`` field; other algorithms are not checked."""
    return value[5:].upper() if value and value[:5].lower() == "sha1:" else None


def parse(data: bytes, at: int = 0) -> Record:
    """The record that begins at ``at``, with all checks; ``stop`` is set."""
    version = _VERSION.match(data, at)
    if not version:
        raise Damaged("no version line")
    end = data.find(b"\r\n\r\n", version.end())
    if end < 0:
        raise Damaged("header without an end")
    fields = _headers(data[version.end():end])
    size = fields.get("content-length", "")
    if not (size.isascii() and size.isdigit()):
        raise Damaged("no content length")
    first, stop = end + 4, end + 4 + int(size)
    if stop + 4 > len(data):
        raise Damaged("cut short")
    if data[stop:stop + 4] != b"\r\n\r\n":
        raise Damaged("no record end where the content length says")
    block = data[first:stop]
    stated = _sha1(fields.get("warc-block-digest"))
    if stated and stated != digest(block):
        raise Damaged("block digest differs")
    kind = fields.get("warc-type", "")
    payload: bytes | None = block
    n: int | None = len(block)
    if fields.get("content-type", "").lower().startswith("application/http"):
        head, blank, payload = block.partition(b"\r\n\r\n")
        if not blank:
            raise Damaged("no HTTP header")
        n = len(payload)
        if kind == "revisit":
            length = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)[ \t]*\r?$", head)
            payload, n = None, int(length.group(1)) if length else None
    elif kind == "revisit":
        payload, n = None, None
    stated = _sha1(fields.get("warc-payload-digest"))
    if payload is not None:
        own = digest(payload)
        if stated and stated != own:
            raise Damaged("payload digest differs")
        stated = own
    return Record(kind, _bare(fields.get("warc-record-id")), _bare(fields.get("warc-refers-to")),
                  fields.get("warc-target-uri"), fields.get("warc-date"), payload, n, stated, at, stop + 4, fields)


def inflate(data: bytes, at: int) -> tuple[bytes, int]:
    """The contents of the gzip member that begins at ``at``, and its end."""
    unzip = zlib.decompressobj(31)
    view = memoryview(data)
    out = []
    try:
        while not unzip.eof:
            if at >= len(data):
                raise Damaged("gzip member cut short")
            out.append(unzip.decompress(view[at:at + _FEED]))
            at = min(at + _FEED, len(data))
    except zlib.error as e:
        raise Damaged(f"gzip member: {str(e).rpartition(': ')[2]}") from None
    return b"".join(out), at - len(unzip.unused_data)


def parse_any(data: bytes, at: int) -> tuple[list[Record], int]:
    """The records of the gzip member, or the plain record, at ``at``, and
    where it ends.  All records of a member must be sound."""
    if data[at:at + 2] != b"\x1f\x8b":
        found = parse(data, at)
        return [found], found.stop
    inner, stop = inflate(data, at)
    records, inside = [], 0
    while inside < len(inner) or not records:
        found = parse(inner, inside)
        inside = found.stop
        found.start, found.stop = at, stop
        records.append(found)
    return records, stop


def salvage(data: bytes) -> Iterator[Record | tuple[int, int, str]]:
    """The records of an archive in order, and (start, stop, reason) for each
    stretch of bytes that is in no valid record."""
    at, end = 0, len(data)
    while at < end:
        if data[at] == 0:           # padding between gzip members
            at += 1
            continue
        try:
            records, stop = parse_any(data, at)
        except Damaged as e:
            stop = at + 1
            while stop < end:
                # anywhere, as what was cut short before may end within a line
                stop = min((x for x in (data.find(b"\x1f\x8b\x08", stop), data.find(b"WARC/1.", stop)) if x >= 0), default=end)
                if stop == end:
                    break
                try:
                    parse_any(data, stop)
                    break
                except Damaged:
                    stop += 1
            yield at, stop, str(e)
        else:
            yield from records
        at = stop


_READ = ("archive string, start long, stop long, kind string, record_type string, record_id string, refers_to string, "
         "uri string, date string, payload_bytes long, payload_digest string, reason string")


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """A row for every record and every gap of the archives at ``path``, gzip
    members or plain: the archive, its bytes [start, stop), ``kind`` record or
    gap; of a record its type, ids, URI, date, the size and the base32 SHA-1 of
    its full payload (for a revisit as stated), and the payload if ``payloads``
    (null for a revisit); of a gap the reason."""
    schema = _READ + (", payload binary" if payloads else "")
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [{"long": pa.int64(), "binary": pa.binary()}.get(c.split()[1], pa.string()) for c in schema.split(", ")]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                rows, held = [], 0
                for x in salvage(content.as_py() or b""):
                    if isinstance(x, Record):
                        row = (archive, x.start, x.stop, "record", x.kind, x.record_id, x.refers_to, x.uri, x.date,
                               x.payload_bytes, x.payload_digest, None, x.payload)
                    else:
                        row = (archive, x[0], x[1], "gap", None, None, None, None, None, None, None, x[2], None)
                    rows.append(row[:len(names)])
                    held += 200 + (len(row[-1] or b"") if payloads else 0)
                    if held > _BATCH_BYTES:
                        yield batch_of(rows)
                        rows, held = [], 0
                if rows:
                    yield batch_of(rows)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(scan, schema)


def records(found: DataFrame) -> DataFrame:
    """The records of what ``read`` returns."""
    return found.where("kind = 'record'").drop("kind", "reason")


def gaps(found: DataFrame) -> DataFrame:
    """(archive, start, stop, reason): the log of quarantined bytes."""
    return found.where("kind = 'gap'").select("archive", "start", "stop", "reason")
