"""WARC archives: segmented, chunk-framed records written and read back.

Writing: one ``response`` record per page (the payload in an HTTP block with
chunked transfer framing), or a ``revisit`` record if an earlier page_id has
the same payload.  Blocks longer than ``segment_bytes`` go on in ``continuation``
records that name the first record as their origin and carry a segment number;
the last one states the total length.  Files are gzip-compressed text parts of
at most ``records_per_file`` records, so a file's size is bounded and it can be
read by one task.

Reading: records are parsed file by file; segments, which may lie in any file,
are grouped by origin identifier, ordered by segment number and accepted only if
the numbers are complete and the lengths add up to the stated total.  Then the
chunk framing is decoded and the payload digest verified; a failure raises.
Revisits are joined with the record they refer to.

Defined cases: null html is an empty payload; a null url has no target header
and reads back as null; page_ids may repeat: rows equal to the response in
page_id and payload are responses themselves; among equal payloads a row
without page_id comes last.  Other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch

SEGMENT_BYTES = 16 * 1024
CHUNK_BYTES = 4 * 1024
RECORDS_PER_FILE = 4096
MIN_REVISIT_BYTES = 0
END = b"\r\n\r\n"
HTTP = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n", b"Transfer-Encoding: chunked\r\n")
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, sha: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}/{sha}')}>"


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """HTTP chunked transfer framing."""
    parts = []
    for i in range(0, len(payload), size):
        piece = payload[i:i + size]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(data: bytes) -> bytes:
    """The payload of a chunk-framed body; extensions and trailers are ignored, broken framing raises."""
    parts, pos = [], 0
    while True:
        line = data.find(b"\r\n", pos)
        if line < 0:
            raise ValueError("chunk size line is not ended")
        size = int(data[pos:line].split(b";")[0].strip(), 16)
        pos = line + 2
        if not size:
            return b"".join(parts)
        if data[pos + size:pos + size + 2] != b"\r\n":
            raise ValueError("chunk is cut or too long")
        parts.append(data[pos:pos + size])
        pos += size + 2


def record(headers: list[tuple[str, object]], block: bytes) -> bytes:
    """One WARC record without the two line ends that close it."""
    lines = ["WARC/1.1", *(f"{k}: {str(v)}" for k, v in headers if v is not None), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + END + block


def records_of(page_id: int | None, url: str | None, payload: bytes, first: int | None, revisit: bool,
               segment_bytes: int) -> Iterator[bytes]:
    """The records of one page."""
    sha = digest(payload)
    target = None if url is None else url.replace("\r", "%0D").replace("\n", "%0A")
    common = [("WARC-Target-URI", target), ("WARC-Date", DATE), ("X-Page-Id", page_id)]
    own = record_id(page_id, sha)
    if revisit:
        yield record([("WARC-Type", "revisit"), ("WARC-Record-ID", own), *common, ("WARC-Profile", PROFILE),
                      ("WARC-Refers-To", record_id(first, sha)), ("WARC-Payload-Digest", f"sha1:{sha}"),
                      ("Content-Type", "application/http; msgtype=response")], HTTP[0] + b"\r\n")
        return
    block = b"".join([*HTTP, b"\r\n", chunked(payload)])
    pieces = [block[i:i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    many = len(pieces) > 1
    yield record([("WARC-Type", "response"), ("WARC-Record-ID", own), *common, ("WARC-Payload-Digest", f"sha1:{sha}"),
                  ("WARC-Segment-Number", 1 if many else None),
                  ("Content-Type", "application/http; msgtype=response")], pieces[0])
    for n, piece in enumerate(pieces[1:], 2):
        yield record([("WARC-Type", "continuation"),
                      ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{own}/{n}')}>"), *common,
                      ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", n),
                      ("WARC-Segment-Total-Length", len(block) if n == len(pieces) else None)], piece)


def write_archives(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES,
                   min_revisit_bytes: int = MIN_REVISIT_BYTES, scratch: Scratch | None = None) -> None:
    """Write ``pages`` (page_id, url, html) as WARC files under ``path``."""
    scratch = scratch or Scratch(pages.sparkSession, "warc")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    sha = F.unhex(F.sha1("payload"))
    firsts = scratch.keep(
        rows.where(F.octet_length("payload") >= min_revisit_bytes).groupBy(sha.alias("sha"))
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("sha", "first"),
        "firsts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes] = []
            for page_id, url, payload, copy, first in zip(*(batch.column(c).to_pylist() for c in (
                    "page_id", "url", "payload", "copy", "first"))):
                out += records_of(page_id, url, payload, first, bool(copy) and page_id != first, segment_bytes)
                if len(out) >= 512:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])
                    out = []
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    joined = rows.join(firsts.withColumn("copy", F.lit(True)), sha == firsts["sha"], "left")
    records = joined.select("page_id", "url", "payload", "copy", "first").mapInArrow(run, "record binary")
    (records.select(F.col("record").cast("string").alias("value")).write.option("lineSep", END.decode())
     .option("maxRecordsPerFile", RECORDS_PER_FILE).text(path, compression="gzip"))


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of every record of an uncompressed archive."""
    pos = 0
    while pos < len(data):
        head = data.find(END, pos)
        if head < 0 or not data.startswith(b"WARC/", pos):
            raise ValueError(f"no WARC record at byte {pos}")
        lines = data[pos:head].decode("utf-8", "surrogatepass").split("\r\n")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        start = head + 4
        stop = start + int(headers["content-length"])
        if data[stop:stop + 4] != END:
            raise ValueError(f"record at byte {pos} does not end after its stated length")
        yield headers, data[start:stop]
        pos = stop + 4


def unpacked(content: bytes) -> bytes:
    """All members of a gzip file."""
    out = []
    while content:
        d = zlib.decompressobj(31)
        out.append(d.decompress(content))
        out.append(d.flush())
        content = d.unused_data
    return b"".join(out)


def payload_of(headers: dict[str, str] | str, block: bytes) -> bytes:
    """The decoded payload of an HTTP response block, verified against the record's digest."""
    head, _, body = block.partition(END)
    framed = any(x.lower().startswith(b"transfer-encoding:") and b"chunked" in x.lower() for x in head.split(b"\r\n"))
    payload = dechunked(body) if framed else body
    stated = headers if isinstance(headers, str) else headers["warc-payload-digest"]
    if stated and stated.removeprefix("sha1:") != digest(payload):
        raise ValueError("payload does not have the digest of its record")
    return payload


_PARSED = ("kind string, id string, page_id long, url string, refers string, sha string, number int, total long, "
           "payload_bytes long, data binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(),
             pa.int64(), pa.binary()]
    names = [c.strip().split(" ")[0] for c in _PARSED.split(",")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def read_archives(spark: SparkSession, path: str, scratch: Scratch, with_payload: bool = True) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest, record_type, refers_to (and payload) of every record under ``path``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                out: list[tuple] = []
                for h, block in parse_records(unpacked(content.as_py())):
                    kind, number = h["warc-type"], h.get("warc-segment-number")
                    page = h.get("x-page-id")
                    sha = h.get("warc-payload-digest", "").removeprefix("sha1:")
                    row = [kind, h["warc-record-id"], int(page) if page else None, h.get("warc-target-uri"),
                           h.get("warc-refers-to"), sha, None, None, None, None]
                    if number:
                        total = h.get("warc-segment-total-length")
                        row[0], row[1] = "segment", h.get("warc-segment-origin-id", row[1])
                        row[6:] = int(number), int(total) if total else None, len(block), block
                    elif kind == "response":
                        payload = payload_of(h, block)
                        row[8:] = len(payload), payload if with_payload else None
                    out.append(tuple(row))
                    if len(out) >= 512:
                        yield _batch(out)
                        out = []
                yield _batch(out)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for origin, url, page_id, sha, parts in zip(*(batch.column(c).to_pylist() for c in (
                    "id", "url", "page_id", "sha", "parts"))):
                parts = sorted({p["number"]: p for p in parts}.items())  # a repeated row repeats its segments
                block = b"".join(p["data"] for _, p in parts)
                total = parts[-1][1]["total"]
                if [n for n, _ in parts] != list(range(1, len(parts) + 1)) or total != len(block):
                    raise ValueError(f"segments of {origin} are incomplete: {len(block)} of {total} bytes")
                payload = payload_of(sha, block)
                out.append(("response", origin, page_id, url, None, sha, None, None, len(payload),
                            payload if with_payload else None))
            yield _batch(out)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    parsed = scratch.keep(files.mapInArrow(run, _PARSED), "records")
    copies = F.count_if(F.col("number") == 1)
    segments = (parsed.where("kind = 'segment'").groupBy("id")
                .agg(F.min("url").alias("url"), F.min("page_id").alias("page_id"), F.max("sha").alias("sha"),
                     copies.alias("copies"), F.collect_list(F.struct("number", "total", "data")).alias("parts")))
    segments = scratch.keep(segments, "segments")
    whole = segments.select("id", "url", "page_id", "sha", "parts").mapInArrow(join, _PARSED)
    again = (segments.where("copies > 1")  # rows that repeat a page_id and payload
             .select(F.col("id").alias("s_id"), F.explode(F.sequence(F.lit(2), F.col("copies").cast("int"))).alias("k")))
    whole = scratch.keep(whole, "whole")
    whole = whole.unionByName(whole.join(again, F.col("id") == F.col("s_id")).drop("s_id", "k"))
    responses = scratch.keep(parsed.where("kind = 'response'").unionByName(whole), "responses")
    originals = (responses.groupBy(F.col("id").alias("o_id"))
                 .agg(F.min("page_id").alias("o_page"), F.min("payload_bytes").alias("o_bytes")))
    originals = scratch.keep(originals, "originals")
    revisits = (parsed.where("kind = 'revisit'").join(originals, F.col("refers") == F.col("o_id"))
                .withColumn("payload_bytes", F.col("o_bytes")))
    out = (responses.withColumn("o_page", F.lit(None).cast("long"))
           .unionByName(revisits.select(*responses.columns, "o_page")))
    columns = ["page_id", "url", "payload_bytes", F.col("sha").alias("payload_digest"),
               F.col("kind").alias("record_type"), F.col("o_page").alias("refers_to")]
    return out.select(*columns, *(["data"] if with_payload else []))


def round_trip(pages: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, as read back from written archives."""
    scratch = scratch or Scratch(pages.sparkSession, "warc")
    path = f"{scratch.base}/archives"
    write_archives(pages, path, scratch=scratch)
    return (read_archives(pages.sparkSession, path, scratch, with_payload=False)
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


ORACLE = r"""
with p as (
  select page_id, encode(coalesce(html, '')) as payload from pages),
h as (select page_id, octet_length(payload) as payload_bytes, lower(sha1(payload)) as hex from p),
b as (
  select *, array_to_string(list_transform(range(1, 41), lambda i:
      substr('0000000100100011010001010110011110001001101010111100110111101111',
             4 * (strpos('0123456789abcdef', substr(hex, i::int, 1)) - 1)::int + 1, 4)), '') as bits
  from h),
d as (
  select page_id, payload_bytes, hex, array_to_string(list_transform(range(0, 32), lambda i:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             (16 * substr(bits, (5 * i + 1)::int, 1)::int + 8 * substr(bits, (5 * i + 2)::int, 1)::int
              + 4 * substr(bits, (5 * i + 3)::int, 1)::int + 2 * substr(bits, (5 * i + 4)::int, 1)::int
              + substr(bits, (5 * i + 5)::int, 1)::int) + 1, 1)), '') as payload_digest
  from b),
f as (select hex, min(page_id) as first_id from h group by hex)
select d.page_id, d.payload_bytes, d.payload_digest,
       case when d.page_id = f.first_id then 'response' else 'revisit' end as record_type,
       case when d.page_id <> f.first_id then f.first_id end as refers_to
from d join f on d.hex = f.hex
"""
