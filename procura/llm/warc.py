"""WARC archives with segmented records: writing and reassembly.

Writing: every capture becomes an HTTP response in chunked transfer framing
inside a WARC record; of captures with equal payload the one of least id is a
``response``, the others are ``revisit`` records without payload. A record
longer than the segment limit is split into a first segment and
``continuation`` records that name the first one as their origin; the last one
carries the total length. Archives are gzip files in the shared folder.

Reading: archives are parsed by Content-Length; segments are grouped by origin
identifier, ordered by segment number, checked for gaps and against the total
length, joined, and the chunked framing is decoded.

Defined results: a null payload is empty; rows equal in id and payload share
one identifier, so their segments are counted and the row is returned as often
as it was written; a null id is least only if all ids of that payload are
null; null text fields are left out and read back as null. A damaged record
(gap, wrong total, bad framing) is an error. A record must fit in a task;
groups of equal payload may be of any size, since only their minimum is
aggregated.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from procura.llm.common import shared_dir, stored

#: Bytes of a record block before it is segmented, and of a chunk of the transfer framing.
SEGMENT_BYTES = 16 << 10
CHUNK_BYTES = 4 << 10
#: An archive file, which one task reads, holds at most so many bytes of full segments.
ARCHIVE_BYTES = 16 << 20
VERSION = b"WARC/1.1\r\n"
END = b"\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 SHA-1 of a binary column: five bits a digit, from 20-bit groups of the hex digest."""
    groups = [F.lpad(F.conv(F.substring(F.sha1(data), 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    parts = []
    for i in range(0, len(payload), size):
        piece = payload[i : i + size]
        parts += [f"{len(piece):x}\r\n".encode(), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """Payload of a body in chunked transfer framing (chunk extensions and trailers are skipped)."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if len(body) < at + size + 2 or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("chunk does not end where its size says")
        out.append(body[at : at + size])
        at += size + 2


def _record(fields: list[tuple[str, object]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return VERSION + head.encode() + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + END


def _identifier(page_id, digest: str) -> str:
    return f"<urn:capture:{'null' if page_id is None else page_id}:{digest}>"


def capture_records(page_id, url: str | None, payload: bytes, digest: str, refers_to, limit: int) -> list[bytes]:
    """The WARC records of one capture: one, or a first segment with its continuations."""
    own = _identifier(page_id, digest)
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    block = http + (b"\r\n" if revisit else b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload))
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Date", DATE),
        ("WARC-Record-ID", own),
        ("WARC-Target-URI", None if url is None else quote(url, safe=":/?#[]@!$&'()*+,;=%~")),
        ("X-Capture-Url-Escaped", None if url is None else quote(url, safe="")),
        ("X-Capture-Id", page_id),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", len(payload)),
    ]
    if revisit:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        fields += [("WARC-Profile", profile), ("WARC-Refers-To", _identifier(refers_to, digest)), ("X-Refers-To-Id", refers_to)]
    if len(block) <= limit:
        return [_record([*fields, ("Content-Type", "application/http; msgtype=response")], block)]
    parts = [block[i : i + limit] for i in range(0, len(block), limit)]
    out = [_record([*fields, ("WARC-Segment-Number", 1), ("Content-Type", "application/http; msgtype=response")], parts[0])]
    for n, part in enumerate(parts[1:], 2):
        total = len(block) if n == len(parts) else None
        same = [("WARC-Type", "continuation"), ("WARC-Date", DATE), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{own}/{n}')}>")]
        out.append(_record([*same, ("WARC-Segment-Origin-ID", own), ("WARC-Segment-Number", n), ("WARC-Segment-Total-Length", total)], part))
    return out


def write_archives(df: DataFrame, page_id: str, url: str, payload: Column, revisit_from: int = 0, segment_bytes: int = SEGMENT_BYTES) -> str:
    """Write a record per row of ``df`` and return the archives' folder.

    Of rows with equal payload of at least ``revisit_from`` bytes, all but
    those of least id are revisits. Only ids and digests are shuffled to find
    the least id (partial minima first); the rows then meet it by digest.
    """
    spark = df.sparkSession
    rows = df.select(df[page_id].alias("page_id"), df[url].alias("url"), F.coalesce(payload, F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload")))
    first = rows.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    again = stored(first, "warc-first")
    old = F.when((F.octet_length("payload") >= revisit_from) & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id"))
    rows = rows.join(again, "digest", "left").select("page_id", "url", "payload", "digest", old.alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for p, u, data, digest, refers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out += [r[: -len(END)] for r in capture_records(p, u, data, digest, refers, segment_bytes)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    path = f"{shared_dir(spark)}/procura-llm/warc-{uuid.uuid4().hex}"
    records = rows.mapInArrow(run, "record binary").select(F.col("record").cast("string").alias("value"))
    # a text line that ends in an empty line is a WARC record; its bytes are written as they are
    records.write.option("lineSep", END.decode()).option("compression", "gzip").option("maxRecordsPerFile", max(1, ARCHIVE_BYTES // segment_bytes)).text(path)
    return path


def parse_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(fields in lower case, block) of each record of an archive, by Content-Length."""
    at = 0
    while at < len(data):
        if not data.startswith(VERSION, at):
            raise ValueError(f"no WARC record at byte {at}")
        end = data.index(b"\r\n\r\n", at)
        fields = {}
        for line in data[at + len(VERSION) : end].decode().split("\r\n"):
            k, _, v = line.partition(":")
            fields[k.strip().lower()] = v.strip()
        size = int(fields["content-length"])
        block = data[end + 4 : end + 4 + size]
        if len(block) != size:
            raise ValueError("archive ends within a record")
        yield fields, block
        at = end + 4 + size + len(END)


def _unzipped(data: bytes) -> bytes:
    """All members of a gzip file; the bytes of a plain one."""
    if not data.startswith(b"\x1f\x8b"):
        return data
    out = []
    while data:
        member = zlib.decompressobj(31)
        out.append(member.decompress(data) + member.flush())
        data = member.unused_data
    return b"".join(out)


_PART = "origin string, segment int, total long, record_type string, url string, capture_id string, refers_to string, digest string, payload_length long, block binary"


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to) of every capture in the archives.

    Whole records pass through one map; only segments are shuffled, by origin.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for value in batch.column(0):
                rows: list[tuple] = []
                held = 0
                for f, block in parse_archive(_unzipped(value.as_py())):
                    segment = f.get("warc-segment-number")
                    origin = f.get("warc-segment-origin-id") or f["warc-record-id"]
                    total = f.get("warc-segment-total-length")
                    url = f.get("x-capture-url-escaped")
                    digest = f.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    length = f.get("x-payload-length")
                    rows.append((origin, segment and int(segment), total and int(total), f["warc-type"], None if url is None else unquote(url), f.get("x-capture-id"), f.get("x-refers-to-id"), digest, length and int(length), block))
                    held += len(block)
                    if held > 4 << 20:
                        yield _batch(rows)
                        rows, held = [], 0
                if rows:
                    yield _batch(rows)

    read = files.mapInArrow(parts, _PART)
    whole = read.where("segment is null").select("record_type", "url", "capture_id", "refers_to", "digest", "payload_length", "block")
    segments = read.where("segment is not null").groupBy("origin", "segment").agg(*[F.max(c).alias(c) for c in ("total", "url", "capture_id", "refers_to", "digest", "payload_length")], F.max(F.when(F.col("segment") == 1, F.col("record_type"))).alias("record_type"), F.first("block").alias("block"), F.count(F.lit(1)).alias("copies"))
    told = ("record_type", "url", "capture_id", "refers_to", "digest", "payload_length", "total")
    joined = segments.groupBy("origin").agg(F.array_sort(F.collect_list(F.struct("segment", "block", "copies"))).alias("parts"), *[F.max(c).alias(c) for c in told])
    size = F.aggregate("parts", F.lit(0).cast("bigint"), lambda n, p: n + F.octet_length(p["block"]))
    right = (F.element_at("parts", -1)["segment"] == F.size("parts")) & F.col("total").eqNullSafe(size)
    joined = joined.withColumn("block", F.when(right, F.concat_ws("", F.transform("parts", lambda p: F.hex(p["block"])))).otherwise(F.raise_error(F.concat(F.lit("segments missing or total length wrong: "), F.col("origin")))))
    joined = joined.withColumn("block", F.unhex("block")).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("parts")[0]["copies"])))
    captures = whole.unionByName(joined.select(whole.columns))
    return captures.mapInArrow(_decode, "page_id string, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to string")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.int64(), *[pa.string()] * 5, pa.int64(), pa.binary()]
    names = [c.split()[0] for c in _PART.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Payloads out of HTTP blocks; a revisit has none, its length and digest are those of its fields."""
    for batch in batches:
        kinds, urls, ids, refers, digests, lengths, blocks = (c.to_pylist() for c in batch.columns)
        payloads, sizes, sums = [], [], []
        for kind, digest, length, block in zip(kinds, digests, lengths, blocks, strict=True):
            head, _, body = block.partition(b"\r\n\r\n")
            if kind == "revisit":
                payloads.append(None)
                sizes.append(length)
                sums.append(digest)
                continue
            payload = dechunked(body) if b"transfer-encoding: chunked" in head.lower() else body
            own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            if own != digest or len(payload) != length:
                raise ValueError("payload does not have the digest and length that its record names")
            payloads.append(payload)
            sizes.append(len(payload))
            sums.append(own)
        made = [pa.array(ids, pa.string()), pa.array(urls, pa.string()), pa.array(payloads, pa.binary()), pa.array(sizes, pa.int64()), pa.array(sums, pa.string()), pa.array(kinds, pa.string()), pa.array(refers, pa.string())]
        yield pa.RecordBatch.from_arrays(made, names=["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"])
