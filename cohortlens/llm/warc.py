"""Zstandard WARC archives: one frame per record after a dictionary in a leading skippable frame.

The writer deals page rows over archives of bounded size, compresses every record as one frame with a
dictionary trained on the archive's own first payloads, and puts that dictionary into a skippable frame at the
start of the archive. The reader loads it from there, walks the frames, decodes each on its own and
validates WARC and HTTP headers, lengths and digests; a damaged record fails the job.

An archive is a binary cell of a Parquet table that Spark writes below the shared folder, so every
executor can read it whatever file system the cluster has.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from uuid import UUID

import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import bitmap, in_bitmap, slices

DICT_MAGIC = 0x184D2A5D             # fixed value: the skippable frame that holds the dictionary
MIN_REVISIT_BYTES = 1000
ARCHIVE_BYTES = 8 << 20
DICT_BYTES = 32 << 10
DICT_SAMPLE_BYTES = 1 << 20
_CRLF = b"\r\n"
ARCHIVE_SCHEMA = "archive binary, n_records long, first_page long"
RECORD_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def record_uuid(page_id: int | None) -> str:
    """A record id that carries the page id (low 64 bits); a null page id has its own marker."""
    high = 0x77617263_0000_8000 if page_id is not None else 0x77617263_0001_8000
    return f"<urn:uuid:{UUID(int=(high << 64) | ((page_id or 0) & (2**64 - 1)))}>"


def page_of(record_id: str) -> int | None:
    number = UUID(record_id.removeprefix("<urn:uuid:").removesuffix(">")).int
    if (number >> 64) & 0x10000:
        return None
    low = number & (2**64 - 1)
    return low - 2**64 if low >= 2**63 else low


def build_record(page_id, url, payload: bytes, refers_to) -> bytes:
    """A response record, or a revisit (HTTP head without the payload) if ``refers_to`` is given."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    head = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_uuid(page_id)),
            ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")),
            ("WARC-Date", "2000-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{digest}")]
    if refers_to is not None:
        head += [("WARC-Refers-To", record_uuid(refers_to)),
                 ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
    block = http if refers_to is not None else http + payload
    head += [("WARC-Block-Digest", "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()),
             ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return (b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode("utf-8", "surrogatepass") for k, v in head) + _CRLF + block + _CRLF * 2)


def _headers(raw: bytes) -> dict[str, str]:
    out = {}
    for line in raw.split(_CRLF):
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"malformed header line {line[:80]!r}")
        out[name.decode("ascii").lower()] = value.strip().decode("utf-8", "surrogatepass")
    return out


def parse_record(raw: bytes) -> dict:
    """Validate one decoded record and return its fields; raises ``ValueError`` if anything is off."""
    version, _, rest = raw.partition(_CRLF)
    if not re.fullmatch(rb"WARC/1\.[01]", version):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    head, gap, tail = rest.partition(_CRLF * 2)
    h = _headers(head)
    missing = {"warc-type", "warc-record-id", "warc-date", "content-length", "warc-payload-digest"} - set(h)
    if not gap or missing:
        raise ValueError(f"incomplete record header: {sorted(missing)}")
    size = int(h["content-length"])
    if len(tail) != size + 4 or tail[size:] != _CRLF * 2:
        raise ValueError(f"Content-Length {size}, but {len(tail) - 4} bytes stand before the record's end")
    block = tail[:size]
    if "warc-block-digest" in h and base64.b32decode(h["warc-block-digest"].removeprefix("sha1:")) != hashlib.sha1(block).digest():
        raise ValueError("block digest differs")
    http_head, gap, payload = block.partition(_CRLF * 2)
    status, _, fields = http_head.partition(_CRLF)
    if not gap or not status.startswith(b"HTTP/"):
        raise ValueError("malformed HTTP head")
    n, digest = int(_headers(fields)["content-length"]), base64.b32decode(h["warc-payload-digest"].removeprefix("sha1:"))
    kind = h["warc-type"]
    if kind == "response":
        if len(payload) != n or hashlib.sha1(payload).digest() != digest:
            raise ValueError("payload length or digest differs")
    elif kind != "revisit" or payload or "warc-refers-to" not in h:
        raise ValueError(f"bad record of type {kind!r}")
    return {"page_id": page_of(h["warc-record-id"]), "url": h.get("warc-target-uri", ""), "payload_bytes": n,
            "payload_digest": digest.hex(), "record_type": kind,
            "refers_to": page_of(h["warc-refers-to"]) if kind == "revisit" else None, "payload": payload if kind == "response" else None}


def train_dictionary(payloads: list[bytes]) -> bytes:
    """A dictionary from the archive's first payloads (about 1 MB); empty if they are too few or too small."""
    samples, held = [], 0
    for p in payloads:
        if held >= DICT_SAMPLE_BYTES:
            break
        samples += [p[i:i + 4096] for i in range(0, len(p), 4096)]
        held += len(p)
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def write_archive(records: list[bytes], dictionary: bytes = b"", level: int = 3) -> bytes:
    """Skippable dictionary frame, then one frame (with content size and checksum) per record."""
    d = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    c = zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=True, write_checksum=True)
    return b"".join([struct.pack("<II", DICT_MAGIC, len(dictionary)), dictionary, *(c.compress(r) for r in records)])


def frame_end(data: memoryview, start: int) -> int:
    """End of the Zstandard frame at ``start``, from its header and block sizes, without decoding it."""
    params = zstandard.get_frame_parameters(data[start:start + 18])
    at = start + zstandard.frame_header_size(data[start:start + 18])
    last = False
    while not last:
        word = int.from_bytes(data[at:at + 3], "little")
        if at + 3 > len(data):
            raise ValueError("truncated frame")
        last, kind, size = word & 1, (word >> 1) & 3, word >> 3
        at += 3 + (1 if kind == 1 else size)
    at += 4 * params.has_checksum
    if at > len(data):
        raise ValueError("truncated frame")
    return at


def read_archive(archive: bytes) -> Iterator[dict]:
    """Validated records of an archive, one frame at a time."""
    data = memoryview(archive)
    if len(data) < 8:
        raise ValueError("truncated archive")
    magic, size = struct.unpack("<II", data[:8])
    if magic != DICT_MAGIC or len(data) < 8 + size:
        raise ValueError("no dictionary frame at the start")
    raw = bytes(data[8:8 + size])
    if raw[:4] == b"\x28\xb5\x2f\xfd":          # the dictionary itself may be compressed
        raw = zstandard.ZstdDecompressor().decompress(raw)
    d = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw) if raw else None)
    at = 8 + size
    while at < len(data):
        end = frame_end(data, at)
        yield parse_record(d.decompress(data[at:end]))
        at = end


def resolve(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, refers_to: of equal payloads of ``MIN_REVISIT_BYTES`` or more the largest page id answers.

    Only rows whose digest may be one that occurs twice (a bitmap of fixed size tells) are joined; their payloads alone are
    shuffled, and AQE splits a payload that a third of the pages share. All others, short payloads among them, stay where
    they were read. Rows that repeat the largest id are responses too.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.when(F.length("payload") >= MIN_REVISIT_BYTES, F.sha1("payload")))
    groups = (rows.filter(F.col("digest").isNotNull()).groupBy("digest")
              .agg(F.max("page_id").alias("answer"), F.count("*").alias("n")).filter("n > 1").select("digest", "answer"))
    groups = cut_lineage(groups, "revisited")
    bits = pages.sparkSession.sparkContext.broadcast(bitmap(groups.select(F.xxhash64("digest"))))

    @F.pandas_udf("boolean")
    def may_repeat(h: pd.Series) -> pd.Series:
        return pd.Series(in_bitmap(bits.value, h.to_numpy()))
    rows = rows.withColumn("again", F.col("digest").isNotNull() & may_repeat(F.xxhash64("digest")))
    joined = rows.filter("again").join(groups, "digest", "left").select(
        "page_id", "url", "payload",
        F.when(F.col("answer").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("answer")), F.col("answer")).alias("refers_to"))
    return rows.filter("NOT again").select("page_id", "url", "payload", F.lit(None).cast("long").alias("refers_to")).union(joined)


def write_archives(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archive rows (``archive`` binary) of about ``archive_bytes`` of records each, written below the shared folder."""
    def build(batches):
        for part in slices(batches, "payload", archive_bytes):
            ids, urls, payloads, refers = (part.column(c).to_pylist() for c in ("page_id", "url", "payload", "refers_to"))
            records = [build_record(*r) for r in zip(ids, urls, payloads, refers)]
            kept = [p for p, r in zip(payloads, refers) if r is None]
            yield pa.RecordBatch.from_pydict({"archive": [write_archive(records, train_dictionary(kept))],
                                              "n_records": [len(records)], "first_page": pa.array(ids[:1], pa.int64())})
    return cut_lineage(resolve(pages).mapInArrow(build, ARCHIVE_SCHEMA), "warc")


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Validated records of archive rows: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload.

    ``payload`` is null for revisits; without ``payloads`` it is no column (everything is validated all the same). A record that fails validation, or an archive whose number of
    records differs from ``n_records``, raises ``ValueError``.
    """
    schema = RECORD_SCHEMA if payloads else RECORD_SCHEMA.removesuffix(", payload binary")
    names = [f.split()[0] for f in schema.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def read(batches):
        for part in slices(batches, "archive", 1):
            for archive, n in zip(part.column("archive").to_pylist(), part.column("n_records").to_pylist()):
                records = [{c: r[c] for c in names} for r in read_archive(archive)]
                if len(records) != n:
                    raise ValueError(f"{len(records)} records instead of {n}")
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in records], t) for c, t in zip(names, types)], names)
    return archives.select("archive", "n_records").mapInArrow(read, schema)


def round_trip(pages: DataFrame, payloads: bool = True) -> DataFrame:
    """Write the pages as archives and read them back (see ``read_archives``).

    A null html is an empty payload, a null url an empty one (control characters and spaces in it are
    percent-encoded); null page ids and repeated rows are records like any other (a group whose ids are
    all null has responses only). Other columns are ignored. No pages: no archives, no rows.
    """
    return read_archives(write_archives(pages), payloads)


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS payload_digest FROM p),
g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS answer FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND answer <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND answer <> page_id THEN answer END AS refers_to
FROM g"""
