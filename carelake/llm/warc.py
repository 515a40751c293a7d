"""Operator 4: WARC archives in Zstandard, one frame per record, the dictionary in a leading skippable frame.

Reading: the first frame of an archive is a skippable frame whose content is the dictionary, plain or compressed. Every
frame after it is one record, decoded by itself; its version line, headers, lengths and payload digest are checked.

Writing: each task writes archives to shared storage and returns their names, so that files of a task that was lost
or run twice are never read: only those in the manifest count.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import urlparse

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.common import located, scratch, table, text_of, written
from carelake.operators.lookup import lookup

#: Payloads from this many bytes on are written once; equal ones become revisits.
REVISIT_BYTES = 100
ARCHIVE_BYTES = 64 << 20
SAMPLES, SAMPLE_BYTES, DICTIONARY_BYTES, LEVEL = 256, 16 << 10, 32 << 10, 3
CHUNK = 1 << 18
DATE = "1970-01-01T00:00:00Z"

# Fixed values of the formats: frame magic numbers, version line, revisit profile.
DICTIONARY_FRAME, ZSTD_FRAME = 0x184D2A5D, 0xFD2FB528
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST = "path string, records bigint, bytes bigint"
RECORDS = (
    "path string, offset bigint, record_id string, record_type string, target_uri string, refers_to_record string,"
    " payload binary, payload_bytes bigint, payload_digest string"
)


def _files(uri: str) -> tuple[fs.FileSystem, str]:
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), parts.path
    return fs.FileSystem.from_uri(uri)


# ---- records -------------------------------------------------------------------------------------


def record(kind: str, record_id: str, uri: str, digest: str, length: int, payload: bytes, refers_to: str | None) -> bytes:
    """One record: an HTTP response, or a revisit that keeps only its HTTP headers. Line breaks in the URI are escaped."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    uri = uri.replace("\r", "%0D").replace("\n", "%0A")
    lines = [
        f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {uri}",
        f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{refers_to}>"]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _headers(head: bytes) -> dict[str, str]:
    found = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon or not name.strip():
            raise ValueError(f"not a header: {line[:80]!r}")
        found[name.strip().lower().decode()] = value.strip().decode()
    return found


def parse(data: bytes) -> dict:
    """A record checked and taken apart; a ValueError says what is wrong."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not gap or version != VERSION:
        raise ValueError(f"not a record: {data[:40]!r}")
    headers = _headers(lines)
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in headers:
            raise ValueError(f"{name} is missing")
    if not headers["content-length"].isdigit():
        raise ValueError("content-length is no number")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"the block has {len(rest) - 4} bytes, content-length says {length}")
    http, gap, payload = rest[:length].partition(b"\r\n\r\n")
    status, _, http_lines = http.partition(b"\r\n")
    if not gap or not status.startswith(b"HTTP/"):
        raise ValueError("the block is no HTTP response")
    declared = _headers(http_lines).get("content-length", "")
    digest = headers.get("warc-payload-digest", "").removeprefix("sha256:")
    kind = headers["warc-type"]
    if kind == "response":
        if declared != str(len(payload)):
            raise ValueError(f"the payload has {len(payload)} bytes, HTTP says {declared}")
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError("the payload differs from its digest")
    elif kind != "revisit" or payload or not declared.isdigit() or "warc-refers-to" not in headers:
        raise ValueError(f"neither a response nor a sound revisit: {kind}")
    return {
        "record_id": headers["warc-record-id"].strip("<>"), "record_type": kind,
        "target_uri": headers.get("warc-target-uri"), "refers_to_record": headers.get("warc-refers-to", "").strip("<>") or None,
        "payload": payload if kind == "response" else None, "payload_bytes": int(declared), "payload_digest": digest,
    }


# ---- archives ------------------------------------------------------------------------------------


def dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on the samples; where they are too few for that, their text itself."""
    samples = [s[:SAMPLE_BYTES] for s in samples]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples)
    except zstandard.ZstdError:
        text = record("response", "urn:page:0", "", "0" * 64, 0, b"", None) + b"".join(samples)
        return zstandard.ZstdCompressionDict(text[-DICTIONARY_BYTES:], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class Writer:
    """One archive. The dictionary is trained on its first records, which are held back until then."""

    def __init__(self, folder: str):
        self.uri = f"{folder}/part-{uuid.uuid4().hex}.warc.zst"
        system, path = _files(self.uri)
        system.create_dir(path.rpartition("/")[0], recursive=True)
        # the name would make pyarrow compress the whole archive once more
        self.out = system.open_output_stream(path, compression=None)
        self.held: list[bytes] = []
        self.compressor: zstandard.ZstdCompressor | None = None
        self.records = self.raw = self.bytes = 0

    def add(self, data: bytes) -> None:
        self.records += 1
        self.raw += len(data)
        if self.compressor:
            self._put(self.compressor.compress(data))
            return
        self.held.append(data)
        if len(self.held) >= SAMPLES or self.raw >= ARCHIVE_BYTES // 4:
            self._begin()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def _begin(self) -> None:
        known = dictionary(self.held)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True)
        content = zstandard.ZstdCompressor(level=19).compress(known.as_bytes())
        self._put(struct.pack("<II", DICTIONARY_FRAME, len(content)) + content)
        held, self.held = self.held, []
        for data in held:
            self._put(self.compressor.compress(data))

    def close(self) -> tuple[str, int, int]:
        if not self.compressor:
            self._begin()
        self.out.close()
        return self.uri, self.records, self.bytes


def read_archive(uri: str) -> Iterator[dict]:
    """The records of an archive in order, with the offset of their frames; a chunk and a record are held at a time."""
    system, path = _files(uri)
    with system.open_input_stream(path, compression=None) as source:
        head = source.read(8)
        if len(head) < 8 or struct.unpack("<I", head[:4])[0] != DICTIONARY_FRAME:
            raise ValueError(f"{uri}: no dictionary frame at its start")
        length = struct.unpack("<I", head[4:])[0]
        content = source.read(length)
        if len(content) != length:
            raise ValueError(f"{uri}: the dictionary frame is cut off")
        if content[:4] == struct.pack("<I", ZSTD_FRAME):
            content = zstandard.ZstdDecompressor().decompress(content)
        decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
        at, data = 8 + length, source.read(CHUNK)
        while data:
            frame, parts, used = decoder.decompressobj(), [], 0
            while True:
                try:
                    parts.append(frame.decompress(data))
                except zstandard.ZstdError as error:
                    raise ValueError(f"{uri}, frame at {at}: {error}") from error
                used += len(data)
                if frame.eof:
                    break
                data = source.read(CHUNK)
                if not data:
                    raise ValueError(f"{uri}, frame at {at}: it is cut off")
            rest = frame.unused_data
            try:
                yield {"path": uri, "offset": at, **parse(b"".join(parts))}
            except ValueError as error:
                raise ValueError(f"{uri}, frame at {at}: {error}") from error
            at += used - len(rest)
            data = rest or source.read(CHUNK)


# ---- the operator --------------------------------------------------------------------------------


def write(records: DataFrame, folder: str) -> DataFrame:
    """Write (kind, record_id, uri, digest, length, payload, refers_to) as archives; returns their manifest, written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, done = None, []
        for batch in batches:
            columns = [batch.column(c) for c in ("kind", "record_id", "uri", "digest", "length", "payload", "refers_to")]
            for row in zip(*columns, strict=True):
                out = out or Writer(folder)
                out.add(record(*(x.as_py() for x in row)))
                if out.raw >= ARCHIVE_BYTES:
                    done.append(out.close())
                    out = None
        if out:
            done.append(out.close())
        yield pa.RecordBatch.from_pylist(
            [{"path": p, "records": n, "bytes": b} for p, n, b in done],
            pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

    return written(records.mapInArrow(run, MANIFEST), "op4-manifest")


def read(manifest: DataFrame) -> DataFrame:
    """The records (`RECORDS`) of the archives named in `path`; an unsound archive fails the job and names the frame."""
    fields = [
        ("path", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()),
        ("target_uri", pa.string()), ("refers_to_record", pa.string()), ("payload", pa.binary()),
        ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                rows, held = [], 0
                for row in read_archive(uri):
                    rows.append(row)
                    held += row["payload_bytes"]
                    if len(rows) >= 512 or held >= 8 << 20:
                        yield pa.RecordBatch.from_pylist(rows, pa.schema(fields))
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, pa.schema(fields))

    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("path").repartition(parts, "path").mapInArrow(run, RECORDS)


def records_of(pages: DataFrame, id_col: str, uri_col: str, payload_col: str) -> DataFrame:
    """The pages as records for `write`. Of equal payloads of at least `REVISIT_BYTES` bytes the smallest id is the
    response (of rows that repeat it, the first), the others revisit it; null ids come last. A null payload is empty."""
    rows, at = located(pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), text_of(uri_col).alias("uri"), text_of(payload_col).alias("html")), True, "op4")
    rows = rows.withColumns({
        "payload": F.col("html").cast("binary"), "digest": F.sha2("html", 256), "length": F.octet_length("html").cast("bigint"),
        "record_id": F.format_string("urn:page:%s:%016x", F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.xxhash64(f"{at}.file", f"{at}.row")),
    }).drop("html")
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "record_id")
    firsts = rows.groupBy("digest", "length").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    firsts = firsts.filter((F.col("length") >= REVISIT_BYTES) & (F.col("n") > 1)).select("digest", "first")
    joined = lookup(rows, firsts, "digest", "left")
    again = F.col("first").isNotNull() & (F.col("first.record_id") != F.col("record_id"))
    return joined.select(
        F.when(again, "revisit").otherwise("response").alias("kind"), "record_id", "uri", "digest", "length",
        F.when(~again, F.col("payload")).otherwise(F.lit(b"")).alias("payload"),
        F.when(again, F.col("first.record_id")).alias("refers_to"))


def _page(record_id: str):
    return F.nullif(F.split_part(F.col(record_id), F.lit(":"), F.lit(3)), F.lit("")).cast("bigint")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages, read the archives back, one row per page. An empty table gives no rows."""
    manifest = write(records_of(table(spark, sf_dir, "pages"), "page_id", "url", "html"), scratch(spark, "op4-archives"))
    back = read(manifest)
    digest = F.when(F.col("record_type") == "response", F.sha2("payload", 256)).otherwise(F.col("payload_digest"))
    return back.select(
        _page("record_id").alias("page_id"), "payload_bytes", digest.alias("payload_digest"), "record_type",
        _page("refers_to_record").alias("refers_to"))


SQL = """
with p as (select page_id, coalesce(html, '') as t, sha256(coalesce(html, '')) as d,
    octet_length(encode(coalesce(html, ''))) as n from pages),
f as (select d, min(page_id) as first from p where n >= 100 group by d)
select page_id, n as payload_bytes, p.d as payload_digest,
  case when first is null or first = page_id then 'response' else 'revisit' end as record_type,
  case when first <> page_id then first end as refers_to
from p left join f on p.d = f.d and n >= 100
"""
