"""Operator 9, WARC: pages to seekable Zstandard archives and back.

A partition writes bundles NAME.warc.zst into a folder that driver and executors share. Records are grouped into
independent Zstandard frames of about FRAME bytes; a skippable frame at the end holds the seek table (compressed
and raw size of every frame). The index maps each record identifier to bundle, frame and the offset inside the raw
frame, so that one record costs one ranged read and one decompressed frame.

Of records with equal payloads of at least MIN_REVISIT bytes, that with the largest page_id is the response and the
others are revisits, which keep the HTTP header with the full length, the digest, and the response's page_id and target.
A record's identifier is made from its place in its bundle, so that repeated pages have one each.

Defined results: null html is an empty payload; a null url is an empty target; rows with a null page_id are
archived without an identifier header and never chosen as a response that others revisit, unless no row of the
group has an identifier, in which case each is a response; repeated rows that hold the largest page_id are each a
response; an empty table writes no bundle and reads back no rows; other columns are ignored.
A retried task writes bundles under new names, and the index names only those of the attempt that succeeded.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm import common

MIN_REVISIT = 1000
FRAME, BUNDLE = 128 << 10, 256 << 20
#: Fixed values of the Zstandard skippable frame and of its seekable format.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:page")
INDEX = "record_id string, page_id long, bundle string, frame int, start int, length int"
RECORD = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def assign_types(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, payload, digest (hex SHA-1), refers_to and that page's refers_url (null for responses). A payload crosses one shuffle;
    the side it meets is one small row per repeated payload, and a hot payload's rows can be split there."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), payload.alias("payload"))
    pages = pages.withColumn("digest", F.sha1("payload"))
    again = pages.filter(F.octet_length("payload") >= min_revisit).groupBy("digest").agg(F.max(F.struct("page_id", "url")).alias("last"), F.count(F.lit(1)).alias("n"))
    again = again.filter("n > 1").select("digest", "last").hint("shuffle_hash")
    return pages.join(again, "digest", "left").select("page_id", "url", "payload", "digest", *[F.expr(f"CASE WHEN page_id = last.page_id THEN NULL ELSE last.{x} END").alias(y) for x, y in (("page_id", "refers_to"), ("url", "refers_url"))])


def one_line(url: str) -> str:
    return url.replace("\r", "%0D").replace("\n", "%0A")


def record(name: str, page_id: int | None, url: str, payload: bytes, digest: str, refers_to: int | None, refers_url: str | None, date: str) -> bytes:
    """One WARC/1.1 record under an identifier."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + payload if refers_to is None else http
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name}", f"WARC-Date: {date}",
        "WARC-Target-URI: " + one_line(url), f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Refers-To-Target-URI: {one_line(refers_url)}", f"WARC-Refers-To-Date: {date}", f"X-Refers-To-Page-ID: {refers_to}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Bundle:
    """One archive being written; it appears under its name only when it is complete."""

    def __init__(self, base: str):
        self.fs, root = fs.FileSystem.from_uri(base)
        self.fs.create_dir(root)
        self.name = f"{uuid.uuid4().hex}.warc.zst"
        self.path = posixpath.join(root, self.name)
        self.out = self.fs.open_output_stream(self.path + ".part")
        self.zstd, self.frame, self.raw, self.sizes, self.total = zstandard.ZstdCompressor(level=3), [], 0, [], 0

    def add(self, data: bytes) -> tuple[int, int]:
        if self.raw and self.raw + len(data) > FRAME:
            self.flush()
        at = len(self.sizes), self.raw
        self.frame.append(data)
        self.raw += len(data)
        return at

    def flush(self) -> None:
        if self.raw:
            self.out.write(packed := self.zstd.compress(b"".join(self.frame)))
            self.sizes.append((len(packed), self.raw))
            self.total += len(packed)
            self.frame, self.raw = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *x) for x in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.out.close()
        self.fs.move(self.path + ".part", self.path)


def write_archives(typed: DataFrame, base: str, date: str = "2020-01-01T00:00:00Z") -> DataFrame:
    """The index (INDEX) of the bundles that it writes under the URI base."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, rows = None, []

        def shut():
            nonlocal bundle, rows
            bundle.close()
            done = pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()), pa.array([bundle.name] * len(rows), pa.string()), *(pa.array([r[k] for r in rows], pa.int32()) for k in (2, 3, 4))],
                names=["record_id", "page_id", "bundle", "frame", "start", "length"],
            )
            bundle, rows = None, []
            return done

        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                bundle = bundle or Bundle(base)
                name = f"<urn:uuid:{uuid.uuid5(SPACE, f'{bundle.name}/{len(rows)}')}>"
                data = record(name, *row, date)
                frame, start = bundle.add(data)
                rows.append((name, row[0], frame, start, len(data)))
                if bundle.total >= BUNDLE:
                    yield shut()
        if bundle:
            yield shut()

    return typed.select("page_id", "url", "payload", "digest", "refers_to", "refers_url").mapInArrow(write, INDEX)


def seek_table(source: pa.NativeFile) -> list[tuple[int, int]]:
    """(offset, compressed size) of every frame, from the end of a bundle."""
    size = source.size()
    count, _, magic = struct.unpack("<IBI", source.read_at(9, size - 9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    sizes = [x[0] for x in struct.iter_unpack("<II", source.read_at(8 * count, size - 9 - 8 * count))]
    starts = [0]
    for x in sizes:
        starts.append(starts[-1] + x)
    return list(zip(starts, sizes, strict=False))


def parse(data: bytes) -> tuple:
    """A row (RECORD) of one record's bytes; a response's digest is that of the payload as read."""
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = block[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    full = int(http.rpartition(b"Content-Length: ")[2])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind, refers = fields["WARC-Type"], fields.get("X-Refers-To-Page-ID")
    if kind == "response":
        if len(payload) != full or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    page = fields.get("X-Page-ID")
    return page and int(page), fields["WARC-Target-URI"], kind, refers and int(refers), full, digest, payload if kind == "response" else None


def read_records(index: DataFrame, base: str, payloads: bool = True) -> DataFrame:
    """The records (RECORD) that the index lists, each read through its frame."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(base)
        zstd = zstandard.ZstdDecompressor()
        bundle = source = frames = None
        held, raw = -1, b""
        for batch in batches:
            out: list[tuple] = []
            weight = 0
            for name, frame, start, length in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if name != bundle:
                    if source:
                        source.close()
                    bundle, source, held = name, store.open_input_file(posixpath.join(root, name)), -1
                    frames = seek_table(source)
                if frame != held:
                    at, size = frames[frame]
                    held, raw = frame, zstd.decompress(source.read_at(size, at))
                row = parse(raw[start : start + length])
                out.append(row if payloads else (*row[:6], None))
                weight += length if payloads else 0
                if weight > 32 << 20:
                    yield rows_of(out)
                    out, weight = [], 0
            yield rows_of(out)
        if source:
            source.close()

    return index.select("bundle", "frame", "start", "length").mapInArrow(read, RECORD)


def rows_of(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    names = [x.split()[0] for x in RECORD.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)


def archive_and_read(pages: DataFrame, base: str | None = None) -> DataFrame:
    base = base or common.fresh_path(pages.sparkSession, "warc")
    index = common.cut(write_archives(assign_types(pages), base))
    return read_records(index, base, payloads=False)


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
q AS (SELECT page_id, html, octet_length(encode(html))::BIGINT AS payload_bytes, max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
FROM q
"""
