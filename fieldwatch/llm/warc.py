"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent Zstandard frames of about ``frame_bytes``; a bundle is a run of frames and, in a closing
skippable frame, the public seek table (compressed and decompressed size of each frame). Any Zstandard reader yields the plain WARC
stream; with the table and an index of (record, bundle, frame, offset in the frame, length), a record costs one range read of one frame.

Every task writes bundles of its own, under names no other attempt uses, and returns index rows; the index is written as a table, and
names only bundles of the attempts that counted, so lost executors leave unread files at worst. Bundles go to a folder that all executors reach.

Of records with equal payloads of at least ``min_revisit_bytes`` the one with the smallest page_id is a response, the others are
revisits that name it. Payloads are compared by SHA-1; only digests that occur twice take part in the join, spread by a salt.

Defined results: null html is the empty payload, null url leaves the target out. A null page_id is carried along and never referred to; if all
copies lack an id, all are responses, as are rows that repeat the smallest page_id.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldwatch.llm.common import new_path

#: Fixed values of the seekable format: a skippable frame's magic number, and the footer's.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
INDEX = "record_id string, page_id long, bundle string, frame int, offset int, length int"
RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI or plain local path."""
    return pafs.FileSystem.from_uri(uri) if re.match(r"[a-z0-9+.-]+:/", uri) else (pafs.LocalFileSystem(), uri)


def record_id(page_id: int | None, payload_sha1: str, url: str | None) -> str:
    return f"urn:x-page:{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{payload_sha1} {url}')}"


def record(page_id: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record; a revisit keeps the payload's HTTP headers without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    b32 = lambda digest: base64.b32encode(digest).decode()
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{record_id(page_id, sha1, url)}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{b32(bytes.fromhex(sha1))}",
        f"WARC-Block-Digest: sha1:{b32(hashlib.sha1(block).digest())}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.insert(3, f"WARC-Target-URI: {re.sub(r'[^!-~]', lambda m: quote(m[0]), url)}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{record_id(refers_to, sha1, None)}>", f"WARC-Profile: {REVISIT}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Bundle:
    """Writes frames to one new file and closes it with the seek table."""

    def __init__(self, folder: str, level: int) -> None:
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        fs, path = filesystem(self.path)
        self.file = fs.open_output_stream(path, compression=None)
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True)
        self.frames: list[tuple[int, int]] = []
        self.size = 0

    def add(self, frame: bytes) -> None:
        data = self.compressor.compress(frame)
        self.file.write(data)
        self.frames.append((len(data), len(frame)))
        self.size += len(data)

    def close(self) -> None:
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.file.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.file.close()


@lru_cache(maxsize=64)
def seek_table(bundle: str) -> tuple[tuple[int, int, int], ...]:
    """(place, compressed size, decompressed size) of each frame, from the footer."""
    fs, path = filesystem(bundle)
    with fs.open_input_file(path) as file:
        size = file.size()
        count, _, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != SEEKABLE:
            raise ValueError(f"{bundle}: no seek table")
        table = file.read_at(8 * count, size - 9 - 8 * count)
    out, at = [], 0
    for k in range(count):
        packed, plain = struct.unpack_from("<II", table, 8 * k)
        out.append((at, packed, plain))
        at += packed
    return tuple(out)


def read_frame(bundle: str, frame: int) -> bytes:
    at, packed, plain = seek_table(bundle)[frame]
    fs, path = filesystem(bundle)
    with fs.open_input_file(path) as file:
        return zstandard.ZstdDecompressor().decompress(file.read_at(packed, at), max_output_size=plain)


#: Frames of about a megabyte that one task reads back.
FRAMES_A_TASK = 8


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields and payload of one record."""
    fields = lambda part: dict(line.split(": ", 1) for line in part.decode().split("\r\n")[1:])
    head, rest = data.split(b"\r\n\r\n", 1)
    warc = fields(head)
    block = rest[: int(warc["Content-Length"])]
    http, payload = block.split(b"\r\n\r\n", 1)
    if hashlib.sha1(block).digest() != base64.b32decode(warc["WARC-Block-Digest"].removeprefix("sha1:")):
        raise ValueError(f"{warc['WARC-Record-ID']}: the block doesn't match its digest")
    return warc, fields(http), payload


def with_copies(pages: DataFrame, min_revisit_bytes: int = 0, salts: int = 8) -> DataFrame:
    """page_id, url, html, sha1 (hexadecimal) and refers_to, null for responses."""
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html")).withColumn("sha1", F.sha1("html"))
    large = F.octet_length("html") >= min_revisit_bytes
    copies = rows.filter(large).groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 AND first IS NOT NULL")
    copies = copies.select("sha1", "first", F.explode(F.array(*[F.lit(k) for k in range(salts)])).alias("salt"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int"))
    refers = F.when(large & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return salted.join(copies, ["sha1", "salt"], "left").select("page_id", "url", "html", "sha1", refers.alias("refers_to"))


def write(pages: DataFrame, folder: str, frame_bytes: int = 1 << 20, bundle_bytes: int = 1 << 28, level: int = 3, date: str = "2024-01-01T00:00:00Z", **options: int) -> DataFrame:
    """Writes all pages to bundles in folder, and returns their index as a table kept there."""
    fs, path = filesystem(folder)
    fs.create_dir(f"{path}/bundles", recursive=True)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle, frame, size, pending = None, [], 0, []
        names = [field.split()[0] for field in INDEX.split(", ")]

        def flush() -> pa.RecordBatch:
            nonlocal bundle, frame, size, pending
            bundle = bundle or Bundle(f"{folder}/bundles", level)
            bundle.add(b"".join(frame))
            n = len(pending)
            columns = [[p[0] for p in pending], [p[1] for p in pending], [bundle.path] * n, [len(bundle.frames) - 1] * n, [p[2] for p in pending], [p[3] for p in pending]]
            types = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32())
            if bundle.size >= bundle_bytes:
                bundle.close()
                bundle = None
            frame, size, pending = [], 0, []
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        for batch in batches:
            for page_id, url, html, sha1, refers in zip(*batch.columns, strict=True):
                page_id, url, sha1 = page_id.as_py(), url.as_py(), sha1.as_py()
                data = record(page_id, url, html.as_py().encode("utf-8", "surrogatepass"), sha1, refers.as_py(), date)
                pending.append((record_id(page_id, sha1, url), page_id, size, len(data)))
                frame.append(data)
                size += len(data)
                if size >= frame_bytes:
                    yield flush()
        if pending:
            yield flush()
        if bundle:
            bundle.close()

    with_copies(pages, **options).mapInArrow(each, INDEX).write.parquet(f"{folder}/index")
    return pages.sparkSession.read.schema(INDEX).parquet(f"{folder}/index")


def read(index: DataFrame) -> DataFrame:
    """The records that index names, from their bundles: page_id, payload size and digest, type, what a revisit refers to, and url.

    index may be any part of a written index; only the frames it touches are read, FRAMES_A_TASK of them by a task: the index is small, and its size says nothing of the archives'.
    A response's payload is checked against its digest.
    """
    touched = index.agg(F.count_distinct("bundle", "frame")).first()[0]
    frames = index.repartition(max(1, -(-touched // FRAMES_A_TASK)), "bundle", "frame").groupBy("bundle", "frame").agg(F.collect_list(F.struct("page_id", "offset", "length")).alias("records"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bundle, frame, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                data, rows = read_frame(bundle, frame), []
                for r in records:
                    warc, http, payload = parse(data[r["offset"] : r["offset"] + r["length"]])
                    kind, digest = warc["WARC-Type"], warc["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"{warc['WARC-Record-ID']}: the payload doesn't match its digest")
                    refers = warc.get("WARC-Refers-To", "").strip("<>").rpartition(":")[2]
                    rows.append((r["page_id"], int(http["Content-Length"]), digest, kind, int(refers) if refers else None, warc.get("WARC-Target-URI")))
                types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=[f.split()[0] for f in RESULT.split(", ")])

    return frames.mapInArrow(each, RESULT)


def round_trip(spark: SparkSession, pages: DataFrame, **options: int) -> DataFrame:
    """All pages written as WARC to a new shared folder and read back."""
    return read(write(pages, new_path(spark, "warc"), **options)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
