"""WARC records in seekable Zstandard bundles, written and read back by Spark.

A bundle is a file of independent Zstandard frames of about ``FRAME_BYTES`` of whole records, and ends
with the seek table of the Zstandard seekable format, so any frame is reached without reading the
ones before it. Spark's own text writer writes the files, one row per frame, with its commit
protocol: a lost executor's half-written file never becomes part of the archive, and any file system
Spark knows will do. The four bytes that the writer puts after each row are the magic number that
must end a seek table; after a data frame they are the content of a skippable frame.

Records of equal payloads are found by digest, counted map-side; only the digests that several
records share take part in a join.

Defined results: a null html is an empty payload; a page without id has an empty record id, comes
after all others in the choice of the response, and its record refers to the response like any
other; equal rows with the largest id are all responses; a null url gives no target URI; line
breaks and blanks in a url are percent-encoded.
"""

from __future__ import annotations

import hashlib
import struct
import uuid

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casequarry.storage import materialize, shared_root

# Payloads of at least so many bytes are stored once.
LEAST_SHARED = 1000
FRAME_BYTES = 256 << 10
# Rows of a file: data frames and the seek table.
ROWS_PER_FILE = 256
LEVEL = 3

# Numbers of the Zstandard frame and seekable formats, profile of WARC/1.1.
_SEEKABLE = struct.pack("<I", 0x8F92EAB1)
_AFTER_FRAME = struct.pack("<II", 0x184D2A50, 4)
_SEEK_TABLE = 0x184D2A5E
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"

COLUMNS = ("page_id", "url", "payload", "digest", "record_type", "refers_to")
RECORDS = """page_id long, payload_bytes long, payload_digest string, record_type string,
    refers_to long, path string, frame_offset long, record_offset long"""


def records(pages: DataFrame) -> DataFrame:
    """``COLUMNS`` of every page: which records carry their payload and which refer to another."""
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    long = F.octet_length("payload") >= LEAST_SHARED
    shared = materialize(
        rows.where(long)
        .groupBy("digest")
        .agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & F.col("response").isNotNull())
        .select("digest", "response", F.lit(True).alias("shared")),
        "shared-payloads",
    )
    other = F.col("shared").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response"))
    return rows.join(shared, "digest", "left").select(
        "page_id",
        "url",
        "payload",
        "digest",
        F.when(other, "revisit").otherwise("response").alias("record_type"),
        F.when(other, F.col("response")).alias("refers_to"),
    )


def _uri(page_id) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _record(page_id, url, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += b"Content-Length: %d\r\n\r\n" % len(payload)
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {_uri(page_id)}", f"WARC-Date: {_DATE}"]
    if url is not None:
        clean = "".join(f"%{ord(c):02X}" if c <= " " else c for c in url)
        head.append(f"WARC-Target-URI: {clean}")
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if kind == "revisit":
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_uri(refers_to)}"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def bundle(batches, rows_per_file: int = ROWS_PER_FILE, frame_bytes: int = FRAME_BYTES):
    """Rows of the files of one task: frames, and a seek table as the last row of each file."""
    compressor = zstandard.ZstdCompressor(level=LEVEL)
    waiting, size, entries = [], 0, []

    def frame() -> bytes:
        plain = b"".join(waiting)
        packed = compressor.compress(plain) + _AFTER_FRAME
        entries.append(struct.pack("<II", len(packed) + len(_SEEKABLE), len(plain)))
        waiting.clear()
        return packed

    def table() -> bytes:
        body = b"".join(entries) + struct.pack("<IB", len(entries), 0)
        entries.clear()
        return struct.pack("<II", _SEEK_TABLE, len(body) + len(_SEEKABLE)) + body

    def rows(*values: bytes) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], names=["frame"])

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in COLUMNS)):
            waiting.append(_record(*row))
            size += len(waiting[-1])
            if size >= frame_bytes:
                size = 0
                yield rows(frame())
                if len(entries) == rows_per_file - 1:
                    yield rows(table())
    if waiting:
        yield rows(frame())
    if entries:
        yield rows(table())


def write(pages: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write one record per page under ``path``."""

    def work(batches):
        yield from bundle(batches, rows_per_file)

    frames = records(pages).select(*COLUMNS).mapInArrow(work, "frame binary")
    (
        frames.select(F.col("frame").cast("string"))
        .write.option("encoding", "ISO-8859-1")
        .option("lineSep", _SEEKABLE.decode("latin-1"))
        .option("maxRecordsPerFile", rows_per_file)
        .text(path)
    )


def seek_table(content: bytes) -> list[tuple[int, int, int]]:
    """``(offset, compressed, plain)`` of every frame, from the end of a bundle."""
    if content[-4:] != _SEEKABLE:
        raise ValueError("no seek table at the end of the bundle")
    number, _ = struct.unpack("<IB", content[-9:-4])
    entries = struct.iter_unpack("<II", content[-9 - 8 * number : -9])
    out, offset = [], 0
    for packed, plain in entries:
        out.append((offset, packed, plain))
        offset += packed
    return out


def open_frame(content: bytes, offset: int) -> bytes:
    """The records of the frame that begins at ``offset``; nothing before it is read."""
    return zstandard.ZstdDecompressor().decompressobj().decompress(content[offset:])


def parse(plain: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record at ``at`` in a frame, and where the next one begins."""
    end = plain.index(b"\r\n\r\n", at)
    version, *lines = plain[at:end].decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"no record at {at}")
    headers = dict(line.split(": ", 1) for line in lines)
    start = end + 4
    stop = start + int(headers["Content-Length"])
    return headers, plain[start:stop], stop + 4


def _page_of(uri: str) -> int | None:
    number = uri.removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def _described(headers: dict[str, str], block: bytes) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(http.decode().rsplit("Content-Length: ", 1)[1])
    if headers["WARC-Type"] == "response":
        found = hashlib.sha1(payload).hexdigest()
        if found != digest or len(payload) != size:
            raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
    refers_to = headers.get("WARC-Refers-To")
    return (
        _page_of(headers["WARC-Record-ID"]),
        size,
        digest,
        headers["WARC-Type"],
        _page_of(refers_to) if refers_to else None,
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the bundles, checked against its digest, with its place.

    ``path``, ``frame_offset`` and ``record_offset`` (within the frame) are the index by which a
    record is found again.
    """
    names = [f.strip().split()[0] for f in RECORDS.split(",")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    types += [pa.int64(), pa.int64()]

    def work(batches):
        for batch in batches:
            for file, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                data = memoryview(content.as_buffer())
                for offset, packed, size in seek_table(bytes(data)):
                    plain = open_frame(data[offset : offset + packed], 0)
                    if len(plain) != size:
                        raise ValueError(f"damaged frame at {offset} of {file}")
                    rows, at = [], 0
                    while at < size:
                        headers, block, following = parse(plain, at)
                        rows.append((*_described(headers, block), file, offset, at))
                        at = following
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    # A task without rows may leave an empty file.
    files = spark.read.format("binaryFile").load(path).where(F.col("length") > 0)
    return files.select("path", "content").mapInArrow(work, RECORDS)


def archive(pages: DataFrame) -> DataFrame:
    """Write the pages to a new archive in the shared folder and read it back."""
    spark = pages.sparkSession
    path = f"{shared_root(spark)}/casequarry/warc-{uuid.uuid4().hex}"
    write(pages, path)
    return read(spark, path)
