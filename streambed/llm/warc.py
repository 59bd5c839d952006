"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent Zstandard frames; a skippable frame at the end holds the seek
table (the public seekable format). The index maps each record to its archive, frame and place in
that frame's content, so that one record is read by one seek and one frame.

Each task attempt writes an archive under a name of its own. The index is written by Spark, which
keeps the rows of one attempt per task: an archive that it does not name was left by a lost attempt
and is never read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from streambed.llm import common

# Fixed values of the seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
# Bytes of records after which a frame is closed.
FRAME_BYTES = 1 << 18

INDEX = pa.schema(
    [
        ("archive", pa.string()),
        ("frame", pa.int64()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("record_id", pa.string()),
    ]
)
INDEX_SQL = "archive string, frame long, offset long, length long, record_id string"
READ = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
    ]
)
READ_SQL = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, payload binary"
)


def _filesystem(path: str) -> tuple[pa.fs.FileSystem, str]:
    """The file system and path of a URI; ``file:`` and plain paths are the mounted folders."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return (pa.fs.LocalFileSystem(), path) if path.startswith("/") else pa.fs.FileSystem.from_uri(path)


class Writer:
    """One archive: ``add`` gives a record's frame and its place in it, ``close`` adds the seek table."""

    def __init__(self, stream, frame_bytes: int = FRAME_BYTES, level: int = 3):
        import zstandard

        self.stream, self.frame_bytes = stream, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.frames: list[tuple[int, int]] = []
        self.parts: list[bytes] = []
        self.size = 0

    def add(self, record: bytes) -> tuple[int, int]:
        if self.size and self.size + len(record) > self.frame_bytes:
            self._flush()
        place = (len(self.frames), self.size)
        self.parts.append(record)
        self.size += len(record)
        return place

    def _flush(self) -> None:
        packed = self.compressor.compress(b"".join(self.parts))
        self.stream.write(packed)
        self.frames.append((len(packed), self.size))
        self.parts, self.size = [], 0

    def close(self) -> None:
        if self.size:
            self._flush()
        table = b"".join(struct.pack("<II", *frame) for frame in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table) + len(footer)) + table + footer)
        self.stream.close()


class Reader:
    """Random access to the records of one archive."""

    def __init__(self, path: str):
        import zstandard

        files, path = _filesystem(path)
        self.file = files.open_input_file(path)
        size = self.file.size()
        frames, flags, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"{path} has no seek table")
        width = 12 if flags & 0x80 else 8
        table = self.file.read_at(frames * width, size - 9 - frames * width)
        self.places, start = [], 0
        for k in range(frames):
            length, content = struct.unpack_from("<II", table, k * width)
            self.places.append((start, length, content))
            start += length
        self.decompressor = zstandard.ZstdDecompressor()
        self.number, self.content = -1, b""

    def frame(self, number: int) -> bytes:
        if number != self.number:
            start, length, content = self.places[number]
            self.content = self.decompressor.decompress(self.file.read_at(length, start), max_output_size=content)
            self.number = number
        return self.content

    def record(self, frame: int, offset: int, length: int) -> bytes:
        return self.frame(frame)[offset : offset + length]

    def close(self) -> None:
        self.file.close()


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def _number(identifier: str | None) -> int | None:
    text = (identifier or "").strip("<>").removeprefix("urn:page:")
    return int(text) if text else None


def _block(kind: str, headers: list[tuple[str, str]], body: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in headers), f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def encode(page_id: int | None, url: str | None, payload: bytes, response_id: int | None, date: str) -> bytes:
    """A response record, or a revisit of ``response_id`` if that is another page."""
    revisit = response_id is not None and response_id != page_id
    headers = [("WARC-Record-ID", f"<{record_id(page_id)}>"), ("WARC-Date", date)]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe="".join(map(chr, range(33, 127))))))
    headers.append(("WARC-Payload-Digest", f"sha1:{digest(payload)}"))
    if revisit:
        headers.append(("WARC-Refers-To", f"<{record_id(response_id)}>"))
        headers.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
    headers.append(("Content-Type", "application/http;msgtype=response"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return _block("revisit" if revisit else "response", headers, http.encode() + (b"" if revisit else payload))


def decode(record: bytes) -> tuple:
    """The values of ``READ`` of one record."""
    head, body = record.split(b"\r\n\r\n", 1)
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    body = body[: int(headers["Content-Length"])]
    http, payload = body.split(b"\r\n\r\n", 1)
    length = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    kind, found = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or digest(payload) != found):
        raise ValueError(f"{headers['WARC-Record-ID']}: the payload does not match its digest")
    return (
        _number(headers["WARC-Record-ID"]),
        headers.get("WARC-Target-URI"),
        kind,
        _number(headers.get("WARC-Refers-To")),
        length,
        found,
        payload if kind == "response" else None,
    )


def with_responses(
    pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """(page_id, url, payload, response_id): the record that holds each payload of ``min_bytes`` or more.

    Digests are counted without payloads; a frequent payload's rows can be split in the join.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8").alias("payload"),
    ).withColumn("sha1", F.sha1("payload"))
    long_enough = F.octet_length("payload") >= min_bytes
    largest = rows.where(long_enough).groupBy(F.col("sha1").alias("same")).agg(F.max("page_id").alias("response_id"))
    joined = rows.join(largest, (F.col("sha1") == F.col("same")) & long_enough, "left")
    return joined.select("page_id", "url", "payload", "response_id")


def write_archives(
    pages: DataFrame,
    folder: str,
    min_bytes: int = 0,
    frame_bytes: int = FRAME_BYTES,
    date: str = "1970-01-01T00:00:00Z",
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Write a record per row below ``folder`` and return the index, one row per record.

    Of records with equal payloads of at least ``min_bytes`` bytes the one with the largest id is a
    response, the others are revisits of it; smaller ones are all responses. A null html is an empty
    payload. Rows that share the largest id and the payload are responses each; a null id counts for
    no largest, is written as an empty number and read back as null. Blanks and characters outside ASCII in
    a URL are percent-encoded; a null URL has no target header. Other columns are left out; no rows
    give no archive and an empty index.
    """
    archives = f"{folder.rstrip('/')}/archives"

    def run(batches) -> Iterator[pa.RecordBatch]:
        writer = name = None
        try:
            for batch in batches:
                found = []
                for page_id, url, payload, response_id in zip(*(column.to_pylist() for column in batch.columns)):
                    if writer is None:
                        name = f"{archives}/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.zst"
                        files, path = _filesystem(name)
                        files.create_dir(path.rpartition("/")[0], recursive=True)
                        writer = Writer(files.open_output_stream(path, compression=None), frame_bytes)
                        writer.add(_block("warcinfo", [("WARC-Date", date)], b"format: WARC File Format 1.1\r\n"))
                    record = encode(page_id, url, payload, response_id, date)
                    found.append((name, *writer.add(record), len(record), record_id(page_id)))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*found), INDEX)], schema=INDEX
                    )
        finally:
            if writer is not None:
                writer.close()

    rows = common.small_batches(with_responses(pages, min_bytes, id_col, url_col, html_col))
    rows.mapInArrow(run, INDEX_SQL).write.parquet(f"{folder.rstrip('/')}/index")
    return read_index(pages.sparkSession, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX_SQL).parquet(f"{folder.rstrip('/')}/index")


def read_records(index: DataFrame) -> DataFrame:
    """The records that the index names, read by archive, frame and place.

    Columns: page_id, url, record_type, refers_to, payload_bytes, payload_digest (both of the full
    payload, checked against what was read), payload (null for revisits).
    """
    width = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches) -> Iterator[pa.RecordBatch]:
        reader = archive = None
        for batch in batches:
            found, size = [], 0
            for name, frame, offset, length in zip(*(batch.column(k).to_pylist() for k in range(4))):
                if name != archive:
                    if reader:
                        reader.close()
                    reader, archive = Reader(name), name
                found.append(decode(reader.record(frame, offset, length)))
                size += length
                if size >= common.OUT_BYTES:
                    yield _batch(found)
                    found, size = [], 0
            if found:
                yield _batch(found)
        if reader:
            reader.close()

    spread = common.small_batches(index).repartition(width, "archive", "frame")
    return spread.sortWithinPartitions("archive", "frame", "offset").mapInArrow(run, READ_SQL)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), READ)], schema=READ)
