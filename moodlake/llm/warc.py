"""WARC archives as seekable Zstandard bundles, written and read by Spark tasks.

A task writes its records into bundles: records are grouped into frames that
decompress by themselves, and a bundle ends with the Zstandard seek table (a
skippable frame with the size of every frame). The index maps a record's id to
its bundle, frame and place inside the decompressed frame, so that one record is read
by decompressing one frame.

A bundle has a name of its own per attempt, and the index lists only what
successful tasks wrote; what a lost executor leaves behind is never read.
Archives are written below the shared folder through its file system's URI.

Of records with equal payloads of at least ``least_bytes`` bytes, that with the smallest page id is
the response and the others revisit it. Defined results: a NULL payload
is an empty one; rows with the same id and payload are responses of that id each; a NULL id is larger
than any other; a NULL URL leaves out that header; an empty table writes no bundle.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodlake.llm.common import join_hot, scratch_dir, scratch_table

LEAST_BYTES = 0
FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 256 * 1024 * 1024
LEVEL = 3
# Bytes of records that one task reads back: those of a run of 64 frames.
READ_BYTES = 64 * FRAME_BYTES
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# The public Zstandard seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
INDEX = "page_id bigint, record_id string, path string, frame int, place bigint, length bigint"
READ = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def record_id(page_id: int | None) -> str:
    return f"urn:page:{'null' if page_id is None else page_id}"


def _page_of(identifier: str) -> int | None:
    number = identifier.strip("<>").rpartition(":")[2]
    return None if number == "null" else int(number)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One WARC record; a revisit keeps the HTTP head, whose Content-Length is that of the payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if refers_to else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: <{record_id(page_id)}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20%]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to:
        lines += [f"WARC-Refers-To: <{refers_to}>", f"WARC-Profile: {PROFILE}"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Headers and payload of one record; length and digest of a response are those of the payload read, and must be the stated ones."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    name, size = headers["WARC-Record-ID"], int(headers["Content-Length"])
    block = rest[:size]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b": ")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length: "))
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if rest[size:] != b"\r\n\r\n":
        raise ValueError(f"{name}: the record does not end where its Content-Length says")
    if headers["WARC-Type"] == "response":
        read = len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if read != (length, digest):
            raise ValueError(f"{name}: payload of {read[0]} bytes and digest {read[1]}, stated are {length} and {digest}")
    return {"headers": headers, "payload": payload, "payload_bytes": length, "payload_digest": digest}


class Bundle:
    """One archive file that is being written."""

    def __init__(self, folder: str) -> None:
        self.path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        files, place = pyarrow.fs.FileSystem.from_uri(self.path)
        files.create_dir(place.rpartition("/")[0], recursive=True)
        self.out = files.open_output_stream(place, compression=None)
        self.packer = zstandard.ZstdCompressor(level=LEVEL)
        self.frames: list[tuple[int, int]] = []
        self.held: list[bytes] = []
        self.size = self.total = 0

    def add(self, data: bytes) -> tuple[int, int]:
        """Frame and place of a record."""
        if self.size and self.size + len(data) > FRAME_BYTES:
            self.flush()
        at = self.size
        self.held.append(data)
        self.size += len(data)
        return len(self.frames), at

    def flush(self) -> None:
        if self.held:
            packed = self.packer.compress(b"".join(self.held))
            self.out.write(packed)
            self.frames.append((len(packed), self.size))
            self.total += len(packed)
            self.held, self.size = [], 0

    def close(self) -> None:
        self.flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


class Reader:
    """Random access to the frames of one archive file through its seek table."""

    def __init__(self, path: str) -> None:
        files, place = pyarrow.fs.FileSystem.from_uri(path)
        self.file = files.open_input_file(place)
        size = self.file.size()
        count, _, magic = struct.unpack("<IBI", self.file.read_at(9, size - 9))
        if magic != SEEKABLE:
            raise ValueError(f"{path} has no seek table")
        table = self.file.read_at(8 * count, size - 9 - 8 * count)
        self.sizes = [struct.unpack_from("<II", table, 8 * i) for i in range(count)]
        self.starts = [0]
        for packed, _ in self.sizes:
            self.starts.append(self.starts[-1] + packed)
        self.last: tuple[int, bytes] = (-1, b"")

    def frame(self, number: int) -> bytes:
        if self.last[0] != number:
            packed, plain = self.sizes[number]
            data = self.file.read_at(packed, self.starts[number])
            self.last = (number, zstandard.ZstdDecompressor().decompress(data, max_output_size=plain))
        return self.last[1]

    def record(self, frame: int, place: int, length: int) -> dict:
        return parse(self.frame(frame)[place:place + length])


def _roles(pages: DataFrame, least_bytes: int) -> DataFrame:
    """``id``, ``url``, ``payload``, ``first`` (the id of the response it revisits, coded, else NULL)."""
    rows = pages.withColumn("digest", F.sha1("payload"))
    shared = rows.filter(F.octet_length("payload") >= least_bytes).groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("first")
    )
    # Every digest takes part, so that the join knows which ones are common.
    joined = join_hot(rows, scratch_table(shared, "payloads"), "digest", "n")
    return joined.withColumn("first", F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first"))).select("id", "url", "payload", "first")


def write(
    pages: DataFrame, id_col: str = "page_id", url: str = "url", payload: str = "html", folder: str | None = None,
    least_bytes: int = LEAST_BYTES,
) -> DataFrame:
    """Write the archives below ``folder`` (default: a new one in the shared folder); returns the index, stored."""
    target = folder or scratch_dir(pages.sparkSession, "warc")
    rows = pages.select(
        F.col(id_col).cast("long").alias("id"), F.col(url).alias("url"), F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = None
        for batch in batches:
            found = []
            for page, link, text, first in zip(*[batch.column(i) for i in range(4)]):
                if bundle is None or bundle.total > BUNDLE_BYTES:
                    if bundle is not None:
                        bundle.close()
                    bundle = Bundle(target)
                revisits = None if first.as_py() is None else record_id(first.as_py())
                data = record(page.as_py(), link.as_py(), text.as_py().encode(), revisits)
                frame, place = bundle.add(data)
                found.append((page.as_py(), record_id(page.as_py()), bundle.path, frame, place, len(data)))
            names = ["page_id", "record_id", "path", "frame", "place", "length"]
            kinds = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*found) if found else [[]] * 6, kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=names)
        if bundle is not None:
            bundle.close()

    return scratch_table(_roles(rows, least_bytes).mapInArrow(run, INDEX), "warc_index")


def read(index: DataFrame) -> DataFrame:
    """Read the records the index names: one row per index row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader: Reader | None = None
        path = None
        for batch in batches:
            out = []
            for where, frame, place, length in zip(*[batch.column(c).to_pylist() for c in ("path", "frame", "place", "length")]):
                if where != path:
                    reader, path = Reader(where), where
                got = reader.record(frame, place, length)
                headers = got["headers"]
                kind = headers["WARC-Type"]
                link = headers.get("WARC-Target-URI")
                out.append((
                    _page_of(headers["WARC-Record-ID"]),
                    None if link is None else re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), link),
                    got["payload_bytes"], got["payload_digest"], kind,
                    _page_of(headers["WARC-Refers-To"]) if kind == "revisit" else None,
                ))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 6, kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    # Neighbouring frames of a bundle go to one task, so that a frame is decompressed once.
    # The index is tiny beside what is read, so the number of tasks follows the records' bytes and is not left to adaptive merging.
    tasks = -(-(index.agg(F.sum("length")).first()[0] or 0) // READ_BYTES) or 1
    dealt = index.withColumn("run", F.expr("frame div 64")).repartition(tasks, "path", "run").sortWithinPartitions("path", "frame", "place")
    return dealt.drop("run").mapInArrow(run, READ)
