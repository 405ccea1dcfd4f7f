"""WARC archives as seekable Zstandard bundles.

A bundle is one file. Records are gathered into frames of about ``FRAME_BYTES``, each compressed by
itself, so a frame can be read without those before it. A skippable frame at the end holds the seek
table (sizes of all frames before and after decompression, in the published seekable format). The
index maps a record to its bundle, frame, and offset in the decompressed frame.

Bundles are written from tasks and are named after the attempt that wrote them. Only the index,
which Spark commits, says which bundles count, so what a lost executor left behind is never read.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utterflow.llm.tables import Stored
from utterflow.plans.storage import new_folder

FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 64 << 20  # of records; bounds what the reader of a bundle holds
REVISIT_BYTES = 100
LEVEL = 3

# Fixed values of the seekable format: magic numbers of a skippable frame and of the table's end.
_SKIPPABLE = 0x184D2A5E
_SEEKABLE = 0x8F92EAB1
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


class SeekableWriter:
    """Writes frames to a binary stream, and the seek table when it is closed."""

    def __init__(self, stream, frame_bytes: int = FRAME_BYTES):
        self._stream, self._limit = stream, frame_bytes
        self._pack = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self._frame = bytearray()
        self._sizes: list[tuple[int, int]] = []
        self.written = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """Adds a record; returns its frame and its offset in the frame."""
        if self._frame and len(self._frame) + len(record) > self._limit:
            self._flush()
        place = len(self._sizes), len(self._frame)
        self._frame += record
        self.written += len(record)
        return place

    def _flush(self) -> None:
        packed = self._pack.compress(bytes(self._frame))
        self._stream.write(packed)
        self._sizes.append((len(packed), len(self._frame)))
        self._frame.clear()

    def close(self) -> None:
        if self._frame:
            self._flush()
        entries = b"".join(struct.pack("<II", *s) for s in self._sizes)
        end = struct.pack("<IBI", len(self._sizes), 0, _SEEKABLE)
        self._stream.write(struct.pack("<II", _SKIPPABLE, len(entries) + len(end)) + entries + end)
        self._stream.close()


class SeekableReader:
    """Reads single frames of a bundle by its seek table."""

    def __init__(self, file):
        self._file = file
        size = file.size()
        n, _, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
        if magic != _SEEKABLE:
            raise ValueError("not a seekable bundle")
        table = file.read_at(8 * n, size - 9 - 8 * n)
        self.sizes = list(struct.iter_unpack("<II", table))
        self.starts = [0]
        for packed, _ in self.sizes:
            self.starts.append(self.starts[-1] + packed)

    def frame(self, k: int) -> bytes:
        packed = self._file.read_at(self.sizes[k][0], self.starts[k])
        return zstandard.ZstdDecompressor().decompress(packed)


def record_id(page_id) -> str:
    """A record's urn, made from the page's id."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """A response record, or a revisit one if it refers to a page: the same without its payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {_DATE}",
        f"WARC-Page-ID: {'' if page_id is None else page_id}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        safe = url.replace("\r", "%0D").replace("\n", "%0A")
        head.append(f"WARC-Target-URI: {safe}")
    if refers_to is not None:
        head += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Refers-To-Page-ID: {refers_to}"]
        head.append(f"WARC-Profile: {_PROFILE}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed_record(frame: bytes, at: int) -> tuple[dict[str, str], bytes]:
    """Headers and block of the record at an offset of a decompressed frame."""
    end = frame.index(b"\r\n\r\n", at)
    lines = frame[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no record at offset {at}")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    size = int(headers["Content-Length"])
    block = frame[end + 4 : end + 4 + size]
    if len(block) != size or frame[end + 4 + size : end + 8 + size] != b"\r\n\r\n":
        raise ValueError("a record is cut off")
    return headers, block


def _filesystem(folder: str) -> tuple[pafs.FileSystem, str]:
    """Folders without a scheme are local ones; others go to the file system that they name."""
    if "://" in folder or folder.startswith("file:"):
        return pafs.FileSystem.from_uri(folder)
    return pafs.LocalFileSystem(), folder


INDEX = "page_id {id}, bundle string, frame int, offset bigint, size bigint"


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Writes a record per row of ``pages`` and returns the committed index.

    Of rows with equal payloads of at least ``REVISIT_BYTES`` bytes, that with the smallest
    ``page_id`` is a response; the others are revisits. A null page is an empty payload. ``folder``
    must be on a file system that all executors share. An empty table has no bundle.
    """
    id_type = pages.schema["page_id"].dataType.simpleString()
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn(
        "digest", F.sha2("payload", 256)
    )
    lean = rows.select("page_id", "digest", F.octet_length("payload").alias("n"))
    # Equal payloads are counted by digest first; only pages that do have a copy are looked up.
    groups = lean.where(F.col("n") >= REVISIT_BYTES).groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("pages")
    )
    copies = Stored(groups.where("pages > 1").select("digest", "first_id"), "copies").table
    marked = rows.join(copies, "digest", "left")
    revisit = F.col("first_id").isNotNull() & (
        F.col("page_id").isNull() | (F.col("page_id") != F.col("first_id"))
    )
    marked = marked.withColumn("refers_to", F.when(revisit, F.col("first_id")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _filesystem(folder)
        writer = None
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to")]
            places: list[list] = [[], [], [], []]
            for row in zip(*columns):
                if writer is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    writer = SeekableWriter(fs.open_output_stream(f"{path}/{name}", compression=None))
                record = record_bytes(*(v.as_py() for v in row))
                for place, value in zip(places, (name, *writer.add(record), len(record))):
                    place.append(value)
                if writer.written >= BUNDLE_BYTES:
                    writer.close()
                    writer = None
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), *map(pa.array, places, types)], ["page_id", *names]
            )
        if writer is not None:
            writer.close()

    names = ["bundle", "frame", "offset", "size"]
    types = [pa.string(), pa.int32(), pa.int64(), pa.int64()]
    fs, path = _filesystem(folder)
    fs.create_dir(path)
    return Stored(marked.mapInArrow(run, INDEX.format(id=id_type)), "warc-index").table


def read_archives(index: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records that an index names, read from their bundles and checked.

    Returns ``page_id, payload_bytes, payload_digest, record_type, refers_to`` (and ``url,
    payload``, null for revisits, with ``with_payload``). A response's digest is computed from the
    payload that was read and must be the one its header states.
    """
    id_type = index.schema["page_id"].dataType
    columns = (
        f"page_id {id_type.simpleString()}, payload_bytes bigint, payload_digest string,"
        f" record_type string, refers_to {id_type.simpleString()}"
    ) + ", url string, payload binary" * with_payload

    def rows_of(table: pa.Table) -> Iterator[tuple]:
        fs, path = _filesystem(folder)
        order = table.sort_by([("frame", "ascending"), ("offset", "ascending")])
        at, frame = None, b""
        with fs.open_input_file(f"{path}/{table['bundle'][0].as_py()}") as file:
            bundle = SeekableReader(file)
            for k, offset, page in zip(order["frame"], order["offset"], order["page_id"]):
                if k.as_py() != at:
                    at = k.as_py()
                    frame = bundle.frame(at)
                yield _record_row(page, *parsed_record(frame, offset.as_py()), with_payload)

    def run(table: pa.Table) -> pa.Table:
        found = list(zip(*rows_of(table)))
        types = [table["page_id"].type, pa.int64(), pa.string(), pa.string(), table["page_id"].type]
        types += [pa.string(), pa.binary()] * with_payload
        names = [c.split()[0] for c in columns.split(", ")]
        return pa.table([pa.array(c, t) for c, t in zip(found, types)], names=names)

    # A group is a bundle, which one task has written.
    return index.groupBy("bundle").applyInArrow(run, columns)


def _record_row(page: pa.Scalar, headers: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rsplit(b"Content-Length: ", 1)[1])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    kind = headers["WARC-Type"]
    refers_to = headers.get("WARC-Refers-To-Page-ID")
    if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != size):
        raise ValueError(f"page {page}: the payload is not the one that was written")
    if refers_to is not None:
        refers_to = pa.scalar(refers_to).cast(page.type).as_py()
    row = (page.as_py(), size, digest, kind, refers_to)
    if with_payload:
        row += (headers.get("WARC-Target-URI"), payload if kind == "response" else None)
    return row


def archived(pages: DataFrame) -> DataFrame:
    """Writes archives of ``pages`` to a new shared folder and reads every record back."""
    folder = new_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), folder)
