"""Which 64-bit values of a chunk also occur in other chunks, by a compact shuffle.

A chunk (a bounded group of rows that one task holds) turns into sorted values. Sending them as
rows would cost 20 bytes and more each. Here a chunk sends one packed block per bucket of the value
range; the task of a bucket compares the blocks and sends back one bit per value. The chunk, made
again from its rows, then knows which of its values others share. Every value takes part; nothing
is sampled or capped.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

PACKED = "chunk bigint, bucket bigint, packed binary"
PACKED_SCHEMA = pa.schema(
    [("chunk", pa.int64()), ("bucket", pa.int64()), ("packed", pa.binary())]
)


def bucket_bits(values: int, per_bucket: int = 1 << 22) -> int:
    """Bits of the bucket number, so that a bucket holds about ``per_bucket`` of all values."""
    return min(24, max(0, int(np.ceil(np.log2(max(1, values) / per_bucket)))))


def _pack_column(values: np.ndarray) -> bytes:
    """Unsigned values as byte planes, without the planes that are all zero."""
    top = int(values.max()) if len(values) else 0
    width = (top.bit_length() + 7) // 8
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + np.ascontiguousarray(planes.T).tobytes()


def _unpack_column(data: memoryview, n: int) -> tuple[np.ndarray, int]:
    width = data[0]
    planes = np.zeros((n, 8), np.uint8)
    raw = np.frombuffer(data[1 : 1 + width * n], np.uint8).reshape(width, n)
    planes[:, :width] = raw.T
    return planes.reshape(-1).view("<u8"), 1 + width * n


def pack(values: np.ndarray, labels: np.ndarray | None = None) -> bytes:
    """Sorted values as differences, with a label (such as a document id) each or none."""
    n = len(values)
    parts = [n.to_bytes(8, "little"), bytes([labels is not None])]
    parts.append(_pack_column(np.diff(values, prepend=np.uint64(0))))
    if labels is not None:
        low = int(labels.min()) if n else 0
        known, index = np.unique(labels, return_inverse=True)
        parts.append(len(known).to_bytes(8, "little"))
        parts.append(low.to_bytes(8, "little", signed=True))
        parts.append(_pack_column((known - low).astype(np.uint64)))
        parts.append(_pack_column(index.astype(np.uint64)))
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray | None]:
    data = memoryview(zstandard.ZstdDecompressor().decompress(packed))
    n = int.from_bytes(data[:8], "little")
    labelled, at = data[8], 9
    steps, used = _unpack_column(data[at:], n)
    at += used
    values = np.cumsum(steps, dtype=np.uint64)
    if not labelled:
        return values, None
    n_known = int.from_bytes(data[at : at + 8], "little")
    low = int.from_bytes(data[at + 8 : at + 16], "little", signed=True)
    known, used = _unpack_column(data[at + 16 :], n_known)
    index, _ = _unpack_column(data[at + 16 + used :], n)
    return values, (known.astype(np.int64) + low)[index.astype(np.int64)]


def split_buckets(
    chunk: int, values: np.ndarray, bits: int, drop: int = 0, labels: np.ndarray | None = None
) -> Iterator[dict]:
    """The blocks of a chunk from its sorted, distinct 64-bit values.

    The bucket is the top ``bits``; the lowest ``drop`` bits are left out, which can only make
    values look alike that are not, never the reverse.
    """
    for bucket, low, high in bucket_slices(values, bits):
        inside = values[low:high] >> np.uint64(drop)
        inside &= np.uint64((1 << (64 - bits - drop)) - 1)
        own = None if labels is None else labels[low:high]
        yield {"chunk": chunk, "bucket": bucket, "packed": pack(inside, own)}


def bucket_slices(values: np.ndarray, bits: int) -> Iterator[tuple[int, int, int]]:
    """``(bucket, start, end)`` of the buckets that sorted values fall into."""
    if not len(values):
        return
    if not bits:
        yield 0, 0, len(values)
        return
    buckets = values >> np.uint64(64 - bits)
    edges = np.flatnonzero(np.diff(buckets)) + 1
    starts, ends = np.r_[0, edges], np.r_[edges, len(values)]
    for bucket, low, high in zip(buckets[starts].tolist(), starts.tolist(), ends.tolist()):
        yield bucket, low, high


def _answers(table: pa.Table) -> pa.Table:
    """Per block of one bucket, a bit per value: set if another chunk has it (by label: with a
    smaller label)."""
    chunks = table["chunk"].to_pylist()
    blocks = [unpack(p.as_py()) for p in table["packed"]]
    sizes = [len(v) for v, _ in blocks]
    values = np.concatenate([v for v, _ in blocks])
    labels = blocks[0][1]
    if labels is not None:
        labels = np.concatenate([own for _, own in blocks])
    del blocks
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    first = np.r_[True, ordered[1:] != ordered[:-1]]
    starts = np.flatnonzero(first)
    if labels is None:
        counts = np.diff(np.r_[starts, len(ordered)])
        hit = np.repeat(counts > 1, counts)
    else:
        least = np.minimum.reduceat(labels[order], starts)
        counts = np.diff(np.r_[starts, len(ordered)])
        hit = labels[order] > np.repeat(least, counts)
    flags = np.empty(len(values), bool)
    flags[order] = hit
    ends = np.cumsum(sizes)
    bits = [np.packbits(flags[e - n : e]).tobytes() for n, e in zip(sizes, ends)]
    bits = [zstandard.ZstdCompressor(level=1).compress(b) for b in bits]
    return pa.table(
        {
            "chunk": pa.array(chunks, pa.int64()),
            "bucket": table["bucket"],
            "packed": pa.array(bits, pa.binary()),
        }
    )


def answered(blocks: DataFrame) -> DataFrame:
    """Blocks ``(chunk, bucket, packed)`` with the bits of the values instead of the values."""
    return blocks.groupBy("bucket").applyInArrow(_answers, PACKED)


def flags_of(answers: pa.Table, values: np.ndarray, bits: int) -> np.ndarray:
    """The bits of all buckets of one chunk, in the order of its sorted values."""
    by_bucket = dict(zip(answers["bucket"].to_pylist(), answers["packed"]))
    flags = np.zeros(len(values), bool)
    for bucket, low, high in bucket_slices(values, bits):
        packed = zstandard.ZstdDecompressor().decompress(by_bucket[bucket].as_py())
        flags[low:high] = np.unpackbits(np.frombuffer(packed, np.uint8), count=high - low)
    return flags
