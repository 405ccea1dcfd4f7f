"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints differ in at most 4 bits exactly if some value is within 2 bits of both. So every
distinct fingerprint emits all 2081 values within 2 bits (its ball), and fingerprints that emit a
common value are linked.

The balls are large, so they are shuffled in packed form (``collisions``): a chunk of fingerprints
sends the sorted, shortened hashes of its ball values and learns which of them others emit as well.
Only those values are then sent as rows, grouped by the full value and turned into links. A value
has at most 2081 fingerprints within 2 bits, so no group is larger than that, and it gives a star
of links and not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utterflow.llm import collisions
from utterflow.llm.components import components
from utterflow.llm.tables import Stored

BITS = 64
RADIUS = 4
SHINGLE = 4
SEED = 42
CHUNK = 2048
# Bits of a hashed value beyond what tells the values of a bucket apart.
SPARE_BITS = 15

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SLICE = 1 << 16


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text in UTF-8; zero if it has no word."""
    # bytes.split() splits at blanks and 0x09-0x0D; no byte of a longer character is one of these.
    tokens = (text or b"").translate(_LOWER).split()
    if not tokens:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(tokens) <= shingle:
        hashes = [digest(b" ".join(tokens), SEED)]
    else:
        parts = [tokens[i : len(tokens) - shingle + 1 + i] for i in range(shingle)]
        hashes = [digest(s, SEED) for s in map(b" ".join, zip(*parts))]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), _SLICE):  # bounds the unpacked bits of a long text
        part = np.array(hashes[at : at + _SLICE], np.uint64).astype(">u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp)`` of whole texts; ``fp`` as a signed long, null texts as empty ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter(
                (fingerprint(t.as_py(), shingle) for t in batch.column("text").cast(pa.binary())),
                np.uint64,
                batch.num_rows,
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"]
            )

    ids = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {ids}, fp bigint")


def ball_masks(radius: int = RADIUS) -> np.ndarray:
    """All masks of at most half the radius bits."""
    masks = [0]
    for size in range(1, radius // 2 + 1):
        masks += [sum(1 << b for b in c) for c in combinations(range(BITS), size)]
    return np.array(masks, np.uint64)


def _mixed(values: np.ndarray) -> np.ndarray:
    """A one-to-one mix of 64 bits, in place, so that buckets fill evenly."""
    values ^= values >> np.uint64(31)
    values *= np.uint64(0x9E3779B97F4A7C15)
    values ^= values >> np.uint64(29)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(32)
    return values


def _ball_values(fps: np.ndarray, masks: np.ndarray) -> np.ndarray:
    return _mixed((fps[:, None] ^ masks[None, :]).reshape(-1))


def near_links(fps: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """Links ``(u, v)`` that connect all distinct fingerprints (column ``fp``) within ``radius``.

    Not every pair within the radius is returned, but their components are the same. ``radius``
    is even.
    """
    n = fps.count()
    n_chunks = max(1, -(-n // chunk))
    masks = ball_masks(radius)
    emitted = n * len(masks)
    bits = collisions.bucket_bits(emitted)
    # Values of one block are told apart by log2(block size) bits; SPARE_BITS more keep chance
    # collisions of the shortened hashes rare, whatever the size.
    block = max(1.0, emitted / n_chunks / (1 << bits))
    kept = min(64 - bits, int(np.ceil(np.log2(block))) + SPARE_BITS)
    drop = 64 - bits - kept
    chunked = fps.select((F.pmod(F.xxhash64("fp"), F.lit(n_chunks))).alias("chunk"), "fp")

    def own_values(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints, the values of their balls in place, distinct ones, and repeated ones."""
        own = table["fp"].to_numpy().view(np.uint64)
        every = _ball_values(own, masks)
        every >>= np.uint64(drop)
        ordered = np.sort(every)
        first = np.r_[True, ordered[1:] != ordered[:-1]]
        return own, every, ordered[first], np.unique(ordered[~first])

    def emit(table: pa.Table) -> pa.Table:
        distinct = own_values(table)[2] << np.uint64(drop)
        rows = collisions.split_buckets(table["chunk"][0].as_py(), distinct, bits, drop)
        return pa.Table.from_pylist(list(rows), collisions.PACKED_SCHEMA)

    def meet(table: pa.Table, answers: pa.Table) -> Iterator[pa.RecordBatch]:
        own, every, distinct, repeated = own_values(table)
        flags = collisions.flags_of(answers, distinct << np.uint64(drop), bits)
        shared = np.union1d(distinct[flags], repeated)
        del distinct, flags
        if not len(shared):
            return
        at = np.searchsorted(shared, every)
        at[at == len(shared)] = 0
        hit = np.flatnonzero(shared[at] == every)
        del at, every
        whose, mask = np.divmod(hit, len(masks))
        for low in range(0, len(hit), 1 << 18):
            w, m = whose[low : low + (1 << 18)], mask[low : low + (1 << 18)]
            z = (own[w] ^ masks[m]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(z), pa.array(own[w].view(np.int64))], ["z", "fp"]
            )

    def meet_whole(table: pa.Table, answers: pa.Table) -> pa.Table:
        schema = pa.schema([("z", pa.int64()), ("fp", pa.int64())])
        if not table.num_rows:
            return schema.empty_table()
        return pa.Table.from_batches(list(meet(table, answers)), schema)

    grouped = chunked.groupBy("chunk")
    blocks = grouped.applyInArrow(emit, collisions.PACKED)
    answers = collisions.answered(blocks).groupBy("chunk")
    met = grouped.cogroup(answers).applyInArrow(meet_whole, "z bigint, fp bigint")
    stars = met.groupBy("z").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    return stars.select(
        F.array_min("fps").alias("u"), F.explode("fps").alias("v")
    ).where("u <> v").distinct()


def near_duplicates(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per row of ``docs``.

    Documents are linked if their fingerprints differ in at most ``radius`` bits;
    ``component_id`` is the smallest ``doc_id`` that is reachable. Exact copies have one
    fingerprint, so only distinct fingerprints are compared. Texts without a word have
    fingerprint zero and are linked like any others.
    """
    each = Stored(fingerprints(docs, shingle), "fingerprints").table
    distinct = Stored(
        each.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct"
    ).table
    roots = components(near_links(distinct, radius)).withColumnRenamed("vertex", "fp")
    named = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_print = named.join(lowest, "root").select("fp", "component_id")
    return each.join(of_print, "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def first_of_each_group(docs: DataFrame) -> DataFrame:
    """One document of each group, that with the smallest id, with the columns of ``docs``.

    Of rows that agree in id and text one stays. Rows without an id are in no group.
    """
    found = near_duplicates(docs.where("doc_id IS NOT NULL"))
    others = found.where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(others, "doc_id", "left_anti")
    return kept.dropDuplicates(["doc_id", "text"]).select(*docs.columns)
