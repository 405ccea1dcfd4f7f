"""Repeated byte strings across documents by suffix arrays.

The corpus is cut into chunks of whole documents that one task can hold.

1. *Anchors.* Of the ``length`` - ``ANCHOR`` + 1 windows of ``ANCHOR`` bytes in a string of
   ``length`` bytes, the one with the smallest hash is its anchor. Equal strings have equal anchors,
   so a string can only repeat if its anchor does. The chunks learn which of their anchors occur
   again (``collisions``), and all else is left alone from here on.
2. *Suffix arrays.* A chunk sorts the suffixes of what is left in two stages: suffixes smaller than
   their successor are sorted directly, the others are induced by scanning the buckets of first
   bytes. Runs of suffixes whose adjacent common prefixes reach ``length`` are its distinct strings.
3. *Meeting.* Each distinct string goes once per chunk, as a 64-bit hash with the smallest document
   that has it. The chunk learns which strings a smaller document of another chunk has.

Chunks never depend on each other's texts, and a string that a third of all documents share is one
entry per chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utterflow.llm import collisions
from utterflow.llm.tables import Stored

LENGTH = 50
ANCHOR = 24
CHUNK_BYTES = 1 << 20
BUCKET_VALUES = 1 << 20
SPARE_BITS = 18  # of an anchor hash beyond what tells the anchors of a block apart

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


# --- suffix arrays -----------------------------------------------------------


def _words(data: np.ndarray) -> np.ndarray:
    """At each place the next eight bytes as a big-endian number, zeros behind the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)]).astype(np.uint64)
    words = padded[: len(data)].copy()
    for k in range(1, 8):
        words <<= np.uint64(8)
        words |= padded[k : k + len(data)]
    return words


def _sorted_directly(places: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Places in the order of the next ``depth`` bytes or a few more, eight bytes at a time.

    Only what is still tied is compared further.
    """
    order = places[np.argsort(words[places], kind="stable")]
    if not len(order):
        return order
    tied = np.arange(len(order))
    group = np.zeros(len(order), np.int64)
    for at in range(0, depth, 8):
        inside = order[tied] + at
        value = np.where(inside < len(words), words[np.minimum(inside, len(words) - 1)], 0)
        if at:
            by = np.lexsort((value, group))
            order[tied] = order[tied][by]
            value = value[by]
        change = np.r_[True, (value[1:] != value[:-1]) | (group[1:] != group[:-1])]
        group = np.cumsum(change)
        sizes = np.bincount(group)
        open_ = sizes[group] > 1
        tied, group = tied[open_], group[open_]
        if not len(tied):
            break
    return order


def suffix_array(data: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """The suffixes of a byte array in the order of their first ``depth`` bytes (at least).

    Two stages: suffixes that are smaller than their successor are sorted directly. A larger one
    follows from its successor, which stands before it: scanning the buckets of first bytes upwards,
    each suffix puts its predecessor, if that is a larger one, at the next free place of its bucket.
    """
    n = len(data)
    if not n:
        return np.empty(0, np.int64)
    # The empty suffix behind the end is the smallest, so the last suffix is a larger one. A run of
    # equal bytes has the type of its last place.
    following = np.r_[data[1:], np.uint8(0)]
    rises = data < following
    rises[-1] = False
    differs = data != following
    differs[-1] = True
    last = np.flatnonzero(differs)
    smaller = rises[last[np.searchsorted(last, np.arange(n))]]
    words = _words(data)
    direct = _sorted_directly(np.flatnonzero(smaller), words, depth)
    counts = np.bincount(data, minlength=256)
    n_direct = np.bincount(data[direct], minlength=256)
    starts = np.r_[0, np.cumsum(counts)]
    order = np.empty(n, np.int64)
    at = 0
    for c in range(256):  # the directly sorted ones end their buckets
        order[starts[c + 1] - n_direct[c] : starts[c + 1]] = direct[at : at + n_direct[c]]
        at += n_direct[c]
    free = starts[:-1].copy()

    def put_predecessors(of: np.ndarray) -> None:
        before = of[of > 0] - 1
        before = before[~smaller[before]]
        if not len(before):
            return
        byte = data[before]
        by = np.argsort(byte, kind="stable")
        before, byte = before[by], byte[by]
        found, first, number = np.unique(byte, return_index=True, return_counts=True)
        for c, i, k in zip(found.tolist(), first.tolist(), number.tolist()):
            order[free[c] : free[c] + k] = before[i : i + k]
            free[c] += k

    put_predecessors(np.array([n]))
    for c in np.flatnonzero(counts).tolist():
        done = starts[c]
        while done < free[c]:  # a wave puts the predecessors that begin with the same byte
            upto = free[c]
            put_predecessors(order[done:upto])
            done = upto
        put_predecessors(order[starts[c + 1] - n_direct[c] : starts[c + 1]])
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """For each suffix the bytes it has in common with the one before it, counted up to ``depth``."""
    n = len(order)
    shared = np.zeros(n, np.int64)
    if n < 2:
        return shared
    words = _words(data)
    rows = np.arange(1, n)
    for at in range(0, depth, 8):
        a, b = order[rows - 1] + at, order[rows] + at
        within = (a < n) & (b < n)
        rows, a, b = rows[within], a[within], b[within]
        apart = words[a] ^ words[b]
        same = np.full(len(rows), 8)
        unlike = np.flatnonzero(apart)
        # Leading zero bytes of the difference.
        bits = np.frexp((apart[unlike] >> np.uint64(1)).astype(np.float64) * 2 + 1)[1]
        same[unlike] = 8 - (np.minimum(bits, 64) + 7) // 8
        shared[rows] = np.minimum(at + same, np.minimum(n - order[rows - 1], n - order[rows]))
        rows = rows[apart == 0]
        if not len(rows):
            break
    return np.minimum(shared, depth)


# --- chunks ------------------------------------------------------------------


def _mixed(values: np.ndarray) -> np.ndarray:
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(29)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(32)
    return values


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first n powers, kept for the next chunk of about the size."""
    if len(_POWERS.get(base, ())) < n:
        powers = np.full(n + (n >> 3) + 1, base, np.uint64)
        powers[:1] = 1
        _POWERS[base] = np.multiply.accumulate(powers)
    return _POWERS[base][:n]


# One random number per byte value.
_BYTES = np.random.default_rng(50).integers(1, 1 << 64, 256, dtype=np.uint64)


def string_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of each window of ``length`` bytes."""
    n = len(data)
    if n < length:
        return np.empty(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    terms = _BYTES[data]
    terms *= _powers(_BASE, n)
    np.cumsum(terms, out=sums[1:])
    found = sums[length:] - sums[:-length]
    found *= _powers(_INVERSE, n - length + 1)
    return _mixed(found)


_PLACE_BITS = 28  # of a place in a chunk; the other bits of a packed number are of its hash


def anchor_places(hashes: np.ndarray, window: int) -> np.ndarray:
    """For each ``window`` successive hashes the place of the smallest, of ties the first.

    Only the upper bits of the hashes are compared, so that hash and place fit one number.
    """
    packed = hashes & np.uint64(2**64 - 2**_PLACE_BITS)
    packed |= np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while width * 2 <= window:
        packed = np.minimum(packed[:-width], packed[width:])
        width *= 2
    if rest := window - width:
        packed = np.minimum(packed[:-rest], packed[rest:])
    packed &= np.uint64(2**_PLACE_BITS - 1)
    return packed.astype(np.int64)


class Chunk:
    """Documents end to end, by ascending id."""

    def __init__(self, ids: np.ndarray, texts: list[bytes], length: int):
        self.length = length
        self.ids = ids
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        if len(self.data) >= 1 << _PLACE_BITS:
            raise ValueError("a chunk of documents is over 256 MB; lower chunk_bytes")
        sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(sizes)
        self.owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
        self._find_anchors()

    def _find_anchors(self) -> None:
        n = len(self.data) - self.length + 1
        if n <= 0:
            self.anchor = self.starts = self.places = np.empty(0, np.int64)
            self.anchor_values = np.empty(0, np.uint64)
            return
        hashes = string_hashes(self.data, ANCHOR)
        anchor = anchor_places(hashes, self.length - ANCHOR + 1)
        inside = self.owner[:n] == self.owner[self.length - 1 :]
        self.starts = np.flatnonzero(inside)  # places from which a whole string fits the document
        self.anchor = anchor[self.starts]
        used = np.zeros(len(hashes), bool)
        used[self.anchor] = True
        self.places = np.flatnonzero(used)
        self.anchor_values = hashes[self.places]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct anchor hashes, and whether two documents of the chunk have each."""
        order = np.argsort(self.anchor_values, kind="stable")
        values, owner = self.anchor_values[order], self.owner[self.places[order]]
        if not len(values):
            return values, np.empty(0, bool)
        first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
        several = np.minimum.reduceat(owner, first) != np.maximum.reduceat(owner, first)
        return values[first], several

    def candidates(self, repeated: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What is left by the sorted hashes of repeated anchors: the bytes of the strings that
        have such an anchor, where they start in these bytes, and where in the chunk."""
        keep = np.zeros(len(self.data) + 1, bool)
        if len(repeated):
            at = np.searchsorted(repeated, self.anchor_values)
            at[at == len(repeated)] = 0
            keep[self.places] = repeated[at] == self.anchor_values
        starts = self.starts[keep[self.anchor]]
        covered = _covered(starts, self.length, len(self.data))
        compact = np.cumsum(covered) - 1
        return self.data[covered], compact[starts], starts


def _covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n bytes the strings at distinct ``starts`` cover."""
    edges = np.zeros(n + 1, np.int32)
    edges[starts] += 1
    edges[starts + length] -= 1
    return np.cumsum(edges[:-1]) > 0


def _distinct_strings(
    data: np.ndarray, starts: np.ndarray, labels: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """Hash and smallest label of each distinct string that begins at ``starts``, by hash."""
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    order = suffix_array(data, length)
    run = np.cumsum(common_prefixes(data, order, length) < length)
    label = np.zeros(len(data), np.int64)
    label[starts] = labels
    begins = np.zeros(len(data), bool)
    begins[starts] = True
    mine = begins[order]  # the other suffixes run over the end of a piece
    order, run = order[mine], run[mine]
    first = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    least = np.minimum.reduceat(label[order], first)
    values = string_hashes(data, length)[order[first]]
    by = np.argsort(values, kind="stable")
    return values[by], least[by]


def _marked_starts(
    data: np.ndarray, starts: np.ndarray, labels: np.ndarray, length: int, flags_of
) -> np.ndarray:
    """Which ``starts`` begin a string that a smaller label has, here or in another chunk."""
    if not len(starts):
        return np.empty(0, bool)
    values = string_hashes(data, length)[starts]
    by = np.argsort(values, kind="stable")
    ordered, own = values[by], labels[by]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    counts = np.diff(np.r_[first, len(ordered)])
    hit = own > np.repeat(np.minimum.reduceat(own, first), counts)
    hit |= np.repeat(flags_of(ordered[first]), counts)
    marked = np.empty(len(starts), bool)
    marked[by] = hit
    return marked


# --- on Spark ----------------------------------------------------------------

_ANCHORS, _STRINGS, _COPY = 0, 1, 2
_LAST_ID = (1 << 63) - 1
RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _opened(table: pa.Table, length: int, notes: pa.Table) -> tuple[Chunk, np.ndarray]:
    """The chunk of a table without the noted later copies, and the row of each document in it."""
    ids = table["doc_id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    copies = notes["bucket"].to_numpy()[notes["kind"].to_numpy() == _COPY]
    order = order[~np.isin(ids[order], copies)]
    texts = table["text"].take(pa.array(order)).to_pylist()
    return Chunk(ids[order], texts, length), order


def _of_kind(notes: pa.Table, kind: int) -> pa.Table:
    return notes.filter(pa.array(notes["kind"].to_numpy() == kind))


def _left(table: pa.Table, notes: pa.Table, length: int, bits: int):
    """The chunk, the rows of its documents, and what is left of it."""
    own, order = _opened(table, length, notes)
    values, several = own.anchors()
    elsewhere = collisions.flags_of(_of_kind(notes, _ANCHORS), values, bits)
    return own, order, own.candidates(values[several | elsewhere])


def repeated_strings_removed(
    docs: DataFrame,
    length: int = LENGTH,
    chunk_bytes: int = CHUNK_BYTES,
    kept_text: bool = False,
) -> DataFrame:
    """Removes each byte covered by a string of ``length`` bytes that also starts in a document
    with a smaller id.

    Returns ``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` per row of ``docs``, and with
    ``kept_text`` the remaining bytes as ``kept``. Strings are judged on the input. A null text is
    an empty one, a document without an id comes after all others, and rows with one id are not
    before each other. Strings are the same if their 64-bit hashes are, between documents that
    share an anchor.
    """
    if length <= ANCHOR:
        raise ValueError(f"length must be over {ANCHOR}")
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST_ID)).alias("doc_id"),
        F.coalesce("text", F.lit("")).cast("binary").alias("text"),
    )
    size = F.octet_length("text").cast("long").alias("n")
    sums = Stored(rows.select("doc_id", F.sha2("text", 256).alias("digest"), size), "digests").table
    total = sums.agg(F.sum("n")).first()[0] or 0
    n_chunks = max(1, -(-total // chunk_bytes))
    chunk = F.pmod(F.xxhash64("doc_id"), F.lit(n_chunks)).alias("chunk")
    firsts = sums.groupBy("digest").agg(F.min("doc_id").alias("first_id"))
    # A later copy of a whole text is removed whole. It takes no further part, or it would make
    # every anchor of the first one a repeated one.
    copies = sums.join(firsts, "digest").where("doc_id > first_id").select(
        chunk,
        F.lit(_COPY).alias("kind"),
        F.col("doc_id").alias("bucket"),
        F.lit(None).cast("binary").alias("packed"),
    )
    chunks = rows.withColumn("chunk", chunk).groupBy("chunk")
    n_anchors = 2 * total // (length - ANCHOR + 2)
    anchor_bits = collisions.bucket_bits(n_anchors, BUCKET_VALUES)
    block = max(1.0, n_anchors / n_chunks / (1 << anchor_bits))
    anchor_drop = max(0, 64 - anchor_bits - int(np.ceil(np.log2(block))) - SPARE_BITS)
    string_bits = collisions.bucket_bits(total // 4, BUCKET_VALUES)

    def blocks(table: pa.Table, values, bits: int, labels=None, drop: int = 0) -> pa.Table:
        which = table["chunk"][0].as_py()
        found = list(collisions.split_buckets(which, values, bits, drop, labels))
        return pa.Table.from_pylist(found, collisions.PACKED_SCHEMA)

    def send_anchors(table: pa.Table, notes: pa.Table) -> pa.Table:
        if not table.num_rows:
            return collisions.PACKED_SCHEMA.empty_table()
        values, _ = _opened(table, length, notes)[0].anchors()
        return blocks(table, values, anchor_bits, drop=anchor_drop)

    def send_strings(table: pa.Table, notes: pa.Table) -> pa.Table:
        if not table.num_rows:
            return collisions.PACKED_SCHEMA.empty_table()
        own, _, (data, starts, places) = _left(table, notes, length, anchor_bits)
        labels = own.ids[own.owner[places]]
        del own, places
        values, labels = _distinct_strings(data, starts, labels, length)
        return blocks(table, values, string_bits, labels)

    def remove(table: pa.Table, notes: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _schema(kept_text).empty_table()
        own, order, (data, starts, places) = _left(table, notes, length, anchor_bits)
        strings = _of_kind(notes, _STRINGS)
        marked = _marked_starts(
            data,
            starts,
            own.ids[own.owner[places]],
            length,
            lambda values: collisions.flags_of(strings, values, string_bits),
        )
        return _result(table, own, order, places[marked], length, kept_text)

    def answers(found: DataFrame, kind: int) -> DataFrame:
        return collisions.answered(found).select(
            "chunk", F.lit(kind).alias("kind"), "bucket", "packed"
        )

    anchors = chunks.cogroup(copies.groupBy("chunk")).applyInArrow(send_anchors, collisions.PACKED)
    notes = copies.unionByName(answers(anchors, _ANCHORS))
    strings = chunks.cogroup(notes.groupBy("chunk")).applyInArrow(send_strings, collisions.PACKED)
    notes = notes.unionByName(answers(strings, _STRINGS))
    columns = RESULT + ", kept binary" if kept_text else RESULT
    found = chunks.cogroup(notes.groupBy("chunk")).applyInArrow(remove, columns)
    return found.withColumn("doc_id", F.nullif("doc_id", F.lit(_LAST_ID)))


def _schema(kept_text: bool) -> pa.Schema:
    fields = [(n, pa.int64()) for n in ("doc_id", "n_bytes", "n_removed", "n_spans")]
    fields.append(("kept_sha256", pa.string()))
    return pa.schema(fields + [("kept", pa.binary())] * kept_text)


def _result(
    table: pa.Table, own: Chunk, order: np.ndarray, marked: np.ndarray, length: int, kept_text: bool
) -> pa.Table:
    gone = _covered(marked, length, len(own.data))
    place = {row: i for i, row in enumerate(order.tolist())}
    sizes, removed, spans, digests, kept = [], [], [], [], []
    for row, text in enumerate(table["text"].to_pylist()):
        if row in place:
            end = int(own.ends[place[row]])
            lost = gone[end - len(text) : end]
            rest = np.frombuffer(text, np.uint8)[~lost].tobytes() if lost.any() else text
            # A run begins where a byte goes and the one before it, if any, stays.
            runs = int(lost[:1].sum() + np.count_nonzero(lost[1:] & ~lost[:-1]))
        else:  # a later copy
            rest, runs = (b"", 1) if len(text) >= length else (text, 0)
        sizes.append(len(text))
        removed.append(len(text) - len(rest))
        spans.append(runs)
        digests.append(hashlib.sha256(rest).hexdigest())
        kept.append(rest)
    columns = [table["doc_id"].to_numpy(), sizes, removed, spans, digests] + [kept] * kept_text
    schema = _schema(kept_text)
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
