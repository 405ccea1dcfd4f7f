"""Shards of near equal bytes by Karmarkar-Karp differencing, groups of equal texts kept whole.

Each group is one item. Items are dealt by hash into parts of at most ``GROUP_ROWS`` items; every
part runs the multi-way differencing method on its own items and ends in ``shards`` subsets. The
parts' subsets are then items of a second round of the same method, on the driver, which needs
``parts x shards`` numbers only. Each step takes the two partial partitions of largest spread
(largest minus smallest subset) and joins the largest subset of one with the smallest of the other.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from utterflow.llm.tables import Stored

SHARDS = 40
# Bytes a row takes besides its text.
ROW_BYTES = 16
# Items one task partitions at once: a bound on a task's memory, not on the result.
GROUP_ROWS = 200_000


def differencing(items: list[tuple[int, object]], k: int) -> list[tuple[int, list[object]]]:
    """``k`` subsets ``(total, labels)`` of ``(size, label)`` items by Karmarkar-Karp differencing.

    Every partial partition is a list of ``k`` subsets in descending order of size. The two of
    largest spread are joined, subset ``i`` of one with subset ``k - 1 - i`` of the other, until one
    is left. Ties go by the order of ``items``; an empty list gives ``k`` empty subsets.
    """
    heap = []
    for order, (size, label) in enumerate(items):
        parts = [(size, [label])] + [(0, []) for _ in range(k - 1)]
        heap.append((-size, order, parts))
    heapq.heapify(heap)
    count = len(heap)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        joined = []
        for i in range(k):
            left, right = a[i], b[k - 1 - i]
            if len(left[1]) < len(right[1]):
                left, right = right, left
            left[1].extend(right[1])
            joined.append((left[0] + right[0], left[1]))
        joined.sort(key=lambda s: -s[0])
        heapq.heappush(heap, (joined[-1][0] - joined[0][0], count, joined))
        count += 1
    return heap[0][2] if heap else [(0, []) for _ in range(k)]


def _local(frame_of_part: pd.DataFrame, k: int) -> pd.DataFrame:
    ordered = frame_of_part.sort_values(["size", "gkey"], ascending=[False, True])
    subsets = differencing(list(zip(ordered["size"].tolist(), ordered["gkey"].tolist())), k)
    rows = [(key, local) for local, (_, keys) in enumerate(subsets) for key in keys]
    out = pd.DataFrame(rows, columns=["gkey", "local"])
    out["part"] = int(frame_of_part["part"].iloc[0])
    return out


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Every row of ``docs`` in one of ``shards`` shards of near equal bytes.

    Columns: ``doc_id``, ``size`` (UTF-8 bytes of the text plus ``ROW_BYTES``; a null text has no
    bytes), ``text_crc32`` (unsigned CRC-32 of the UTF-8 text; 0 for null), ``law`` ('bytes'),
    ``shard`` (int), ``slot`` (place in the shard from 0, gapless, by doc_id with nulls first, then
    the CRC) and ``grown_shard`` (null: this law has no rule for one more shard).

    Rows of equal text (null texts form one group of their own) share a shard. Repeated rows and
    rows without an id are placed like any other; an empty table gives no rows. Columns other than
    ``doc_id`` and ``text`` are ignored. Reruns give the same shards.
    """
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")).alias("text_crc32"),
        F.coalesce(F.sha2(F.col("text").cast("string"), 256), F.lit("null")).alias("gkey"),
    )
    keyed = Stored(rows, "sized").table
    groups = keyed.groupBy("gkey").agg(F.sum("size").alias("size"))
    stored_groups = Stored(groups, "groups").table
    n_groups = stored_groups.count()
    n_parts = max(1, -(-n_groups // GROUP_ROWS))
    parted = stored_groups.withColumn("part", F.pmod(F.xxhash64("gkey"), F.lit(n_parts)))
    local = parted.repartition(n_parts, "part").groupBy("part").applyInPandas(
        lambda frame: _local(frame, shards), "gkey string, local int, part long"
    )
    placed = Stored(local, "placed").table
    totals = (
        placed.join(stored_groups, "gkey")
        .groupBy("part", "local")
        .agg(F.sum("size").alias("size"))
        .collect()
    )
    # parts x shards numbers: the subsets of all parts, partitioned once more.
    subsets = differencing(
        sorted(((r["size"], (r["part"], r["local"])) for r in totals), key=lambda t: (-t[0], t[1])),
        shards,
    )
    spark = docs.sparkSession
    mapping = spark.createDataFrame(
        [(part, local, shard) for shard, (_, labels) in enumerate(subsets) for part, local in labels],
        "part long, local int, shard int",
    )
    assigned = keyed.join(placed, "gkey").join(F.broadcast(mapping), ["part", "local"]).select(
        "doc_id", "size", "text_crc32", "shard"
    )
    return _slots(assigned).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _slots(assigned: DataFrame) -> DataFrame:
    """Gapless places within each shard, by a global sort: no shard meets in one task."""
    ordered = Stored(
        assigned.orderBy("shard", F.col("doc_id").asc_nulls_first(), "text_crc32", "size").withColumn(
            "seq", F.monotonically_increasing_id()
        ),
        "ordered",
    ).table
    ordered = ordered.withColumn("part", (F.col("seq") / F.lit(2**33)).cast("long"))
    runs = ordered.groupBy("part", "shard").agg(
        F.min("seq").alias("first"), F.count(F.lit(1)).alias("n")
    )
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        "part", "shard", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    return ordered.join(F.broadcast(offsets), ["part", "shard"]).select(
        "doc_id", "size", "text_crc32", "shard",
        (F.col("seq") - F.col("first") + F.col("offset")).alias("slot"),
    )
