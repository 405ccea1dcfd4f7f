"""Shared prefixes of conversations as a trie, with subtree figures by an Euler tour.

Every conversation is a path from the root; a node is a distinct sequence of first turns. Nodes
are found by grouping the conversations' running prefix keys, which is one pass and one
aggregation. Subtree figures (leaves, tokens saved) come from an Euler tour: each node has an
enter and an exit arc, the arcs form one list, pointer jumping ranks it and carries the weights
along, and a subtree's figure is the difference of the sums at its two arcs. No step groups the
children of a node or the turns of a prefix in one task: siblings are chained through a global
sort, and the jumps join arcs one to one.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from utterflow.llm.tables import Stored, words

# Conversation c takes its first h turns from conversation c - c % GROUP, h = crc32(c) % SHARED.
GROUP = 20
SHARED = 4
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()

_TERM = "decimal(20,0)"


def _term(value: Column) -> Column:
    # Exact sums: a decimal holds the sum of 2^31 hashes of 64 bits.
    return value.cast(_TERM)


def rebuilt_turns(conversations: DataFrame) -> DataFrame:
    """``(conv_id, pos, role, text)``: the rebuilt turns of every conversation, ``pos`` from 0.

    Turns are ordered by ``turn`` (null first), ties by role and text; null role or text is empty.
    Rows with a null ``conv_id`` belong to no conversation and are left out. Conversation ``c``
    is the first ``h`` turns of ``c - c % GROUP`` (``%`` truncates as in SQL; fewer if it has
    fewer, none if absent), then its own turns after its first ``h``.
    """
    own = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    ranked = Stored(own.withColumn("pos", F.row_number().over(order) - 1).drop("turn"), "turns").table
    ids = ranked.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_own")).select(
        "conv_id",
        (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"),
        (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % SHARED).alias("h"),
    )
    lead = ranked.where(F.col("pos") < SHARED).select(
        F.col("conv_id").alias("base"), "pos", "role", "text"
    )
    base_n = lead.groupBy("base").agg(F.count(F.lit(1)).alias("base_n"))
    keep = ids.join(base_n, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("base_n", F.lit(0))).alias("k")
    )
    prefix = keep.join(lead, "base").where(F.col("pos") < F.col("h")).select(
        "conv_id", "pos", "role", "text"
    )
    tail = ranked.join(keep.select("conv_id", "h", "k"), "conv_id").where(F.col("pos") >= F.col("h"))
    rest = tail.select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "role", "text")
    return prefix.withColumn("pos", F.col("pos").cast("long")).unionByName(rest)


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the prefix trie of the rebuilt conversations (see ``rebuilt_turns``).

    Columns (long unless named): ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``
    (null for the root), ``n_convs``, ``n_children``, ``n_leaves`` (childless nodes in the subtree,
    itself included), ``saved_tokens`` (over the subtree, each node's ``n_convs - 1`` times the
    words of its last text), ``ends_sha256`` (string; SHA-256 of the comma-joined ids of the members
    that end here, ascending; of the empty string if none), ``tour_enter`` and ``tour_exit`` (the
    places of the node's two arcs in the Euler tour, from 0).

    Every conversation is a member of the root, even one without turns. Repeated rows are turns of
    their own; texts of any length count whole. An empty table, or one with only null ids, gives
    no nodes. Nodes are told apart by two 64-bit hash sums of their turns (a mix-up of two
    prefixes has a chance of about 2^-128). Columns other than the four are ignored.
    """
    turns = rebuilt_turns(conversations)
    prefix = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    t1 = _term(F.xxhash64("pos", "role", "text"))
    t2 = _term(F.xxhash64(F.lit("second"), "text", "role", "pos"))
    keyed = turns.select(
        "conv_id",
        (F.col("pos") + 1).alias("depth"),
        t1.alias("t1"),
        t2.alias("t2"),
        F.size(words(F.col("text"))).cast("long").alias("words"),
    ).select(
        "conv_id",
        "depth",
        F.sum("t1").over(prefix).alias("k1"),
        F.sum("t2").over(prefix).alias("k2"),
        "words",
        "t1",
        "t2",
    )
    paths = Stored(
        keyed.select(
            "conv_id", "depth", "k1", "k2", "words",
            (F.col("k1") - F.col("t1")).alias("p1"), (F.col("k2") - F.col("t2")).alias("p2"),
        ),
        "paths",
    )
    zero = F.lit(0).cast("decimal(30,0)")
    members = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id")
    ).distinct()
    root_rows = members.select(
        "conv_id", F.lit(0).cast("int").alias("depth"), zero.alias("k1"), zero.alias("k2"),
        F.lit(0).cast("long").alias("words"),
        F.lit(None).cast("decimal(30,0)").alias("p1"), F.lit(None).cast("decimal(30,0)").alias("p2"),
    )
    rows = paths.table.unionByName(root_rows)
    grouped = rows.groupBy("depth", "k1", "k2").agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("p1").alias("p1"),
        F.max("p2").alias("p2"),
        F.max("words").alias("words"),
    )
    keyed_nodes = Stored(grouped, "nodes").table
    parents = keyed_nodes.select(
        (F.col("depth") + 1).alias("depth"),
        F.col("k1").alias("p1"),
        F.col("k2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    linked = keyed_nodes.join(parents, ["depth", "p1", "p2"], "left")
    nodes = Stored(
        linked.select("conv_id", "depth", "parent_conv_id", "n_convs", "words", "k1", "k2"), "linked"
    )
    tree = _tour(nodes.table)
    ends = _ends(paths.table, nodes.table, members)
    result = tree.join(ends, ["conv_id", "depth"], "left").select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
        "tour_enter",
        "tour_exit",
    )
    return result


def _ends(paths: DataFrame, nodes: DataFrame, members: DataFrame) -> DataFrame:
    """``(conv_id, depth, ends_sha256)`` for nodes where some member ends.

    The ids of one node are hashed in one task, in order, a batch at a time: SHA-256 of a joined
    list cannot be cut, but no node's list is held in memory.
    """
    last = paths.groupBy(F.col("conv_id").alias("member")).agg(
        F.max(F.struct("depth", "k1", "k2")).alias("end")
    )
    at = members.select(F.col("conv_id").alias("member")).join(last, "member", "left").select(
        "member",
        F.coalesce(F.col("end.depth"), F.lit(0)).alias("depth"),
        F.coalesce(F.col("end.k1"), F.lit(0).cast("decimal(30,0)")).alias("k1"),
        F.coalesce(F.col("end.k2"), F.lit(0).cast("decimal(30,0)")).alias("k2"),
    )
    placed = at.join(nodes.select("depth", "k1", "k2", "conv_id"), ["depth", "k1", "k2"]).select(
        "conv_id", "depth", "member"
    )
    ordered = placed.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "member")

    def digest(batches):
        current, hasher, first = None, None, True
        for batch in batches:
            ids = batch.column("conv_id").to_pylist()
            depths = batch.column("depth").to_pylist()
            ends = batch.column("member").to_pylist()
            out_ids, out_depths, out_sha = [], [], []
            for key in zip(ids, depths, ends):
                node = key[:2]
                if node != current:
                    if current is not None:
                        out_ids.append(current[0])
                        out_depths.append(current[1])
                        out_sha.append(hasher.hexdigest())
                    current, hasher, first = node, hashlib.sha256(), True
                hasher.update((b"" if first else b",") + str(key[2]).encode())
                first = False
            if out_ids:
                yield pa.RecordBatch.from_pydict(
                    {"conv_id": out_ids, "depth": out_depths, "ends_sha256": out_sha},
                    schema=_ENDS,
                )
        if current is not None:
            yield pa.RecordBatch.from_pydict(
                {"conv_id": [current[0]], "depth": [current[1]], "ends_sha256": [hasher.hexdigest()]},
                schema=_ENDS,
            )

    return ordered.mapInArrow(digest, "conv_id long, depth int, ends_sha256 string")


_ENDS = pa.schema([("conv_id", pa.int64()), ("depth", pa.int32()), ("ends_sha256", pa.string())])


def _tour(nodes: DataFrame) -> DataFrame:
    """Subtree figures of ``(conv_id, depth, parent_conv_id, n_convs, words)`` by an Euler tour."""
    siblings = (
        nodes.where(F.col("parent_conv_id").isNotNull())
        .select("parent_conv_id", "depth", "conv_id")
        .orderBy("parent_conv_id", "depth", "conv_id")
        .withColumn("seq", F.monotonically_increasing_id())
    )
    ordered = Stored(siblings, "siblings").table
    # Sequence numbers are consecutive within a task; the next task's first follows the last.
    parts = ordered.groupBy((F.col("seq") / F.lit(2**33)).cast("long").alias("part")).agg(
        F.min("seq").alias("first"), F.max("seq").alias("last")
    )
    following = parts.select(
        "part", "last", F.lead("first").over(Window.orderBy("part")).alias("next_first")
    )
    part_of = (F.col("seq") / F.lit(2**33)).cast("long")
    chained = ordered.join(F.broadcast(following), part_of == F.col("part")).select(
        "parent_conv_id", "depth", "conv_id", "seq",
        F.when(F.col("seq") < F.col("last"), F.col("seq") + 1).otherwise(F.col("next_first")).alias("after"),
    )
    after = ordered.select(
        F.col("seq").alias("after"),
        F.col("parent_conv_id").alias("after_parent"),
        F.col("depth").alias("after_depth"),
    )
    with_next = chained.join(after, "after", "left").select(
        "parent_conv_id", "depth", "conv_id", "seq",
        F.when(
            (F.col("after_parent") == F.col("parent_conv_id")) & (F.col("after_depth") == F.col("depth")),
            F.col("after"),
        ).alias("next_seq"),
    )
    first_child = ordered.groupBy("parent_conv_id", "depth").agg(
        F.min("seq").alias("child_seq"), F.count(F.lit(1)).alias("n_children")
    ).select(
        F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"), "child_seq", "n_children"
    )
    parent_seq = with_next.select(
        F.col("conv_id").alias("parent_conv_id"), (F.col("depth") + 1).alias("depth"),
        F.col("seq").alias("parent_seq"),
    )
    placed = (
        nodes.join(with_next.select("conv_id", "depth", "seq", "next_seq"), ["conv_id", "depth"], "left")
        .join(first_child, ["conv_id", "depth"], "left")
        .join(parent_seq, ["parent_conv_id", "depth"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs",
            F.coalesce("n_children", F.lit(0)).alias("n_children"),
            ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
            # The root has no place among siblings: -1, so its arcs are -2 and -1.
            F.coalesce("seq", F.lit(-1)).alias("seq"),
            "next_seq", "child_seq",
            F.when(F.col("parent_conv_id").isNotNull(), F.coalesce("parent_seq", F.lit(-1))).alias("parent_seq"),
        )
    )
    info = Stored(placed, "placed").table
    enter = info.select(
        (F.col("seq") * 2).alias("arc"),
        F.when(F.col("child_seq").isNotNull(), F.col("child_seq") * 2)
        .otherwise(F.col("seq") * 2 + 1).alias("next"),
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("s_leaf"),
        F.col("saved").cast("long").alias("s_saved"),
        F.lit(1).cast("long").alias("s_len"),
    )
    leave = info.select(
        (F.col("seq") * 2 + 1).alias("arc"),
        F.when(F.col("next_seq").isNotNull(), F.col("next_seq") * 2)
        .otherwise(F.col("parent_seq") * 2 + 1).alias("next"),
        F.lit(0).cast("long").alias("s_leaf"),
        F.lit(0).cast("long").alias("s_saved"),
        F.lit(1).cast("long").alias("s_len"),
    )
    ranked = _rank(enter.unionByName(leave))
    total = ranked.agg(F.max("s_len").alias("n_arcs"))
    by_node = ranked.groupBy(F.shiftright("arc", 1).alias("seq")).agg(
        F.sum(F.when(F.col("arc").bitwiseAND(1) == 0, F.col("s_leaf")).otherwise(-F.col("s_leaf"))).alias("n_leaves"),
        F.sum(F.when(F.col("arc").bitwiseAND(1) == 0, F.col("s_saved")).otherwise(-F.col("s_saved"))).alias("saved_tokens"),
        F.max(F.when(F.col("arc").bitwiseAND(1) == 0, F.col("s_len"))).alias("enter_left"),
        F.max(F.when(F.col("arc").bitwiseAND(1) == 1, F.col("s_len"))).alias("exit_left"),
    )
    return info.join(by_node, "seq").crossJoin(F.broadcast(total)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs",
        F.col("n_children").cast("long").alias("n_children"),
        "n_leaves", "saved_tokens",
        (F.col("n_arcs") - F.col("enter_left")).alias("tour_enter"),
        (F.col("n_arcs") - F.col("exit_left")).alias("tour_exit"),
    )


def _rank(arcs: DataFrame) -> DataFrame:
    """Pointer jumping over ``(arc, next, s_...)``: each ``s_`` becomes the sum from the arc to the end.

    Each round joins every unfinished arc with the arc it points to, one to one, and doubles the
    reach; after about log2(arcs) rounds no pointer is left. Each round is written to the shared
    folder.
    """
    current = Stored(arcs, "arcs")
    sums = ("s_leaf", "s_saved", "s_len")
    while not current.table.where(F.col("next").isNotNull()).isEmpty():
        table = current.table
        ahead = table.select(
            F.col("arc").alias("next"),
            F.col("next").alias("next_after"),
            *(F.col(s).alias(f"{s}_after") for s in sums),
        )
        jumped = table.join(ahead, "next", "left").select(
            "arc",
            F.col("next_after").alias("next"),
            *(F.col(s) + F.coalesce(F.col(f"{s}_after"), F.lit(0)) for s in sums),
        )
        following = Stored(jumped.toDF("arc", "next", *sums), "arcs")
        current.drop()
        current = following
    return current.table
