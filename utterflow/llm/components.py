"""Connected components of an edge table by contraction.

Each round gives every vertex the smallest vertex among itself and its neighbours, follows that
pointer once more, and contracts the edges to the pointers. Edges within one group vanish; the rest
shrinks until none is left. Every step is an aggregation or a join on one vertex, so a hub with
many edges is pre-aggregated, and its join can be split by adaptive execution. Each round is
written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utterflow.llm.tables import Stored


def components(edges: DataFrame) -> DataFrame:
    """``(vertex, root)`` for every vertex that an edge (``u``, ``v``; any order) joins to another.

    ``root`` is one vertex of the component, the same for all its vertices. Loops, repeated edges
    and an empty table are allowed; a vertex that has only loops is not in the result.
    """
    ordered = edges.where("u <> v").select(
        F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")
    )
    links = Stored(ordered.distinct(), "links")
    roots: Stored | None = None
    while not links.table.isEmpty():
        proper = links.table
        both = proper.unionByName(proper.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("vertex")).agg(F.least("vertex", F.min("v")).alias("p"))
        pointers = Stored(least, "pointers")
        once = pointers.table
        up = once.select(F.col("vertex").alias("p"), F.col("p").alias("pp"))
        jumped = Stored(once.join(up, "p").select("vertex", F.col("pp").alias("p")), "jumps")
        to = jumped.table
        contracted = (
            proper.join(to.select(F.col("vertex").alias("u"), F.col("p").alias("pu")), "u")
            .join(to.select(F.col("vertex").alias("v"), F.col("p").alias("pv")), "v")
            .where("pu <> pv")
            .select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v"))
            .distinct()
        )
        following = Stored(contracted, "links")
        if roots is None:
            mapped = to.select("vertex", F.col("p").alias("root"))
        else:
            moved = to.select(F.col("vertex").alias("root"), "p")
            mapped = roots.table.join(moved, "root", "left").select(
                "vertex", F.coalesce("p", "root").alias("root")
            )
        renamed = Stored(mapped, "roots")
        for old in (links, roots, pointers, jumped):
            if old is not None:
                old.drop()
        links, roots = following, renamed
    if roots is None:
        return links.table.select(F.col("u").alias("vertex"), F.col("v").alias("root"))
    return roots.table
