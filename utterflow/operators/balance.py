"""Balance filters: at most ``cap`` rows per speaker, chosen by a hash of the record id.

The rows a group keeps are its ``cap`` first by ``(sha1(record_id), record_id, dataset_key,
source_split)``, as ``row_number() OVER (PARTITION BY speaker ORDER BY ...) <= cap`` would keep.
Only lean keys move: each task's share of a group is cut to its first ``cap`` (by a salt of the
record id, so that a speaker with a third of all rows is spread over ``SALTS`` tasks), the pieces
are merged to a threshold per group, and the wide rows are filtered where they are, against the
broadcast thresholds when their size is known to be small, else by a join that adaptive execution
may split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from utterflow.plans.storage import BROADCAST_BYTES, durable, fits_broadcast

# Pieces of one group before the merge: a group's candidates are at most SALTS x cap.
SALTS = 64
ORDER = ("_h", "record_id", "dataset_key", "source_split")


def _keyed(rows: DataFrame, group: str) -> DataFrame:
    # The group as a key that is never null: null is a group of its own.
    label = F.coalesce(F.concat(F.lit("v"), F.col(group).cast("string")), F.lit("n"))
    return rows.withColumns({"_h": F.sha1(F.col("record_id").cast("string")), "_g": label})


def _order() -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in ORDER]


def capped_per_group(rows: DataFrame, cap: int, group: str = "speaker_id") -> DataFrame:
    """The rows of ``rows`` with at most ``cap`` per value of ``group`` (null is one group).

    Groups keep their first ``cap`` rows by the order above; rows equal in all its columns are
    told apart by the rest of the row, so exactly ``cap`` stay of a larger group. ``cap`` below 0
    is an error; 0 keeps nothing. Columns and their order are kept.
    """
    if cap < 0:
        raise ValueError("cap must be at least 0")
    if cap == 0:
        return rows.limit(0)
    keyed = _keyed(rows, group)
    lean = keyed.select("_g", *ORDER).withColumn(
        "_salt", F.pmod(F.xxhash64("record_id", "dataset_key", "source_split"), F.lit(SALTS))
    )
    piece = Window.partitionBy("_g", "_salt").orderBy(*_order())
    partial = lean.withColumn("_r", F.row_number().over(piece)).where(F.col("_r") <= cap)
    whole = Window.partitionBy("_g").orderBy(*_order())
    merged = durable(
        partial.withColumn("_r", F.row_number().over(whole))
        .where(F.col("_r") <= cap)
        .select("_g", F.struct(*ORDER).alias("_k"))
    )
    last = merged.groupBy("_g").agg(F.max("_k").alias("_last"))
    # The last key may be shared by equal rows: this many of them stay.
    limits = durable(
        merged.join(last, "_g")
        .where(F.col("_k") == F.col("_last"))
        .groupBy("_g", "_last")
        .agg(F.count(F.lit(1)).alias("_n_last"))
    )
    return _cut(rows, keyed, limits)


# Hex digits of the hash that one round of counting adds; a group's rows below the chosen prefix
# are counted, not moved. Past FINISH_ROWS in the boundary prefix, one more round is taken.
DIGITS = 4
FINISH_ROWS = 1_000_000


def _thresholds(keyed: DataFrame, needs: DataFrame, few: bool) -> DataFrame:
    """``(_g, _last, _n_last)``: the ``_need``-th key of each group in ``needs`` (need >= 1).

    Counting refinement: every round counts the rows of each open group by the next digits of the
    hash below the prefix found so far, and keeps the prefix where the rank falls. A group whose
    rows under its prefix are few, or that has no digits left, is closed; the rows under the
    closed prefixes are ranked. Only counts and one row per group move. ``few``: the table of
    groups is small enough to broadcast.
    """
    side = F.broadcast if few else (lambda table: table)
    lean = keyed.select("_g", *ORDER)
    open_ = needs.select("_g", F.lit("").alias("_p"), F.col("_need").cast("long").alias("_need"))
    closed = []
    for digits in range(DIGITS, 41, DIGITS):
        under = lean.join(side(open_), "_g").where(
            (F.col("_p") == "") | F.coalesce(F.col("_h").startswith(F.col("_p")), F.lit(False))
        )
        counts = under.groupBy("_g", F.substring("_h", 1, digits).alias("_b"), "_need").agg(
            F.count(F.lit(1)).alias("_n")
        )
        ordered = Window.partitionBy("_g").orderBy(F.col("_b").asc_nulls_first())
        ranked = counts.withColumn("_upto", F.sum("_n").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        found = durable(
            ranked.where((F.col("_upto") >= F.col("_need")) & (F.col("_upto") - F.col("_n") < F.col("_need")))
            .select("_g", F.col("_b").alias("_p"), (F.col("_need") - F.col("_upto") + F.col("_n")).alias("_need"), "_n")
        )
        # A null hash (no record id) has no further digits.
        done = F.col("_p").isNull() | (F.col("_n") <= FINISH_ROWS) | F.lit(digits >= 40)
        closed.append(found.where(done).drop("_n"))
        open_ = found.where(~done).drop("_n")
        if open_.isEmpty():
            break
    state = closed[0]
    for more in closed[1:]:
        state = state.unionByName(more)
    bucket = lean.join(side(state), "_g").where(
        F.coalesce(F.col("_h").startswith(F.col("_p")), F.lit(False))
        | (F.col("_p").isNull() & F.col("_h").isNull())
    )
    ranked = bucket.withColumn(
        "_r", F.row_number().over(Window.partitionBy("_g").orderBy(*_order()))
    ).withColumn("_k", F.struct(*ORDER))
    last = ranked.where(F.col("_r") == F.col("_need")).select("_g", F.col("_k").alias("_last"))
    # Rows of the prefix up to the chosen one that share its key: this many stay.
    return durable(
        ranked.where(F.col("_r") <= F.col("_need"))
        .join(last, "_g")
        .where(F.col("_k") == F.col("_last"))
        .groupBy("_g", "_last")
        .agg(F.count(F.lit(1)).alias("_n_last"))
    )


def balanced_groups(rows: DataFrame, group: str = "gender") -> DataFrame:
    """Every value of ``group`` (null is one) cut to the size of the smallest, by the order above.

    Exactly that many rows stay of each group, chosen as ``capped_per_group`` would choose them;
    counts are exact. An empty table gives none. Columns and their order are kept.
    """
    keyed = _keyed(rows, group)
    counts = durable(keyed.groupBy("_g").agg(F.count(F.lit(1)).alias("_count")))
    smallest = counts.agg(F.min("_count")).first()[0]
    if not smallest:
        return rows.limit(0)
    needs = counts.select("_g", F.lit(smallest).alias("_need"))
    few = fits_broadcast(counts, BROADCAST_BYTES, "_g")
    limits = _thresholds(keyed, needs, few)
    return _cut(rows, keyed, limits)


def _cut(rows: DataFrame, keyed: DataFrame, limits: DataFrame) -> DataFrame:
    """Rows before their group's last key, and as many as counted of those equal to it."""
    flat = limits.select("_g", *(F.col(f"_last.{c}").alias(c) for c in ORDER))
    small = fits_broadcast(flat, BROADCAST_BYTES, "_g", *ORDER)
    joined = keyed.join(F.broadcast(limits) if small else limits, "_g")
    key = F.struct(*ORDER)
    names = rows.columns
    before = joined.where(key < F.col("_last")).select(*names)
    tied = joined.where(key == F.col("_last"))
    orderable = [c for c, kind in rows.dtypes if not kind.startswith("map")]
    among_equal = Window.partitionBy("_g", *ORDER).orderBy(*(F.col(c).asc_nulls_first() for c in orderable))
    chosen = tied.withColumn("_t", F.row_number().over(among_equal)).where(F.col("_t") <= F.col("_n_last"))
    return before.unionByName(chosen.select(*names))
