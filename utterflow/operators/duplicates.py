"""Duplicate transcripts: of rows whose normalised text is equal, the first by record id stays.

The normalised text is the lower-cased blank-separated tokens joined by one blank. Only lean
``(digest, record key)`` pairs are aggregated, with partial aggregation, so a text repeated
millions of times adds one row per task. The first keys then select the wide rows: against a
broadcast table when its size is known to be small, else by a join on the record key, which is
unique on that side and spreads evenly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from utterflow.functions.text import lower_tokens
from utterflow.plans.storage import BROADCAST_BYTES, durable, fits_broadcast

KEY = ("record_id", "dataset_key", "source_split")


def text_digest(text: Column) -> Column:
    """SHA-256 of the normalised text; null when the text has no token (also null text)."""
    words = lower_tokens(text)
    return F.when(F.size(words) > 0, F.sha2(F.array_join(words, " "), 256))


def first_transcripts(rows: DataFrame, text: str = "text") -> DataFrame:
    """Rows without a duplicate before them: per digest the first by ``record_id``,
    ``dataset_key``, ``source_split`` (nulls first); one of rows equal in all three.

    Rows whose text has no token are not transcripts and all stay. Columns and their order are
    kept; an empty table gives none.
    """
    names = rows.columns
    keyed = rows.withColumn("_d", text_digest(F.col(text)))
    lean = keyed.where(F.col("_d").isNotNull()).groupBy("_d", *KEY).agg(F.count(F.lit(1)).alias("_n"))
    firsts = durable(
        lean.groupBy("_d")
        .agg(F.min(F.struct(*KEY, "_n")).alias("_first"))
        .select("_d", *(F.col(f"_first.{c}").alias(f"_f_{c}") for c in (*KEY, "_n")))
    )
    small = fits_broadcast(firsts, BROADCAST_BYTES, "_d", *(f"_f_{c}" for c in KEY))
    side = F.broadcast(firsts) if small else firsts
    match = keyed["_d"] == side["_d"]
    for c in KEY:
        match = match & keyed[c].eqNullSafe(side[f"_f_{c}"])
    chosen = keyed.join(side, match).select(*names, keyed["_d"], "_f__n")
    alone = chosen.where(F.col("_f__n") == 1).select(*names)
    # Rows equal in the whole key: one stays. Only such rows meet in one task.
    orderable = [c for c, kind in rows.dtypes if not kind.startswith("map")]
    among = Window.partitionBy("_d", *KEY).orderBy(*(F.col(c).asc_nulls_first() for c in orderable))
    equal = chosen.where(F.col("_f__n") > 1).withColumn("_t", F.row_number().over(among))
    untouched = keyed.where(F.col("_d").isNull()).select(*names)
    return alone.unionByName(equal.where(F.col("_t") == 1).select(*names)).unionByName(untouched)
