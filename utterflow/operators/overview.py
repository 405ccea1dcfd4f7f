"""Metadata overviews of the training view; missing durations are null or NaN here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from utterflow.plans.storage import durable

UNKNOWN_GENDER = "UNKNOWN"  # fixed value
# Of the median: cells that a range is cut into, and rows that are few enough to sort.
PARTS, FEW = 4096, 100_000


def _number(value: Column) -> Column:
    """Coerced to a number: what does not parse, and NaN, becomes null."""
    return F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))


def metadata_overview(rows: DataFrame, approximate_speakers: bool = False) -> DataFrame:
    """One row of counts. ``duration_mean_seconds`` is NaN when there is no duration."""
    d = _number(F.col("duration_seconds"))
    speakers = F.approx_count_distinct if approximate_speakers else F.count_distinct
    return rows.agg(
        F.count("*").alias("rows"),
        F.count_if(F.coalesce(F.col("text"), F.lit("")) == "").alias("empty_text_rows"),
        speakers("speaker_id").alias("unique_speakers"),
        F.count("gender").alias("known_gender_rows"),
        F.count(d).alias("duration_rows"),
        F.coalesce(F.avg(d), F.lit(float("nan"))).alias("duration_mean_seconds"),
    )


def gender_breakdown(rows: DataFrame) -> DataFrame:
    """Rows and share per gender, most frequent first."""
    gender = F.coalesce(F.col("gender"), F.lit(UNKNOWN_GENDER)).alias("gender")
    grouped = rows.groupBy(gender).agg(F.count("*").alias("rows"))
    # The window sees one row per distinct gender.
    share = F.col("rows") / F.sum("rows").over(Window.partitionBy())
    return grouped.select("gender", "rows", share.alias("share")).orderBy(F.desc("rows"), "gender")


def _cell(v: Column) -> Column:
    """Order-preserving cell number of a double, log-linear: 4096 cells per power of two.

    It depends on the value alone, so no bounds have to be known first, and one
    far outlier does not push everything else into a single cell.
    """
    exponent = F.least(F.floor(F.log2(F.abs(v))), F.lit(1024))
    mantissa = F.least(F.abs(v) / F.pow(F.lit(2.0), exponent) - 1, F.lit(1.0))
    code = (exponent + 1100) * 8192 + F.floor(F.nanvl(mantissa, F.lit(0.0)) * 4096) + 1
    return F.when(v == 0, F.lit(0).cast("bigint")).otherwise(F.signum(v).cast("bigint") * code)


def _middle_cell(counts: DataFrame, rank: int) -> tuple[int, int]:
    """The cell that holds the value of a rank, and how many values are in cells before it."""
    upto = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.select("cell", F.sum("n").over(upto).alias("through"), "n")
    found = ranked.where(F.col("through") > rank).orderBy("cell").first()
    return found["cell"], found["through"] - found["n"]


def _value_at(values: DataFrame, rank: int, cells: DataFrame | None = None) -> float:
    """The value of a 0-based rank in the order of a double column ``v``.

    Values are counted by cell where they lie, which leaves some thousand counts to shuffle. Of the
    cell with the rank, cut into ``PARTS`` cells between its least and largest value, the same; and
    so on until it holds one value or at most ``FEW`` rows. Doubles have 52 bits below their
    exponent, so that takes at most five passes, however the values cluster.
    """
    if cells is None:
        cells = values.groupBy(_cell(F.col("v")).alias("cell")).agg(F.count("*").alias("n"))
    cell, before = _middle_cell(cells, rank)
    inside, rank = values.where(_cell(F.col("v")) == cell), rank - before
    while True:
        low, high, n = inside.agg(F.min("v"), F.max("v"), F.count("*")).first()
        if low == high:
            return low
        if n <= FEW:
            return inside.orderBy("v").offset(rank).first()["v"]
        share = (F.col("v") / 2 - low / 2) / (high / 2 - low / 2)
        part = F.least(F.floor(share * PARTS), F.lit(PARTS - 1)).cast("int")
        cell, before = _middle_cell(inside.groupBy(part.alias("cell")).agg(F.count("*").alias("n")), rank)
        inside, rank = inside.where(part == cell), rank - before


def exact_median(values: DataFrame, column: str) -> DataFrame:
    """Exact interpolated median of a non-null double column, as a one-row table.

    Spark's ``median`` keeps all distinct values in one task; here no value is shuffled before
    the cell that holds the middle is known, and the last step sorts at most ``FEW`` rows.
    """
    found = _median(values.select(F.col(column).alias("v")))
    return values.sparkSession.range(1).select(F.lit(found).cast("double").alias("median"))


def _median(v: DataFrame) -> float | None:
    """One descent to the lower middle rank; the upper one is that value again or the next
    larger, which one more pass tells. The count comes from the first cells' counts."""
    cells = v.groupBy(_cell(F.col("v")).alias("cell")).agg(F.count("*").alias("n"))
    cells = durable(cells)  # counted once, used for the count and the descent
    n = cells.agg(F.sum("n")).first()[0]
    if not n:
        return None
    low = _value_at(v, (n - 1) // 2, cells)
    if n % 2:
        return low
    upto, above = v.agg(
        F.count(F.when(F.col("v") <= low, 1)), F.min(F.when(F.col("v") > low, F.col("v")))
    ).first()
    return low if upto > n // 2 else (low + above) / 2


def duration_summary(rows: DataFrame) -> DataFrame:
    """Count, min, median, mean and max of the durations that are numbers."""
    v = rows.select(_number(F.col("duration_seconds")).alias("v")).where(F.col("v").isNotNull())
    stats = v.agg(
        F.count("*").alias("rows_with_duration"),
        F.min("v").alias("min_seconds"),
        F.avg("v").alias("mean_seconds"),
        F.max("v").alias("max_seconds"),
    )
    return stats.select(
        "rows_with_duration",
        "min_seconds",
        F.lit(_median(v)).cast("double").alias("median_seconds"),
        "mean_seconds",
        "max_seconds",
    )
