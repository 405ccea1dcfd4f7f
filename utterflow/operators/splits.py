"""Split assignment and the totals per split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utterflow.functions.hashing import target_split


def assign_split(
    rows: DataFrame, policy: str = "preserve", val_ratio: float = 0.1, test_ratio: float = 0.1
) -> DataFrame:
    """Adds ``split``. Needs no shuffle: the label depends on the row's own id."""
    return rows.withColumn("split", target_split(policy, val_ratio, test_ratio))


def _totals() -> list[Column]:
    seconds = F.sum(F.coalesce(F.col("duration_seconds"), F.lit(0.0)))
    seconds = F.coalesce(seconds, F.lit(0.0))
    return [
        F.count("*").alias("rows"),
        seconds.alias("duration_seconds"),
        F.round(seconds / 3600.0, 6).alias("duration_hours"),
    ]


def split_summary(rows: DataFrame) -> DataFrame:
    """Rows, seconds and hours per target split that has rows, in split order."""
    return rows.groupBy("split").agg(*_totals()).orderBy("split")


def split_totals(rows: DataFrame) -> DataFrame:
    """The same over all rows, as one row; zeros when there are none."""
    return rows.agg(*_totals())
