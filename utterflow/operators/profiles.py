"""Profiles of canonical rows. Each takes a DataFrame and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from utterflow.functions.text import has_text, pieces, token_count
from utterflow.plans.storage import BROADCAST_BYTES, durable, fits_broadcast
from utterflow.schema import CANONICAL_SCHEMA, PATH, ROW

MISSING_GENDER = "<missing>"  # fixed value
# How the observed-schema profile names value types.
TYPE_NAMES = {"string": "str", "double": "float"}
TEXT_ROOM = 1 << 24


def observed_schema(rows: DataFrame) -> DataFrame:
    """Per canonical column: rows, non-null rows, and the type seen (null if none)."""
    fields = [f for f in CANONICAL_SCHEMA if f.name in rows.columns]
    counted = rows.agg(
        F.count("*").alias("rows"),
        *[F.count(f.name).alias(f.name) for f in fields],
    )
    per_field = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("field"),
                F.when(
                    F.col(f.name) > 0, F.lit(TYPE_NAMES[f.dataType.simpleString()])
                ).alias("observed_type"),
                F.col(f.name).alias("non_null_rows"),
            )
            for f in fields
        ]
    )
    return counted.select("rows", F.inline(per_field))


def exploded_tokens(rows: DataFrame, *keep: str) -> DataFrame:
    """One row per lower-cased token. Dropping empty pieces as rows is cheaper
    than building the token array without them."""
    return rows.select(*keep, F.explode(pieces(F.lower("text"))).alias("token")).where(
        "token != ''"
    )


def token_counts(rows: DataFrame) -> DataFrame:
    return exploded_tokens(rows).groupBy("token").agg(F.count("*").alias("cnt"))


def token_frequency(rows: DataFrame, top_k: int = 20, ties: str = "token") -> DataFrame:
    """The ``top_k`` most frequent lower-cased tokens.

    Equal counts are ordered by token, or with ``ties="first_seen"`` by where
    the token first occurs (file, row, place in text); that needs provenance
    columns.
    """
    if ties == "token":
        return token_counts(rows).orderBy(F.desc("cnt"), "token").limit(top_k)
    if ties != "first_seen":
        raise ValueError(f"ties must be 'token' or 'first_seen', got {ties!r}")
    # One pass: a token's place is one number, which a partial aggregation keeps the least of.
    places = _placed_texts(rows).select(
        "_base", F.posexplode(pieces(F.lower("text"))).alias("pos", "token")
    )
    counted = places.where("token != ''").groupBy("token").agg(
        F.count("*").alias("cnt"), F.min(_place(F.col("_base"), F.col("pos"))).alias("seen")
    )
    return counted.orderBy(F.desc("cnt"), "seen").limit(top_k).select("token", "cnt")


def _placed_texts(rows: DataFrame) -> DataFrame:
    """``(_base, text)``: numbers for the pieces of texts that go on through (file, row).

    Every row has room for 2^24 pieces, which leaves 2^39 rows; a longer text is an error. Rows per
    file come from a pass that reads no column. One row per *file* is summed up in order and
    broadcast, if it fits, else joined.
    """
    per_file = durable(rows.groupBy(PATH).agg((F.max(ROW) + 1).alias("rows")))
    before = Window.orderBy(PATH).rowsBetween(Window.unboundedPreceding, -1)
    files = per_file.select(
        PATH, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_start")
    )
    if fits_broadcast(per_file, BROADCAST_BYTES, PATH):
        files = F.broadcast(files)
    base = (F.col("_start") + F.col(ROW)) * TEXT_ROOM
    return rows.select(PATH, ROW, "text").join(files, PATH).select(base.alias("_base"), "text")


def _place(base: Column, pos: Column) -> Column:
    too_long = F.raise_error(F.lit(f"a text has more than {TEXT_ROOM} pieces"))
    return base + F.when(pos < TEXT_ROOM, pos).otherwise(too_long.cast("int"))


def text_length_profile(rows: DataFrame) -> DataFrame:
    """Tokens per text over rows that have text; null figures when none has."""
    n = F.when(has_text(F.col("text")), token_count(F.col("text")))
    return rows.select(n.cast("bigint").alias("n")).agg(
        F.count("*").alias("rows"),
        F.count("n").alias("count_with_text"),
        F.min("n").alias("min_tokens"),
        F.max("n").alias("max_tokens"),
        F.round(F.avg("n"), 4).alias("mean_tokens"),
    )


def gender_distribution(rows: DataFrame) -> DataFrame:
    gender = F.coalesce(F.nullif(F.col("gender"), F.lit("")), F.lit(MISSING_GENDER))
    return rows.groupBy(gender.alias("gender")).agg(F.count("*").alias("rows"))


def duration_profile(rows: DataFrame) -> DataFrame:
    """Durations that are not null. NaN is a value here, and the largest one."""
    d = F.col("duration_seconds")
    return rows.agg(
        F.count("*").alias("rows"),
        F.count(d).alias("count_with_duration"),
        F.min(d).alias("min_seconds"),
        F.max(d).alias("max_seconds"),
        F.round(F.avg(d), 4).alias("mean_seconds"),
    )


PROFILES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "schema": observed_schema,
    "text-frequency": token_frequency,
    "text-length": text_length_profile,
    "gender": gender_distribution,
    "duration": duration_profile,
}


def profile(rows: DataFrame, name: str) -> DataFrame:
    if name not in PROFILES:
        raise KeyError(f"unknown profile {name!r}, expected one of {', '.join(sorted(PROFILES))}")
    return PROFILES[name](rows)
