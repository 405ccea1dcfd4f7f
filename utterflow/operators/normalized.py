"""The training view: NFKC-normalised text and a running index per split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from utterflow.functions.text import char_count, normalize_text, token_count
from utterflow.operators.canonical import _source_column, audio_struct, union_rows
from utterflow.schema import PATH, ROW, CANONICAL_SCHEMA, Source, SourceSpec
from utterflow.sources.parquet import (
    leading_files,
    list_files,
    read_split,
    rows_of_files,
    scan_columns,
)

# About 200 bytes per file: up to 40 MB go to every executor. Tables with more
# files join by shuffle, where adaptive execution splits a file that is skewed.
BROADCAST_FILES = 200_000

POSITION = "_position"


def with_position(
    picked: DataFrame, split_rows: DataFrame, leading: list[tuple[str, int]] | None = None
) -> DataFrame:
    """Adds the 0-based index of each row within its split, in file order.

    ``leading`` are the files of a sample with the rows it takes of each: then no other is counted.

    The index is the row's own place in its file plus the rows of the files
    before it. Only one row per *file* is summed up in order (the driver lists
    as many); data rows are neither sorted nor shuffled.
    """
    if leading is not None:
        starts = {p: sum(n for _, n in leading[:i]) for i, (p, _) in enumerate(leading)}
        if not starts:
            return picked.withColumn(POSITION, F.col(ROW))
        known = F.create_map(*[F.lit(x) for pair in starts.items() for x in pair])
        return picked.withColumn(POSITION, known[F.col(PATH)] + F.col(ROW))
    per_file = split_rows.groupBy(F.col("_metadata.file_path").alias(PATH)).count()
    before = Window.orderBy(PATH).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_file.select(
        PATH, F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset")
    )
    if len(list_files(split_rows)) <= BROADCAST_FILES:
        offsets = F.broadcast(offsets)
    return picked.join(offsets, PATH).withColumn(POSITION, F.col("_offset") + F.col(ROW))


def normalize_rows(rows: DataFrame, spec: SourceSpec, split: str, audio: bool = False) -> DataFrame:
    """One projection of positioned rows; unlike the canonical one it trims only text.

    The explicit id counts unless null or empty; language falls back to the
    default when its column is null or empty.
    """

    def raw(name, kind="string"):
        column = _source_column(rows, name)
        return (F.lit(None) if column is None else column).cast(kind)

    duration = _source_column(rows, spec.duration_column)
    positional = F.concat_ws(":", F.lit(spec.key), F.lit(split), F.col(POSITION).cast("string"))
    columns = [
        F.lit(spec.dataset).alias("source_dataset"),
        F.lit(spec.subset).alias("source_subset"),
        F.lit(split).alias("source_split"),
        F.lit(spec.key).alias("dataset_key"),
        F.coalesce(F.nullif(raw(spec.record_id_column), F.lit("")), positional).alias("record_id"),
        raw(spec.speaker_column).alias("speaker_id"),
        raw(spec.gender_column).alias("gender"),
        F.coalesce(
            F.nullif(raw(spec.language_column), F.lit("")),
            F.lit(spec.default_language).cast("string"),
        ).alias("language"),
        normalize_text(raw(spec.text_column)).alias("text"),
        F.lit(spec.text_column).alias("text_source_column"),
        (F.lit(None).cast("double") if duration is None else duration).alias("duration_seconds"),
    ]
    if audio:
        columns.append(audio_struct(rows, spec.audio_column).alias("audio"))
    return rows.select(*columns)


def normalized_rows(
    spark: SparkSession,
    source: Source,
    splits: list[str] | None = None,
    *,
    sample_size: int | None = None,
    include_audio: bool = False,
) -> DataFrame:
    """The training view of a source, whole or the first rows of each split."""
    spec = source.spec
    wanted = spec.mapped_columns() + ([spec.audio_column] if include_audio else [])
    branches = []
    for split in source.splits if splits is None else dict.fromkeys(splits):
        rows = read_split(spark, source, split, wanted)
        if rows is None:
            continue
        if sample_size is None:
            placed = with_position(scan_columns(rows, wanted), rows)
        else:
            leading = leading_files(rows, sample_size)
            placed = with_position(rows_of_files(rows, leading, wanted), rows, leading)
        branches.append(normalize_rows(placed, spec, split, include_audio))
    schema = list(CANONICAL_SCHEMA)
    empty = spark.createDataFrame([], CANONICAL_SCHEMA).withColumn(
        "text_source_column", F.lit(spec.text_column)
    )
    names = [f.name for f in schema[:-1]] + ["text_source_column", "duration_seconds"]
    return union_rows(spark, branches, empty.select(*names).schema)


def add_text_metrics(rows: DataFrame) -> DataFrame:
    """Adds char_count (code points), word_count and is_empty_text; null text is ''."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return rows.select(
        "*",
        char_count(text).cast("bigint").alias("char_count"),
        token_count(text).cast("bigint").alias("word_count"),
        (text == "").alias("is_empty_text"),
    )
