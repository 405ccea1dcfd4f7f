"""Parquet scans: column-pruned, split-scoped, tagged with file and row."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from utterflow.schema import PATH, ROW, Source


def _file_path() -> Column:
    return F.col("_metadata.file_path")


def _read(spark: SparkSession, paths: list[str], wanted: list[str]) -> DataFrame:
    """Spark takes the schema of one file. A wanted column that this file lacks
    may be in others, so only then are the schemas of all files merged."""
    rows = _each_file_once(spark, spark.read, paths)
    if set(wanted) <= set(rows.columns) or len(rows.inputFiles()) == 1:
        return rows
    return _each_file_once(spark, spark.read.option("mergeSchema", True), paths)


def _each_file_once(spark: SparkSession, reader, paths: list[str]) -> DataFrame:
    """Paths may overlap, as a glob and a file in it do; Spark would read that file twice.

    With several paths the driver's listing tells; only if a file is in it twice are the files read
    one by one.
    """
    rows = reader.parquet(*paths)
    if len(paths) == 1:
        return rows
    return rows if _is_set(listed := _listing(rows)) else reader.parquet(*sorted(set(listed)))


def _listing(rows: DataFrame) -> list[str]:
    """Files that a scan reads, as often as it reads them."""
    scan = rows._jdf.queryExecution().optimizedPlan().collectLeaves().head()
    return list(scan.relation().location().inputFiles())


def _is_set(items: list[str]) -> bool:
    return len(set(items)) == len(items)


def scan_columns(rows: DataFrame, wanted: list[str]) -> DataFrame:
    """The wanted columns that exist, plus provenance. Nothing else is read."""
    present = [c for c in wanted if c in rows.columns]
    return rows.select(
        *[F.col(f"`{c}`") for c in present],
        _file_path().alias(PATH),
        F.col("_metadata.row_index").alias(ROW),
    )


def read_split(
    spark: SparkSession, source: Source, split: str, wanted: list[str] = ()
) -> DataFrame | None:
    """All columns of one split as Spark reads them; None for an unknown split."""
    paths = source.split_paths(split)
    if not paths:
        return None
    if source.schema is not None:
        return _each_file_once(spark, spark.read.schema(source.schema), paths)
    return _read(spark, paths, wanted)


def list_files(rows: DataFrame) -> list[str]:
    """Files behind a scan in path order, spelled as ``_metadata.file_path`` does.

    Spark's driver has already listed them; no job runs.
    """
    return sorted(re.sub(r"^([\w+.-]+):///", r"\1:/", f) for f in rows.inputFiles())


def _covering(rows: DataFrame, files: list[str], limit: int) -> list[tuple[str, int]]:
    """Leading files that hold the first ``limit`` rows, and how many of each count."""
    found: list[tuple[str, int]] = []
    missing, step = limit, 1
    while missing > 0 and files:
        chunk, files, step = files[:step], files[step:], min(step * 2, 4096)
        counted = rows.where(_file_path().isin(chunk)).groupBy(_file_path().alias(PATH)).count()
        counts = {r[PATH]: r["count"] for r in counted.collect()}  # at most one row per file
        for file in chunk:
            taken = min(counts.get(file, 0), missing)
            if taken:
                found.append((file, taken))
                missing -= taken
    return found


def first_rows(rows: DataFrame, limit: int, wanted: list[str]) -> DataFrame:
    """The first ``limit`` rows in (file, row) order of an unprojected scan.

    Sorting would send up to ``limit`` rows of *every* task to one task. The
    rows are fixed by the row counts of the leading files instead, which
    Parquet footers hold: count a few files (no column is read), twice as many
    next time, until they cover the limit. What is left is a filter - Spark
    prunes the other files by path - with no sort and no shuffle.
    """
    return rows_of_files(rows, leading_files(rows, limit), wanted)


def leading_files(rows: DataFrame, limit: int) -> list[tuple[str, int]]:
    """The files that hold the first ``limit`` rows, and how many of each count; at most ``limit``."""
    if limit < 0:
        raise ValueError(f"limit must be >= 0, got {limit}")
    leading = _covering(rows, list_files(rows), limit)
    if not leading and limit > 0:
        # An empty table, or a file system whose listing spells paths otherwise.
        paths = rows.select(_file_path().alias(PATH)).distinct().orderBy(PATH)
        leading = _covering(rows, [r[PATH] for r in paths.limit(limit + 4096).collect()], limit)
    return leading


def rows_of_files(
    rows: DataFrame, leading: list[tuple[str, int]], wanted: list[str]
) -> DataFrame:
    """The rows of ``leading_files``, of which only the last file is not taken whole."""
    if not leading:
        return scan_columns(rows.where(F.lit(False)), wanted)
    last, last_rows = leading[-1]
    picked = scan_columns(rows.where(_file_path().isin([f for f, _ in leading])), wanted)
    return picked.where((F.col(PATH) != last) | (F.col(ROW) < last_rows))


def read_rows(
    spark: SparkSession, paths: str | list[str], columns: list[str], limit: int | None = None
) -> DataFrame:
    """Named columns of Parquet paths or globs, optionally only the first rows."""
    unique = [paths] if isinstance(paths, str) else list(dict.fromkeys(paths))
    rows = _read(spark, unique, columns)
    found = scan_columns(rows, columns) if limit is None else first_rows(rows, limit, columns)
    return found.drop(PATH, ROW)


def split_counts(spark: SparkSession, source: Source) -> DataFrame:
    """Rows per split. No column is read, so this costs the file footers only."""
    branches = []
    for split in source.splits:
        rows = read_split(spark, source, split)
        branches.append(
            rows.agg(F.count("*").alias("rows")).select(F.lit(split).alias("source_split"), "rows")
        )
    if not branches:
        return spark.createDataFrame([], "source_split string, rows bigint")
    counts = branches[0]
    for branch in branches[1:]:
        counts = counts.unionByName(branch)
    return counts
