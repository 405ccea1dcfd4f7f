"""Canonicalisation: any source table to the ten canonical columns."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from utterflow.functions.hashing import derived_id
from utterflow.functions.text import blank_to_null, strip_blanks
from utterflow.schema import AUDIO_TYPE, PATH, ROW, Source, SourceSpec, canonical_schema
from utterflow.sources.parquet import first_rows, read_split, scan_columns


def seed_path(root: str | None, path: Column) -> Column:
    """The file path that seeds derived ids: decoded, and relative to ``root``.

    Both the sampling and the full scan use it, so one row has one id. Without
    a root it is the whole path, which keeps equal file names in different
    directories apart. A root without a scheme begins right after scheme and
    authority of a path. ``url_decode`` would turn + into a space.
    """
    if root:
        scheme, rest = re.match(r"(?s)([A-Za-z][\w+.-]*:)?(.*)", root).groups()
        start = re.escape(quote(rest.rstrip("/") + "/", safe="/:@!$&'()*+,;=-._~"))
        if not scheme:
            lead = "^(?:[A-Za-z][A-Za-z0-9+.-]*:(?://[^/]*)?)?" + start
        else:
            # file:/x, file:///x and file://x name the same for a path without an authority.
            local = re.match(r"/{2,}", rest) is None or rest.startswith("///")
            slashes = "/{1,3}" if local else "//"
            inner = re.escape(quote(rest.strip("/") + "/", safe="/:@!$&'()*+,;=-._~"))
            lead = f"^{re.escape(scheme)}{slashes}{inner}"
        path = F.regexp_replace(path, F.lit(lead), F.lit(""))
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _source_column(rows: DataFrame, name: str | None) -> Column | None:
    return F.col(f"`{name}`") if name and name in rows.columns else None


def _text_or_null(rows: DataFrame, name: str | None) -> Column:
    column = _source_column(rows, name)
    return F.lit(None).cast("string") if column is None else blank_to_null(column)


def record_id(rows: DataFrame, spec: SourceSpec, path: Column, row: Column) -> Column:
    """The explicit id, untrimmed, unless it is null or blank; else a derived one."""
    derived = derived_id(spec.key, path, row)
    explicit = _source_column(rows, spec.record_id_column)
    if explicit is None:
        return derived
    explicit = explicit.cast("string")
    return F.when(strip_blanks(explicit) != "", explicit).otherwise(derived)


def audio_struct(rows: DataFrame, name: str) -> Column:
    """``{bytes, path}`` from a struct by field name, or ``{null, value}`` from a scalar."""
    column = _source_column(rows, name)
    if column is None:
        return F.lit(None).cast(AUDIO_TYPE)
    source_type = rows.schema[name].dataType
    if isinstance(source_type, T.StructType):
        parts = [
            (
                column.getField(f.name) if f.name in source_type.fieldNames() else F.lit(None)
            ).cast(f.dataType).alias(f.name)
            for f in AUDIO_TYPE
        ]
    else:
        parts = [F.lit(None).cast("binary").alias("bytes"), column.cast("string").alias("path")]
    return F.when(column.isNotNull(), F.struct(*parts)).cast(AUDIO_TYPE)


def canonicalize(
    rows: DataFrame,
    spec: SourceSpec,
    split: str,
    *,
    root: str | None = None,
    path_expr: Column | None = None,
    include_audio: bool = False,
    provenance: bool = False,
) -> DataFrame:
    """One projection from a tagged scan (see ``scan_columns``) to canonical rows.

    ``path_expr`` overrides the path that seeds derived ids. An unparsable
    duration raises under Spark's default ANSI mode.
    """
    path = path_expr if path_expr is not None else seed_path(root, F.col(PATH))
    if spec.language_column:
        language = _text_or_null(rows, spec.language_column)
    else:
        language = F.lit(spec.default_language).cast("string")
    duration = _source_column(rows, spec.duration_column)
    values = {
        "source_dataset": F.lit(spec.dataset),
        "source_subset": F.lit(spec.subset),
        "source_split": F.lit(split),
        "dataset_key": F.lit(spec.key),
        "record_id": record_id(rows, spec, path, F.col(ROW)),
        "speaker_id": _text_or_null(rows, spec.speaker_column),
        "gender": _text_or_null(rows, spec.gender_column),
        "language": language,
        "text": _text_or_null(rows, spec.text_column),
        "duration_seconds": F.lit(None) if duration is None else duration,
    }
    if include_audio:
        values["audio"] = audio_struct(rows, spec.audio_column)
    if provenance:
        values[PATH], values[ROW] = F.col(PATH), F.col(ROW)
    schema = canonical_schema(include_audio, provenance)
    return rows.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in schema])


def union_rows(spark: SparkSession, branches: list[DataFrame], schema: T.StructType) -> DataFrame:
    """Bag union; no rows is an empty table, not an error."""
    if not branches:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, branches)


def canonical_rows(
    spark: SparkSession,
    source: Source,
    splits: list[str] | None = None,
    *,
    sample_size: int | None = None,
    include_audio: bool = False,
    provenance: bool = False,
) -> DataFrame:
    """Canonical rows of a source: all of it, or chosen splits, or their first rows.

    ``sample_size`` counts rows per split. An unknown split contributes no rows.
    """
    spec = source.spec
    wanted = spec.mapped_columns() + ([spec.audio_column] if include_audio else [])
    branches = []
    for split in source.splits if splits is None else dict.fromkeys(splits):
        rows = read_split(spark, source, split, wanted)
        if rows is None:
            continue
        if sample_size is None:
            picked = scan_columns(rows, wanted)
        else:
            picked = first_rows(rows, sample_size, wanted)
        branches.append(
            canonicalize(
                picked,
                spec,
                split,
                root=source.root,
                include_audio=include_audio,
                provenance=provenance,
            )
        )
    return union_rows(spark, branches, canonical_schema(include_audio, provenance))


def union_sources(
    spark: SparkSession, sources: list[Source], *, provenance: bool = False
) -> DataFrame:
    """Bag union of every split of every source; duplicates stay.

    The sources' plans are built at once: each may list files and read a footer first.
    """
    with ThreadPoolExecutor(max_workers=max(1, min(8, len(sources)))) as pool:
        branches = list(pool.map(lambda s: canonical_rows(spark, s, provenance=provenance), sources))
    return union_rows(spark, branches, canonical_schema(provenance=provenance))
