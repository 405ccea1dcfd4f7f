"""What there is to select from: sources, splits, counts; and a first recipe."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utterflow.operators.canonical import canonical_rows, union_rows
from utterflow.operators.profiles import PROFILES, profile
from utterflow.plans.materialize import check_strategy
from utterflow.schema import CANONICAL_SCHEMA, PATH, ROW, Source
from utterflow.sources.parquet import split_counts

# Defaults of the sample.
DEFAULT_SAMPLE_SIZE, DEFAULT_PREVIEW_ROWS = 10_000, 5

CATALOG_SCHEMA = (
    "dataset_key string, source_dataset string, source_subset string, source_split string, "
    "rows bigint, exported boolean, train_only boolean, column_mapping map<string,string>"
)


def source_catalog(
    spark: SparkSession, sources: list[Source], include_unexported: bool = False
) -> DataFrame:
    """One row per dataset and split. Row counts come from file footers."""
    branches = []
    for source in sources:
        spec = source.spec
        exported = source.export_splits(include_unexported)
        mapping = [F.lit(v) for pair in spec.column_mapping().items() for v in pair]
        branches.append(
            split_counts(spark, source).select(
                F.lit(spec.key).alias("dataset_key"),
                F.lit(spec.dataset).alias("source_dataset"),
                F.lit(spec.subset).alias("source_subset"),
                "source_split",
                "rows",
                F.col("source_split").isin(exported).alias("exported"),
                F.lit(source.train_only).alias("train_only"),
                F.create_map(*mapping).cast("map<string,string>").alias("column_mapping"),
            )
        )
    schema = spark.createDataFrame([], CATALOG_SCHEMA).schema
    return union_rows(spark, branches, schema)


def exported_rows(
    rows: DataFrame, sources: list[Source], include_unexported: bool = False
) -> DataFrame:
    """Drops canonical rows of splits that their source does not export."""
    if include_unexported:
        return rows
    hidden = [
        (F.col("dataset_key") == s.spec.key) & F.col("source_split").isin(*s.spec.unexported_splits)
        for s in sources
        if s.spec.unexported_splits
    ]
    for condition in hidden:
        rows = rows.where(~condition)
    return rows


def analyze(
    spark: SparkSession,
    source: Source,
    name: str,
    split: str | None = None,
    sample_size: int | None = DEFAULT_SAMPLE_SIZE,
) -> DataFrame:
    """A profile of the sample of one split, by default the source's first default split."""
    split = split or source.first_split
    rows = canonical_rows(
        spark, source, [] if split is None else [split], sample_size=sample_size, provenance=True
    )
    return profile(rows, name)


def default_policy(sources: list[Source]) -> str:
    """Hash a validation split if any source has none of its own."""
    return "train-val" if any(s.train_only for s in sources) else "preserve"


def draft_recipe(
    spark: SparkSession,
    sources: list[Source],
    *,
    analyses: tuple[str, ...] = (),
    policy: str | None = None,
    val_ratio: float = 0.1,
    test_ratio: float = 0.1,
    sample_size: int = DEFAULT_SAMPLE_SIZE,
    preview_rows: int = DEFAULT_PREVIEW_ROWS,
    include_unexported: bool = False,
) -> dict[str, Any]:
    """The recipe that selects all exported splits; edit it, then materialise it."""
    unknown = sorted(set(analyses) - set(PROFILES))
    if unknown:
        raise KeyError(f"unknown profiles: {', '.join(unknown)}")
    strategy = check_strategy(
        {
            "policy": policy or default_policy(sources),
            "val_ratio": val_ratio,
            "test_ratio": test_ratio,
        }
    )
    counts: dict[str, dict[str, int]] = {}
    for r in source_catalog(spark, sources).collect():  # one row per split
        counts.setdefault(r["dataset_key"], {})[r["source_split"]] = r["rows"]
    return {
        "selected_datasets": [
            {
                "dataset_key": s.spec.key,
                "source_dataset": s.spec.dataset,
                "source_subset": s.spec.subset,
                "selected_splits": s.export_splits(include_unexported),
                "canonical_column_mapping": s.spec.column_mapping(),
                "upstream_split_counts": counts.get(s.spec.key, {}),
            }
            for s in sources
        ],
        "selected_analyses": list(analyses),
        "sample_policy": {
            "mode": "sample",
            "sample_size": sample_size,
            "preview_rows": preview_rows,
        },
        "split_strategy": strategy,
        "filters": {"status": "not_started", "pipeline": []},
    }


def preview(
    spark: SparkSession, source: Source, split: str, rows: int = DEFAULT_PREVIEW_ROWS
) -> DataFrame:
    """The first canonical rows of a split, in file order."""
    head = canonical_rows(spark, source, [split], sample_size=rows, provenance=True)
    return head.orderBy(PATH, ROW).drop(PATH, ROW)


def inspect_sources(
    spark: SparkSession,
    sources: Mapping[str, Source] | list[Source],
    *,
    split: str | None = None,
    sample_size: int | None = DEFAULT_SAMPLE_SIZE,
) -> DataFrame:
    """Per dataset and split: how many rows a sample holds, and which splits there are."""
    branches = []
    listed = list(sources.values()) if isinstance(sources, Mapping) else sources
    for source in sorted(listed, key=lambda s: s.spec.key):
        for name in [split] if split else source.splits:
            sample = canonical_rows(spark, source, [name], sample_size=sample_size)
            branches.append(
                sample.agg(F.count("*").alias("rows_sampled")).select(
                    F.lit(source.spec.key).alias("dataset_key"),
                    F.lit(source.spec.dataset).alias("source_dataset"),
                    F.lit(source.spec.subset).alias("source_subset"),
                    F.lit(name).alias("source_split"),
                    "rows_sampled",
                    F.lit(",".join(source.splits)).alias("available_splits"),
                )
            )
    schema = spark.createDataFrame(
        [],
        "dataset_key string, source_dataset string, source_subset string, source_split string, "
        "rows_sampled bigint, available_splits string",
    ).schema
    return union_rows(spark, branches, schema)


def inspect_report(
    spark: SparkSession,
    sources: Mapping[str, Source] | list[Source],
    *,
    split: str | None = None,
    sample_size: int | None = DEFAULT_SAMPLE_SIZE,
    preview_rows: int = DEFAULT_PREVIEW_ROWS,
) -> DataFrame:
    """``inspect_sources`` with each dataset's column mapping and the first rows of each split.

    ``preview`` is an array of canonical rows in file order; ``preview_rows`` bounds it.
    """
    counts = inspect_sources(spark, sources, split=split, sample_size=sample_size)
    listed = list(sources.values()) if isinstance(sources, Mapping) else sources
    row = F.struct(*CANONICAL_SCHEMA.fieldNames())
    branches = []
    for source in listed:
        mapping = [F.lit(v) for pair in source.spec.column_mapping().items() for v in pair]
        for name in [split] if split else source.splits:
            most = preview_rows if sample_size is None else min(preview_rows, sample_size)
            head = canonical_rows(spark, source, [name], sample_size=most, provenance=True)
            placed = F.sort_array(F.collect_list(F.struct(PATH, ROW, row.alias("row"))))
            branches.append(
                head.agg(F.transform(placed, lambda p: p["row"]).alias("preview")).select(
                    F.lit(source.spec.key).alias("dataset_key"),
                    F.lit(name).alias("source_split"),
                    F.create_map(*mapping).cast("map<string,string>").alias("column_mapping"),
                    "preview",
                )
            )
    empty = counts.where(F.lit(False)).select(
        "dataset_key",
        "source_split",
        F.lit(None).cast("map<string,string>").alias("column_mapping"),
        F.array(F.lit(None).cast(CANONICAL_SCHEMA)).alias("preview"),
    )
    details = union_rows(spark, branches, empty.schema)
    return counts.join(details, ["dataset_key", "source_split"])
