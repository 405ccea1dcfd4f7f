"""Recipe-driven materialisation: select, filter, split, write, summarise."""

from __future__ import annotations

import json
from collections.abc import Mapping
from contextlib import contextmanager
import uuid
from dataclasses import dataclass, replace
from typing import Any
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from utterflow.functions.hashing import check_ratio, target_split
from utterflow.operators.canonical import canonical_rows, union_rows
from utterflow.operators.filters import (
    FILTER_TYPE,
    OverlapFilter,
    apply_filter,
    filter_by_vocabulary,
    filters_of,
)
from utterflow.plans.storage import delete_folder, durable, qualified
from utterflow.schema import CANONICAL_SCHEMA, PATH, ROW, Source, canonical_schema
from utterflow.sources.arrow_ipc import FORMAT as ARROW_FORMAT
from utterflow.sources.arrow_ipc import register_arrow_ipc

FORMATS = ("parquet", "arrow", "both")
# Registers of the speaker sketches: 2^14, some 16 KB a split.
SKETCH_BITS = 14
MODES = ("errorifexists", "overwrite", "append", "ignore")
# Defaults of the vocabulary filter and of the output files.
DEFAULT_TOP_K, DEFAULT_MIN_OVERLAP, DEFAULT_ROWS_PER_FILE = 500, 0.5, 100_000

CONCURRENT_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@dataclass(frozen=True)
class VocabularyFilter:
    """A filter whose vocabulary is a table (column ``token``).

    With a column ``rank``, only the first ``top_k`` ranks count; None means all.
    """

    vocabulary: DataFrame
    min_overlap_ratio: float = DEFAULT_MIN_OVERLAP
    min_tokens: int = 1
    max_tokens: int | None = None
    top_k: int | None = DEFAULT_TOP_K

    def tokens(self) -> DataFrame:
        table = self.vocabulary
        if self.top_k is not None and "rank" in table.columns:
            table = table.where(F.col("rank") < self.top_k)
        return table.select("token")


@dataclass(frozen=True)
class Materialized:
    """What a materialisation wrote: its folder, and its manifest as tables."""

    out_dir: str
    splits: DataFrame
    files: DataFrame
    totals: DataFrame


def check_strategy(strategy: Mapping[str, Any]) -> dict[str, Any]:
    """The split strategy of a recipe with its defaults, checked before any job."""
    resolved = {
        "policy": strategy.get("policy", "preserve"),
        "val_ratio": check_ratio("val_ratio", strategy.get("val_ratio", 0.1)),
        "test_ratio": check_ratio("test_ratio", strategy.get("test_ratio", 0.1)),
    }
    target_split(**resolved)
    return resolved


def _pipeline(recipe: Mapping[str, Any]) -> list[Mapping[str, Any]]:
    section = recipe.get("filters")
    return list(section.get("pipeline") or []) if isinstance(section, Mapping) else []


def with_filters(
    recipe: Mapping[str, Any],
    filters: Mapping[str, OverlapFilter | VocabularyFilter] | None,
    vocabularies: Mapping[str, str] | None = None,
) -> dict[str, Any]:
    """The recipe with the filters added to its pipeline, as its manifest records it.

    A vocabulary that is a table is kept as one, next to the manifest; the entry names its place.
    """
    pipeline = _pipeline(recipe)
    for key, config in (filters or {}).items():
        entry = {
            "type": FILTER_TYPE,
            "dataset_key": key,
            "min_overlap_ratio": config.min_overlap_ratio,
            "min_text_tokens": config.min_tokens,
            "max_text_tokens": config.max_tokens,
        }
        if isinstance(config, OverlapFilter):
            entry["top_tokens"] = list(config.vocabulary)
        elif vocabularies is not None:
            entry["vocabulary_path"] = vocabularies[key]
        pipeline.append(entry)
    status = "configured" if pipeline else "not_started"
    return {**recipe, "filters": {"status": status, "pipeline": pipeline}}


def select_rows(
    spark: SparkSession,
    recipe: Mapping[str, Any],
    sources: Mapping[str, Source],
    *,
    filters: Mapping[str, OverlapFilter | VocabularyFilter] | None = None,
    include_audio: bool = False,
) -> DataFrame:
    """Canonical rows a recipe selects, filtered and with their target ``split``.

    One lazy plan: scan, project, filter, project, union. There is no shuffle
    in it unless a vocabulary is too large to be part of the plan. ``filters``
    override those of the recipe; a recipe's sample policy does not apply.
    """
    strategy = check_strategy(recipe.get("split_strategy", {}))
    pipeline = _pipeline(recipe)
    configs = {**filters_of(pipeline), **_table_filters(spark, pipeline), **(filters or {})}
    branches = []
    for entry in recipe.get("selected_datasets", []):
        key = entry["dataset_key"]
        if key not in sources:
            raise KeyError(f"recipe selects {key!r}, known sources: {', '.join(sorted(sources))}")
        config = configs.get(key)
        by_table = isinstance(config, VocabularyFilter)
        rows = canonical_rows(
            spark,
            sources[key],
            list(entry["selected_splits"]),
            include_audio=include_audio,
            provenance=by_table,
        )
        if by_table:
            rows = filter_by_vocabulary(
                rows,
                config.tokens(),
                config.min_overlap_ratio,
                config.min_tokens,
                config.max_tokens,
            ).drop(PATH, ROW)
        else:
            rows = apply_filter(rows, config)
        branches.append(rows)
    selected = union_rows(spark, branches, canonical_schema(include_audio))
    return selected.withColumn("split", target_split(**strategy))


def _table_filters(
    spark: SparkSession, pipeline: list[Mapping[str, Any]]
) -> dict[str, VocabularyFilter]:
    """Filters whose vocabulary a manifest keeps as a table; the last entry of a dataset counts."""
    last = {e["dataset_key"]: e for e in pipeline
            if e.get("type") == FILTER_TYPE and e.get("dataset_key")}
    return {
        key: VocabularyFilter(
            spark.read.parquet(e["vocabulary_path"]),
            float(e.get("min_overlap_ratio", 0.0)),
            int(e.get("min_text_tokens", 1)),
            None if e.get("max_text_tokens") is None else int(e["max_text_tokens"]),
            top_k=None,
        )
        for key, e in last.items()
        if e.get("vocabulary_path")
    }


@contextmanager
def _without_sort(spark: SparkSession, writers: int = 8):
    """Keeps one file per split open in a task, so that rows (and audio) need
    not be sorted by split first. Past that many splits Spark sorts after all."""
    before = spark.conf.get(CONCURRENT_WRITERS)
    spark.conf.set(CONCURRENT_WRITERS, str(writers))
    try:
        yield
    finally:
        spark.conf.set(CONCURRENT_WRITERS, before)


def write_splits(
    rows: DataFrame,
    out_dir: str,
    *,
    output_format: str = "parquet",
    max_rows_per_file: int = DEFAULT_ROWS_PER_FILE,
    mode: str = "errorifexists",
    rebalance: bool = False,
) -> list[tuple[str, str]]:
    """Writes ``parquet/split=<split>/`` and/or ``arrow/split=<split>/``; returns the new files.

    ``mode`` acts on the folder as it is (``materialize`` acts on its manifest instead). Every
    task writes its own rows. ``rebalance`` shuffles once to give files of even size where the
    input comes in many small pieces: it spreads a large split over many tasks and needs no
    knowledge of how large each one is.
    """
    wanted = _wanted_formats(output_format, max_rows_per_file, mode)
    spark = rows.sparkSession
    held = formats_of(spark, out_dir)
    if held and mode == "errorifexists":
        raise FileExistsError(f"{out_dir} already holds {' and '.join(sorted(held))} files")
    if held and mode == "ignore":
        return []
    if held and mode == "append" and held != wanted:
        raise ValueError(f"{out_dir} holds {' and '.join(sorted(held))} files, not {output_format}")
    if mode == "overwrite":
        # All formats: what another one left behind is not part of the new output. The rows may
        # come from there, so they are not read after this.
        rows = durable(rows) if held else rows
        for name in ("parquet", "arrow", "_manifest"):
            delete_folder(spark, f"{out_dir}/{name}")
    return write_files(rows, out_dir, wanted, max_rows_per_file, rebalance)


def _wanted_formats(output_format: str, max_rows_per_file: int, mode: str) -> set[str]:
    if output_format not in FORMATS:
        raise ValueError(f"unknown format {output_format!r}, expected one of {', '.join(FORMATS)}")
    if max_rows_per_file < 1:
        raise ValueError("max_rows_per_file must be at least 1")
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}, expected one of {', '.join(MODES)}")
    return {"parquet", "arrow"} if output_format == "both" else {output_format}


def write_files(
    rows: DataFrame, out_dir: str, wanted: set[str], max_rows_per_file: int, rebalance: bool
) -> list[tuple[str, str]]:
    """Adds files beside what is there and returns ``(format, file)`` of those it wrote.

    No manifest lists them until one is committed. Files already there, also those of a run that
    broke off, are not among them.
    """
    spark = rows.sparkSession
    if rebalance:
        rows = rows.hint("rebalance", F.col("split"))
    new: list[tuple[str, str]] = []
    if "parquet" in wanted:
        before = set(_data_files(spark, out_dir))
        with _without_sort(spark):
            rows.write.mode("append").partitionBy("split").option(
                "maxRecordsPerFile", max_rows_per_file
            ).parquet(f"{out_dir}/parquet")
        written = sorted(set(_data_files(spark, out_dir)) - before)
        new += [("parquet", f) for f in written]
        if "arrow" in wanted:  # what was written just now is not computed twice
            rows = _written(spark, out_dir, rows.schema, written)
    if "arrow" in wanted:
        register_arrow_ipc(spark)
        before = set(_arrow_files(spark, out_dir))
        rows.write.format(ARROW_FORMAT).mode("append").option(
            "maxRecordsPerFile", max_rows_per_file
        ).save(_arrow_folder(spark, out_dir))
        new += [("arrow", f) for f in sorted(set(_arrow_files(spark, out_dir)) - before)]
    return new


def _arrow_files(spark: SparkSession, out_dir: str) -> list[str]:
    """Arrow files of an output as the reader's ``_path`` names them."""
    from utterflow.sources.arrow_ipc import _data_files as arrow_data_files
    from utterflow.sources.arrow_ipc import _filesystem

    filesystem, root = _filesystem(_arrow_folder(spark, out_dir))
    return arrow_data_files(filesystem, root)


def _data_files(spark: SparkSession, out_dir: str) -> list[str]:
    """Parquet files of an output, as the driver lists them."""
    try:
        return list(spark.read.parquet(f"{out_dir}/parquet").inputFiles())
    except AnalysisException:  # no such path, or no file in it
        return []


def _written(
    spark: SparkSession, out_dir: str, schema: T.StructType, files: list[str]
) -> DataFrame:
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{out_dir}/parquet").parquet(*files)


def formats_of(spark: SparkSession, out_dir: str) -> set[str]:
    """The formats that an output folder holds files of."""
    found = {"parquet"} if _data_files(spark, out_dir) else set()
    return found | ({"arrow"} if _arrow_or_none(spark, out_dir) is not None else set())


def read_split_parquet(spark: SparkSession, out_dir: str, schema: T.StructType) -> DataFrame:
    """Written rows with ``split`` as text (Spark would guess a number from ``2024``)."""
    return spark.read.schema(schema).parquet(f"{out_dir}/parquet")


def _parquet_or_none(spark: SparkSession, out_dir: str) -> DataFrame | None:
    try:
        found = spark.read.parquet(f"{out_dir}/parquet")
    except AnalysisException:  # no such path, or no file in it
        return None
    if "split" not in found.columns:
        return None
    fields = [T.StructField(f.name, T.StringType()) if f.name == "split" else f
              for f in found.schema]
    return read_split_parquet(spark, out_dir, T.StructType(fields))


def _arrow_folder(spark: SparkSession, out_dir: str) -> str:
    """Arrow opens files itself, so it is told the file system that Spark would use."""
    return qualified(spark, f"{out_dir}/arrow")


def _arrow_or_none(
    spark: SparkSession,
    out_dir: str,
    splits: list[str] | None = None,
    columns: list[str] | None = None,
) -> DataFrame | None:
    register_arrow_ipc(spark)
    reader = spark.read.format(ARROW_FORMAT)
    if splits is not None:
        reader = reader.option("only", json.dumps({"split": list(splits)}))
    try:
        found = reader.load(_arrow_folder(spark, out_dir))
        if columns is not None:
            names = dict.fromkeys([*columns, *(["split"] if splits is not None else [])])
            schema = T.StructType([found.schema[name] for name in names])
            found = reader.schema(schema).load(_arrow_folder(spark, out_dir))
        return found
    except Exception as error:  # the data source reports through a Python worker
        if "no Arrow files under" in str(error):
            return None
        raise


def reload(
    spark: SparkSession,
    out_dir: str,
    splits: list[str] | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """A materialised dataset as its current manifest lists it, in the format it names first.

    Only the listed files are read: files of a run that broke off before its manifest, or of an
    older version, lie beside them unread. Parquet comes before Arrow. Without a manifest (a
    stream has none) what is in the folder counts. Only the named splits' files and columns are
    read, in either format.
    """
    version = current_version(spark, out_dir)
    if version is None:
        return _reload_folder(spark, out_dir, splits, columns)
    listed = spark.read.parquet(f"{_version_folder(out_dir, version)}/files")
    if splits is not None:
        listed = listed.where(F.col("split").isin(splits))
    # File names only: as many as Spark's own index of the folder would hold.
    by_format: dict[str, list[str]] = {}
    for r in listed.select("format", "file").collect():
        by_format.setdefault(r["format"], []).append(r["file"])
    if "parquet" in by_format:
        found = _parquet_files(spark, out_dir, sorted(by_format["parquet"]))
    elif "arrow" in by_format:
        found = _arrow_listed(spark, out_dir, sorted(by_format["arrow"]), columns)
    else:
        found = _empty_like(spark, out_dir, version)
    if splits is not None:
        found = found.where(F.col("split").isin(splits))
    return found if columns is None else found.select(*columns)


def _reload_folder(spark, out_dir, splits, columns) -> DataFrame:
    found = _parquet_or_none(spark, out_dir)
    if found is None:
        found = _arrow_or_none(spark, out_dir, splits, columns)
    if found is None:
        raise FileNotFoundError(f"no materialised files under {out_dir}")
    if splits is not None:
        found = found.where(F.col("split").isin(splits))
    return found if columns is None else found.select(*columns)


def _parquet_files(spark: SparkSession, out_dir: str, files: list[str]) -> DataFrame:
    """Listed Parquet files with ``split`` as text, however the values look."""
    reader = spark.read.option("basePath", f"{out_dir}/parquet")
    found = reader.parquet(*files)
    fields = [T.StructField(f.name, T.StringType()) if f.name == "split" else f for f in found.schema]
    return reader.schema(T.StructType(fields)).parquet(*files)


def _arrow_listed(spark, out_dir, files, columns) -> DataFrame:
    register_arrow_ipc(spark)
    reader = spark.read.format(ARROW_FORMAT).option("files", json.dumps(files))
    found = reader.load(_arrow_folder(spark, out_dir))
    if columns is not None:
        names = dict.fromkeys([*columns, "split"])
        found = reader.schema(T.StructType([found.schema[n] for n in names])).load(
            _arrow_folder(spark, out_dir)
        )
    return found


def _empty_like(spark: SparkSession, out_dir: str, version: int) -> DataFrame:
    """No listed file (nothing selected): the rows' schema as the manifest records it."""
    dataset = spark.read.json(f"{_version_folder(out_dir, version)}/dataset").first()
    audio = bool(dataset and dataset["audio_enabled"])
    return spark.createDataFrame([], canonical_schema(audio).add("split", T.StringType()))


# --- versions of the manifest -------------------------------------------------
# Data files are never changed. A run writes its manifest to a folder of its own and makes it
# current by one rename to _manifest/v=<n>; the highest n is current. Append lists the files of
# the version before and its own, overwrite its own only. A run that breaks off leaves files that
# no version lists.


def _version_folder(out_dir: str, version: int) -> str:
    return f"{out_dir}/_manifest/v={version}"


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def versions(spark: SparkSession, out_dir: str) -> list[int]:
    """Committed versions of an output's manifest, ascending."""
    filesystem, folder = _hadoop(spark, f"{out_dir}/_manifest")
    if not filesystem.exists(folder):
        return []
    found = []
    for status in filesystem.listStatus(folder):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("v=") and name[2:].isdigit():
            found.append(int(name[2:]))
    return sorted(found)


def current_version(spark: SparkSession, out_dir: str) -> int | None:
    found = versions(spark, out_dir)
    return found[-1] if found else None


def _commit(spark: SparkSession, pending: str, out_dir: str, version: int) -> None:
    """Makes a written manifest current by one rename; a version that exists is not replaced."""
    filesystem, source = _hadoop(spark, pending)
    _, target = _hadoop(spark, _version_folder(out_dir, version))
    if filesystem.exists(target) or not filesystem.rename(source, target):
        raise RuntimeError(f"version {version} of {out_dir} was committed by another run")


def _manifest_formats(spark: SparkSession, out_dir: str) -> set[str] | None:
    """The formats that the current manifest lists; None without one."""
    version = current_version(spark, out_dir)
    if version is None:
        return None
    files = spark.read.parquet(f"{_version_folder(out_dir, version)}/files")
    return {r["format"] for r in files.select("format").distinct().collect()}


def _per_file(spark: SparkSession, out_dir: str, new: list[tuple[str, str]]) -> DataFrame:
    """Split, path, rows and seconds of each new file; reads the durations of those files only."""
    parts = []
    parquet = sorted(f for kind, f in new if kind == "parquet")
    arrow = sorted(f for kind, f in new if kind == "arrow")
    if parquet:
        written = _parquet_files(spark, out_dir, parquet)
        file = F.col("_metadata.file_path").alias("file")
        parts.append(written.select("split", F.lit("parquet").alias("format"), file, "duration_seconds"))
    if arrow:
        register_arrow_ipc(spark)
        written = (
            spark.read.format(ARROW_FORMAT)
            .option("files", json.dumps(arrow))
            .schema("split string, duration_seconds double, _path string")
            .load(_arrow_folder(spark, out_dir))
        )
        parts.append(written.select("split", F.lit("arrow").alias("format"), F.col("_path").alias("file"), "duration_seconds"))
    schema = T.StructType.fromDDL("split string, format string, file string, duration_seconds double")
    rows = union_rows(spark, parts, schema)
    return rows.groupBy("split", "format", "file").agg(
        F.count("*").alias("rows"),
        F.sum(F.coalesce(F.col("duration_seconds"), F.lit(0.0))).alias("duration_seconds"),
    )


def _speaker_sketches(spark: SparkSession, out_dir: str, new: list[tuple[str, str]]) -> DataFrame:
    """``(split, speakers)``: an HLL sketch of the speaker ids of each split's new rows.

    One format is read (Parquet if written): both hold the same rows.
    """
    parquet = sorted(f for kind, f in new if kind == "parquet")
    arrow = sorted(f for kind, f in new if kind == "arrow")
    if parquet:
        rows = _parquet_files(spark, out_dir, parquet).select("split", "speaker_id")
    elif arrow:
        register_arrow_ipc(spark)
        rows = (
            spark.read.format(ARROW_FORMAT)
            .option("files", json.dumps(arrow))
            .schema("split string, speaker_id string")
            .load(_arrow_folder(spark, out_dir))
        )
    else:
        return spark.createDataFrame([], "split string, speakers binary")
    return rows.groupBy("split").agg(F.hll_sketch_agg("speaker_id", SKETCH_BITS).alias("speakers"))


def speaker_counts(spark: SparkSession, out_dir: str, version: int | None = None) -> DataFrame:
    """``(split, speakers)``: distinct speakers per split by the manifest's sketches, and a row
    ``split`` null for all splits together (a speaker of several splits counts once).

    Estimates: the sketches keep 2^SKETCH_BITS registers, a relative error of about 0.8 %.
    Manifests written before sketches were kept give no rows.
    """
    version = current_version(spark, out_dir) if version is None else version
    if version is None:
        raise FileNotFoundError(f"no manifest under {out_dir}")
    try:
        kept = spark.read.parquet(f"{_version_folder(out_dir, version)}/speakers")
    except AnalysisException:
        return spark.createDataFrame([], "split string, speakers bigint")
    per_split = kept.select("split", F.hll_sketch_estimate("speakers").alias("speakers"))
    together = kept.agg(F.hll_sketch_estimate(F.hll_union_agg("speakers")).alias("speakers"))
    return per_split.unionByName(together.select(F.lit(None).cast("string").alias("split"), "speakers"))


def write_manifest(
    spark: SparkSession,
    folder: str,
    files: DataFrame,
    recipe: Mapping[str, Any],
    include_audio: bool,
    output_format: str = "parquet",
    speakers: DataFrame | None = None,
) -> None:
    """Writes a manifest to ``folder``: ``files`` (one row per data file), ``splits``, ``dataset``.

    ``files`` is a table of its own because file lists grow with the data; ``splits`` and
    ``dataset`` hold one row per split and one row. ``speakers`` (sketches, one per split) is
    written when given.
    """
    if speakers is not None:
        speakers.write.parquet(f"{folder}/speakers")
    files.write.parquet(f"{folder}/files")
    files = spark.read.parquet(f"{folder}/files")
    # Both formats hold the same rows; they count once.
    counted_format = "arrow" if output_format == "arrow" else "parquet"
    counted = files.where(F.col("format") == counted_format)
    seconds = F.coalesce(F.sum("duration_seconds"), F.lit(0.0))
    totals = [
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        seconds.alias("duration_seconds"),
        F.round(seconds / 3600.0, 6).alias("duration_hours"),
    ]
    per_split = counted.groupBy("split").agg(*totals, F.count("*").alias("files"))
    per_split.orderBy("split").coalesce(1).write.json(f"{folder}/splits")
    dataset = counted.agg(*totals).select(
        "*",
        F.lit(include_audio).alias("audio_enabled"),
        F.lit(",".join(CANONICAL_SCHEMA.fieldNames())).alias("canonical_schema"),
        F.lit(json.dumps(recipe, sort_keys=True)).alias("recipe"),
    )
    dataset.coalesce(1).write.json(f"{folder}/dataset")


def read_manifest(spark: SparkSession, out_dir: str, version: int | None = None) -> Materialized:
    """The current manifest of an output, or the named version."""
    version = current_version(spark, out_dir) if version is None else version
    if version is None:
        raise FileNotFoundError(f"no manifest under {out_dir}")
    folder = _version_folder(out_dir, version)
    totals = "rows bigint, duration_seconds double, duration_hours double"
    return Materialized(
        out_dir,
        spark.read.schema(f"split string, {totals}, files bigint").json(f"{folder}/splits"),
        spark.read.parquet(f"{folder}/files"),
        spark.read.schema(
            f"{totals}, audio_enabled boolean, canonical_schema string, recipe string"
        ).json(f"{folder}/dataset"),
    )


def _repointed(recipe: Mapping[str, Any], places: Mapping[str, str]) -> dict[str, Any]:
    """The recipe with the last table vocabulary of each named dataset at its new place."""
    pipeline = [dict(e) for e in _pipeline(recipe)]
    for key, place in places.items():
        for entry in reversed(pipeline):
            if entry.get("dataset_key") == key and entry.get("vocabulary_path"):
                entry["vocabulary_path"] = place
                break
    if not isinstance(recipe.get("filters"), Mapping):
        return dict(recipe)
    return {**recipe, "filters": {**recipe["filters"], "pipeline": pipeline}}


def materialize(
    spark: SparkSession,
    recipe: Mapping[str, Any],
    sources: Mapping[str, Source],
    out_dir: str,
    *,
    filters: Mapping[str, OverlapFilter | VocabularyFilter] | None = None,
    include_audio: bool = False,
    output_format: str = "parquet",
    max_rows_per_file: int = DEFAULT_ROWS_PER_FILE,
    mode: str = "errorifexists",
    rebalance: bool = False,
) -> Materialized:
    """Select, filter, split and write a recipe's rows, then commit a new manifest version.

    Modes act on the current manifest: ``append`` lists its files and the new ones, ``overwrite``
    the new ones only; nothing is deleted, so a run may read the output it replaces. The manifest's
    recipe replays the run: every version keeps its own copy of vocabularies that are tables.
    """
    wanted = _wanted_formats(output_format, max_rows_per_file, mode)
    before = current_version(spark, out_dir)
    held = _manifest_formats(spark, out_dir) if before is not None else formats_of(spark, out_dir)
    if held and mode == "errorifexists":
        raise FileExistsError(f"{out_dir} already holds {' and '.join(sorted(held))} files")
    if held and mode == "ignore":
        return read_manifest(spark, out_dir)
    if held and mode == "append" and held != wanted:
        raise ValueError(f"{out_dir} holds {' and '.join(sorted(held))} files, not {output_format}")
    version = (before or 0) + 1
    replayed = _table_filters(spark, _pipeline(recipe))
    # Written before rows are selected: the filter and the manifest see one table.
    kept = {
        key: replace(config, vocabulary=durable(config.tokens()), top_k=None)
        if isinstance(config, VocabularyFilter)
        else config
        for key, config in {**replayed, **(filters or {})}.items()
    }
    rows = select_rows(spark, recipe, sources, filters=kept, include_audio=include_audio)
    new = write_files(rows, out_dir, wanted, max_rows_per_file, rebalance)
    files = _per_file(spark, out_dir, new)
    speakers = _speaker_sketches(spark, out_dir, new)
    if mode == "append" and before is not None:
        files = read_manifest(spark, out_dir, before).files.unionByName(files)
        try:
            older = spark.read.parquet(f"{_version_folder(out_dir, before)}/speakers")
        except AnalysisException:  # a version without sketches: they cover the new rows only
            older = None
        if older is not None:
            speakers = older.unionByName(speakers).groupBy("split").agg(
                F.hll_union_agg("speakers").alias("speakers")
            )
    pending = f"{out_dir}/_manifest/_pending-{uuid.uuid4().hex}"
    places = {}
    for key, config in kept.items():
        if isinstance(config, VocabularyFilter):
            part = f"vocabulary/dataset_key={quote(key, safe=' ')}"
            config.vocabulary.write.parquet(f"{pending}/{part}")
            places[key] = f"{_version_folder(out_dir, version)}/{part}"
    added = {k: v for k, v in kept.items() if k in (filters or {})}
    recorded = with_filters(
        _repointed(recipe, {k: places[k] for k in replayed if k not in added}), added, places
    )
    write_manifest(spark, pending, files, recorded, include_audio, output_format, speakers)
    _commit(spark, pending, out_dir, version)
    return read_manifest(spark, out_dir, version)
