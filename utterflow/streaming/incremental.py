"""The row-wise steps over a file stream: new files in, split folders out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from utterflow.functions.hashing import target_split
from utterflow.operators.canonical import canonicalize
from utterflow.operators.duplicates import text_digest
from utterflow.operators.filters import OverlapFilter, apply_filter
from utterflow.plans.storage import is_folder
from utterflow.schema import SourceSpec
from utterflow.sources.parquet import scan_columns


def stream_rows(
    spark: SparkSession,
    spec: SourceSpec,
    folder: str,
    schema: T.StructType,
    split: str = "train",
    *,
    root: str | None = None,
    file_glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Canonical rows of the Parquet files that arrive in a folder.

    The same projection as the batch scan: a row gets the same id either way,
    and there is no state to keep.
    """
    reader = spark.readStream.schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = scan_columns(reader.parquet(folder), spec.mapped_columns())
    return canonicalize(rows, spec, split, root=root)


def stream_table(
    spark: SparkSession,
    spec: SourceSpec,
    folder: str,
    name: str,
    schema: T.StructType,
    split: str = "train",
    **options,
) -> DataFrame:
    """``stream_rows`` of the table ``name`` in a folder: one file, or a folder of part files.

    A stream reads folders, so a table of one file is its folder with the name as the glob. Options
    are those of ``stream_rows``.
    """
    path = f"{folder.rstrip('/')}/{name}"
    if is_folder(spark, path):
        return stream_rows(spark, spec, path, schema, split, **options)
    return stream_rows(spark, spec, folder, schema, split, file_glob=name, **options)


def materialize_new_files(
    rows: DataFrame,
    out_dir: str,
    checkpoint: str,
    *,
    config: OverlapFilter | None = None,
    policy: str = "train-val",
    val_ratio: float = 0.1,
    test_ratio: float = 0.1,
    max_rows_per_file: int = 100_000,
    drop_duplicates: bool = False,
) -> StreamingQuery:
    """Filters, splits and appends what arrived since the last run, then stops.

    The file sink's log makes every input file count once across restarts. With
    ``drop_duplicates`` a row goes if its normalised text was written before, in this run or any
    earlier one: the digests written are the state of the query, kept in its checkpoint (on the
    state store the session names; RocksDB keeps it off the heap). Of equal texts within one
    micro-batch one row is written. Rows without a token are not transcripts and all stay.
    """
    kept = apply_filter(rows, config).withColumn(
        "split", target_split(policy, val_ratio, test_ratio)
    )
    if drop_duplicates:
        names = kept.columns
        row_key = F.concat_ws("\x00", F.lit("row"), "dataset_key", "source_split", "record_id")
        kept = (
            kept.withColumn("_d", F.coalesce(text_digest(F.col("text")), row_key))
            .dropDuplicates(["_d"])
            .select(*names)
        )
    return (
        kept.writeStream.format("parquet")
        .partitionBy("split")
        .option("maxRecordsPerFile", max_rows_per_file)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(f"{out_dir}/parquet")
    )
