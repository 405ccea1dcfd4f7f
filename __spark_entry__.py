
from __future__ import annotations

import dataclasses
import json
import os
import re
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from utterflow.functions.text import BLANKS, blank_to_null, normalize_text  # noqa: E402
from utterflow.operators import (  # noqa: E402
    balance,
    duplicates,
    filters,
    overview,
    profiles,
    scripts,
    splits,
)
from utterflow.operators.canonical import canonical_rows, canonicalize, union_sources  # noqa: E402
from utterflow.operators.normalized import add_text_metrics, normalized_rows  # noqa: E402
from utterflow.plans import catalog, materialize  # noqa: E402
from utterflow.plans.storage import durable, new_folder, qualified  # noqa: E402
from utterflow.schema import CANONICAL_SCHEMA, Source, SourceSpec  # noqa: E402
from utterflow.sources.parquet import read_rows, scan_columns  # noqa: E402
from utterflow.sources.vocabulary import read_top_tokens, write_top_tokens  # noqa: E402
from utterflow.streaming.incremental import materialize_new_files, stream_table  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
PIECES = "utterflow.bench.pieces"

# --- sources: how the test tables map onto canonical rows --------------------

DOCUMENTS = SourceSpec(
    key="documents",
    dataset="testdata",
    subset="documents",
    text_column="text",
    record_id_column="doc_id",
    speaker_column="source",
    language_column="lang",
)
CONVERSATIONS = SourceSpec(
    key="conversations",
    dataset="testdata",
    subset="conversations",
    text_column="text",
    speaker_column="role",
    default_language="und",
)
EVENTS = SourceSpec(
    key="events",
    dataset="testdata",
    subset="events",
    text_column="props",
    record_id_column="event_id",
    speaker_column="user_id",
    gender_column="event_type",
    default_language="und",
    duration_column="value",
)
PAGES = SourceSpec(
    key="pages",
    dataset="testdata",
    subset="pages",
    text_column="html",
    record_id_column="page_id",
    default_language="und",
    audio_column="url",
)
# One source of several splits, whose tables have different columns: what a
# split's table lacks is null there.
MIXED = SourceSpec(
    key="mixed",
    dataset="testdata",
    subset="mixed",
    text_column="text",
    speaker_column="role",
    language_column="lang",
    default_language="und",
    unexported_splits=("unlabeled",),
)


def _documents(sf: str) -> Source:
    return Source(DOCUMENTS, {"train": f"{sf}/documents.parquet"}, root=sf)


def _conversations(sf: str) -> Source:
    return Source(CONVERSATIONS, {"train": f"{sf}/conversations.parquet"}, root=sf)


def _events(sf: str) -> Source:
    return Source(EVENTS, {"train": f"{sf}/events.parquet"}, root=sf)


def _pages(sf: str) -> Source:
    return Source(PAGES, {"train": f"{sf}/pages.parquet"}, root=sf)


def _mixed(sf: str) -> Source:
    files = {
        "train": [f"{sf}/documents.parquet", f"{sf}/documents.parquet"],  # listed twice, read once
        "validation": f"{sf}/conversations.parquet",
        "unlabeled": f"{sf}/benchmark.parquet",
    }
    return Source(MIXED, files, root=sf)


def _three(sf: str) -> list[Source]:
    return [_documents(sf), _conversations(sf), _events(sf)]


def _union(spark: SparkSession, sf: str) -> DataFrame:
    return union_sources(spark, _three(sf))


def _docs(spark: SparkSession, sf: str, **options) -> DataFrame:
    return canonical_rows(spark, _documents(sf), **options)


def _dealt(rows: DataFrame) -> DataFrame:
    """For the local bench, whose documents are one row group: over all cores if it asks for it."""
    pieces = rows.sparkSession.conf.get(PIECES, None)
    return rows.repartition(int(pieces)) if pieces else rows


# --- queries -----------------------------------------------------------------


def prepare_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Keep documents that their own 200 most frequent words cover to a fifth, split, total."""
    docs = _dealt(_docs(spark, sf, provenance=True))
    words = profiles.token_frequency(docs, 200)
    kept = filters.filter_by_vocabulary(docs, words, 0.2)
    return splits.split_summary(splits.assign_split(kept, "train-val-test", 0.1, 0.1))


def filter_vocab_overlap(spark: SparkSession, sf: str) -> DataFrame:
    docs = _dealt(_docs(spark, sf, provenance=True))
    words = profiles.token_frequency(docs, 500)
    kept = filters.filter_by_vocabulary(docs, words, 0.5, min_tokens=5)
    return kept.select("record_id", "text")


def _frequent_words(docs: DataFrame) -> DataFrame:
    return durable(profiles.token_counts(docs).where("cnt >= 3").select("token"))


def filter_vocab_join(spark: SparkSession, sf: str) -> DataFrame:
    docs = _dealt(_docs(spark, sf, provenance=True))
    kept = filters.join_overlap(docs, _frequent_words(docs), 0.98)
    return kept.select("record_id", "text")


def filter_vocab_join_salted(spark: SparkSession, sf: str) -> DataFrame:
    docs = _docs(spark, sf, provenance=True)
    kept = filters.join_overlap(docs, _frequent_words(docs), 0.98, broadcast_bytes=0)
    return kept.select("record_id", "text")


def _config_table(spark: SparkSession, sf: str) -> DataFrame:
    """Two configs for documents, of which the second counts, and one for conversations."""

    def frequent(source, k):
        words = profiles.token_frequency(canonical_rows(spark, source), k)
        return words.agg(F.collect_set("token").alias("vocabulary"))

    def config(order, key, words, ratio, least, most):
        return words.select(
            F.lit(order).alias("ord"),
            F.lit(key).alias("dataset_key"),
            "vocabulary",
            F.lit(ratio).alias("min_overlap_ratio"),
            F.lit(least).alias("min_tokens"),
            F.lit(most).cast("int").alias("max_tokens"),
        )

    superseded = spark.range(1).select(F.array(F.lit("the")).alias("vocabulary"))
    return (
        config(1, "documents", superseded, 0.9, 1, None)
        .unionByName(config(2, "documents", frequent(_documents(sf), 200), 0.3, 2, 400))
        .unionByName(config(3, "conversations", frequent(_conversations(sf), 100), 0.4, 1, None))
    )


def filter_vocab_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """The same words as a literal set and as a table that is joined, with what tells the two."""
    docs = _docs(spark, sf, provenance=True)
    words = durable(profiles.token_frequency(docs, 200))

    def kept(form, literal_tokens):
        rows = filters.filter_by_vocabulary(docs, words, 0.2, literal_tokens=literal_tokens)
        return rows.select(F.lit(form).alias("form"), "record_id")

    return kept("literal", 200).unionByName(kept("joined", 0))


def filter_config_lookup(spark: SparkSession, sf: str) -> DataFrame:
    rows = _dealt(union_sources(spark, _three(sf), provenance=True))
    kept = filters.filter_by_config_table(rows, _config_table(spark, sf))
    return kept.select("dataset_key", "record_id", "text")


def filter_config_lookup_join(spark: SparkSession, sf: str) -> DataFrame:
    rows = union_sources(spark, _three(sf), provenance=True)
    kept = filters.filter_by_config_table(rows, _config_table(spark, sf), literal_tokens=0)
    return kept.select("dataset_key", "record_id", "text")


def _recipe(spark: SparkSession, sf: str) -> dict:
    recipe = catalog.draft_recipe(spark, _three(sf), policy="train-val-test")
    recipe["filters"]["pipeline"] = [
        {"type": "unknown", "dataset_key": "events", "min_text_tokens": 1000},
        {
            "type": filters.FILTER_TYPE,
            "dataset_key": "conversations",
            "min_text_tokens": 5,
            "max_text_tokens": 60,
        },
    ]
    return recipe


def _materialized(spark: SparkSession, sf: str, output_format: str) -> materialize.Materialized:
    words = profiles.token_frequency(_docs(spark, sf), 500)
    return materialize.materialize(
        spark,
        _recipe(spark, sf),
        {s.spec.key: s for s in _three(sf)},
        new_folder(spark, "materialized"),
        filters={"documents": materialize.VocabularyFilter(words, 0.5)},
        output_format=output_format,
        max_rows_per_file=5000,
    )


def materialize_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return materialize.reload(spark, _materialized(spark, sf, "parquet").out_dir)


def materialize_arrow_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    return materialize.reload(spark, _materialized(spark, sf, "arrow").out_dir)


def materialize_manifest(spark: SparkSession, sf: str) -> DataFrame:
    done = _materialized(spark, sf, "both")
    return done.splits.select(
        "split", "rows", F.round("duration_seconds", 4).alias("duration_seconds"),
        F.round("duration_hours", 5).alias("duration_hours"),
    )


def materialize_append_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs that append to one output in both formats; the Arrow side comes back."""
    out = new_folder(spark, "appended")
    sources = {s.spec.key: s for s in _three(sf)}
    for _ in range(2):
        materialize.materialize(
            spark, _recipe(spark, sf), sources, out, output_format="both", mode="append"
        )
    files = materialize.read_manifest(spark, out).files
    total = lambda name: files.where(F.col("format") == name).agg(F.sum("rows")).scalar()
    arrow = spark.read.format("arrow_ipc").load(qualified(spark, f"{out}/arrow"))
    counted = arrow.groupBy("dataset_key", "split").agg(F.count("*").alias("rows"))
    return counted.withColumns({"parquet": total("parquet"), "arrow": total("arrow")})


def materialize_replay(spark: SparkSession, sf: str) -> DataFrame:
    """The recipe of a manifest, whose vocabulary is a table beside it, run again."""
    first = _materialized(spark, sf, "parquet")
    recipe = json.loads(first.totals.first()["recipe"])
    sources = {s.spec.key: s for s in _three(sf)}
    again = materialize.materialize(spark, recipe, sources, new_folder(spark, "replayed"))
    return materialize.reload(spark, again.out_dir)


def materialize_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Reload after three runs into one folder: the first, its recipe replayed in place with
    ``overwrite`` (version 2, its own copy of the vocabulary), and an append that breaks off after
    writing its files, before its manifest. Only the files of version 2 are read."""
    first = _materialized(spark, sf, "parquet")
    out = first.out_dir
    recipe = json.loads(first.totals.first()["recipe"])
    sources = {s.spec.key: s for s in _three(sf)}
    materialize.materialize(
        spark, recipe, sources, out, mode="overwrite", max_rows_per_file=5000
    )
    broken = materialize.select_rows(spark, recipe, sources)
    materialize.write_files(broken, out, {"parquet"}, 5000, False)
    return materialize.reload(spark, out)


SPEAKER_CAP = 50


def speaker_cap(spark: SparkSession, sf: str) -> DataFrame:
    """At most SPEAKER_CAP rows per speaker over all sources (documents have one per source)."""
    capped = balance.capped_per_group(_union(spark, sf), SPEAKER_CAP, "speaker_id")
    return capped.select("dataset_key", "source_split", "record_id", "speaker_id")


def gender_balance(spark: SparkSession, sf: str) -> DataFrame:
    """Events, every gender (event type) cut to the size of the rarest, by the hash of record ids."""
    kept = balance.balanced_groups(canonical_rows(spark, _events(sf)), "gender")
    return kept.select("dataset_key", "source_split", "record_id", "gender")


def script_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of all sources whose letters are at least half Latin."""
    kept = scripts.by_script(_union(spark, sf), "Latin", 0.5)
    return kept.select("dataset_key", "source_split", "record_id", "n_letters", "n_script")


def duplicate_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of all sources without an equal normalised text before them by record id."""
    kept = duplicates.first_transcripts(_union(spark, sf))
    return kept.select("dataset_key", "source_split", "record_id")


def normalized_sample(spark: SparkSession, sf: str) -> DataFrame:
    """The first rows of two splits in the training view."""
    rows = normalized_rows(spark, _mixed(sf), ["train", "validation"], sample_size=300)
    return rows.select("source_split", "record_id", "language", "text")


def normalize_text_compatibility(spark: SparkSession, sf: str) -> DataFrame:
    """Texts with compatibility characters for plain ones: NFKC gives the plain ones back."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    text = F.translate(F.col("text"), " 1aT", "\u00a0\u2460\uff41\uff34")
    return docs.select("doc_id", normalize_text(F.replace(text, F.lit("fi"), F.lit("\ufb01"))).alias("text"))


def coerced_durations(spark: SparkSession, sf: str) -> DataFrame:
    """Durations as text, a part of which is none: they count as missing."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    broken = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("x"), F.col("value")))
    value = F.coalesce(broken, F.when(F.col("event_id") % 5 == 0, "NaN"), F.col("value").cast("string"))
    found = overview.duration_summary(events.select(value.alias("duration_seconds")))
    return found.withColumn("mean_seconds", F.round("mean_seconds", 6))


def null_texts(spark: SparkSession, sf: str) -> DataFrame:
    """A third of the texts missing, a third blank: filters drop them, profiles count them."""
    docs = _docs(spark, sf)
    number = F.col("record_id").cast("long") % 3
    texts = docs.withColumn("text", blank_to_null(F.when(number == 1, F.lit(" \u3000")).when(number == 2, F.col("text"))))
    kept = filters.apply_filter(texts, filters.OverlapFilter())
    counted = kept.agg(F.count("*")).scalar()
    return profiles.text_length_profile(texts).withColumn("kept_rows", counted)


def audio_struct_column(spark: SparkSession, sf: str) -> DataFrame:
    """Audio that is a struct with its fields in another order, and one more."""
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    audio = F.struct(F.col("url").alias("path"), F.lit(1).alias("rate"), F.col("html").cast("binary").alias("bytes"))
    rows = scan_columns(pages.select("*", audio.alias("audio"), "_metadata"), ["page_id", "html", "audio"])
    spec = dataclasses.replace(PAGES, audio_column="audio")
    found = canonicalize(rows, spec, "train", root=sf, include_audio=True)
    return found.select(
        "record_id",
        F.col("audio.path").alias("audio_path"),
        F.octet_length("audio.bytes").cast("long").alias("audio_bytes"),
    )


def inspect_report(spark: SparkSession, sf: str) -> DataFrame:
    found = catalog.inspect_report(spark, [*_three(sf), _mixed(sf)], sample_size=700, preview_rows=3)
    return found.select(
        "dataset_key",
        "source_split",
        "rows_sampled",
        "available_splits",
        F.col("column_mapping")["speaker_id"].alias("speaker_column"),
        F.array_join(F.transform("preview", lambda r: r["record_id"]), ",").alias("preview_ids"),
    )


def vocabulary_report(spark: SparkSession, sf: str) -> DataFrame:
    """Frequencies written as a JSON report, read back as a vocabulary of 300."""
    path = new_folder(spark, "report")
    write_top_tokens(profiles.token_frequency(_docs(spark, sf), 500), path)
    return read_top_tokens(spark, path, 300)


def stream_documents(spark: SparkSession, sf: str) -> DataFrame:
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    rows = stream_table(spark, DOCUMENTS, sf, "documents.parquet", schema, root=sf)
    out = new_folder(spark, "stream")
    config = filters.OverlapFilter(min_tokens=20, max_tokens=2000)
    materialize_new_files(rows, out, f"{out}/_checkpoint", config=config).awaitTermination()
    return materialize.reload(spark, out)


def stream_first_transcripts(spark: SparkSession, sf: str) -> DataFrame:
    """The documents' stream with duplicate texts dropped by the query's state: one row per
    normalised text, every row without a token."""
    schema = spark.read.parquet(f"{sf}/documents.parquet").schema
    rows = stream_table(spark, DOCUMENTS, sf, "documents.parquet", schema, root=sf)
    out = new_folder(spark, "stream")
    materialize_new_files(rows, out, f"{out}/_checkpoint", drop_duplicates=True).awaitTermination()
    written = materialize.reload(spark, out)
    return written.select("dataset_key", duplicates.text_digest(F.col("text")).alias("digest"))


def audio_struct(spark: SparkSession, sf: str) -> DataFrame:
    rows = canonical_rows(spark, _pages(sf), include_audio=True)
    return rows.select(
        "record_id",
        F.col("audio.path").alias("audio_path"),
        F.col("audio.bytes").isNull().alias("no_bytes"),
    )


def positional_record_id(spark: SparkSession, sf: str) -> DataFrame:
    """Two files in one split: the index runs on from the first into the second."""
    files = {"train": [f"{sf}/documents.parquet", f"{sf}/conversations.parquet"]}
    rows = normalized_rows(spark, Source(MIXED, files, root=sf))
    return rows.select("record_id", "language", "text_source_column")


def limited_read(spark: SparkSession, sf: str) -> DataFrame:
    return read_rows(spark, f"{sf}/doc*.parquet", ["doc_id", "lang", "absent"], 250)


def catalog_split_counts(spark: SparkSession, sf: str) -> DataFrame:
    listed = catalog.source_catalog(spark, [*_three(sf), _mixed(sf)])
    return listed.withColumn("text_column", F.col("column_mapping")["text"]).drop("column_mapping")


def export_split_rows(spark: SparkSession, sf: str) -> DataFrame:
    mixed = _mixed(sf)
    rows = catalog.exported_rows(canonical_rows(spark, mixed), [mixed])
    return rows.select("source_split", "record_id", "speaker_id", "language")


def duration_summary_median(spark: SparkSession, sf: str) -> DataFrame:
    found = overview.duration_summary(_union(spark, sf))
    return found.withColumn("mean_seconds", F.round("mean_seconds", 6))


def metadata_overview(spark: SparkSession, sf: str) -> DataFrame:
    found = overview.metadata_overview(_union(spark, sf))
    return found.withColumn("duration_mean_seconds", F.round("duration_mean_seconds", 6))


def _assigned(spark: SparkSession, sf: str, policy: str) -> DataFrame:
    rows = splits.assign_split(_union(spark, sf), policy, 0.15, 0.1)
    return rows.select("dataset_key", "record_id", "split")


def _rounded(totals: DataFrame) -> DataFrame:
    return totals.withColumn("duration_seconds", F.round("duration_seconds", 4)).withColumn(
        "duration_hours", F.round("duration_hours", 5)
    )


def normalize_text_nfkc(spark: SparkSession, sf: str) -> DataFrame:
    return normalized_rows(spark, _documents(sf)).select("record_id", "text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "prepare_documents": prepare_documents,
    "canonicalize_documents": _docs,
    "canonicalize_events": lambda s, d: canonical_rows(s, _events(d)),
    "derived_record_id": lambda s, d: canonical_rows(s, _conversations(d)),
    "union_all_sources": _union,
    "limited_read": limited_read,
    "audio_struct": audio_struct,
    "observed_schema": lambda s, d: profiles.observed_schema(_union(s, d)),
    "token_frequency_top20": lambda s, d: profiles.token_frequency(_dealt(_docs(s, d))),
    "token_frequency_top50": lambda s, d: profiles.token_frequency(_dealt(_union(s, d)), 50),
    "token_frequency_first_seen": lambda s, d: profiles.token_frequency(
        _dealt(_docs(s, d, provenance=True)), 300, ties="first_seen"
    ),
    "text_length_profile": lambda s, d: profiles.text_length_profile(_dealt(_union(s, d))),
    "text_metrics": lambda s, d: add_text_metrics(_docs(s, d)).select(
        "record_id", "char_count", "word_count", "is_empty_text"
    ),
    "gender_distribution": lambda s, d: profiles.gender_distribution(_union(s, d)),
    "gender_breakdown": lambda s, d: overview.gender_breakdown(_union(s, d)).withColumn(
        "share", F.round("share", 6)
    ),
    "duration_profile": lambda s, d: profiles.duration_profile(_union(s, d)),
    "duration_summary_median": duration_summary_median,
    "metadata_overview": metadata_overview,
    "split_train_val": lambda s, d: _assigned(s, d, "train-val"),
    "split_train_val_test": lambda s, d: _assigned(s, d, "train-val-test"),
    "split_preserve": lambda s, d: splits.assign_split(
        canonical_rows(s, _mixed(d)), "preserve"
    ).select("record_id", "split"),
    "split_summary": lambda s, d: _rounded(
        splits.split_summary(splits.assign_split(_union(s, d), "train-val-test", 0.15, 0.1))
    ),
    "split_totals": lambda s, d: _rounded(splits.split_totals(_union(s, d))),
    "filter_token_bounds": lambda s, d: filters.apply_filter(
        _dealt(_docs(s, d)), filters.OverlapFilter(min_tokens=50, max_tokens=300)
    ).select("record_id", "text"),
    "filter_vocab_overlap": filter_vocab_overlap,
    "filter_vocab_sizes": filter_vocab_sizes,
    "filter_vocab_join": filter_vocab_join,
    "filter_vocab_join_salted": filter_vocab_join_salted,
    "filter_config_lookup": filter_config_lookup,
    "filter_config_lookup_join": filter_config_lookup_join,
    "vocabulary_report": vocabulary_report,
    "sample_prefix": lambda s, d: _docs(s, d, sample_size=600).select("record_id", "text"),
    "materialize_append_roundtrip": materialize_append_roundtrip,
    "materialize_replay": materialize_replay,
    "materialize_versions": materialize_versions,
    "speaker_cap": speaker_cap,
    "gender_balance": gender_balance,
    "script_filter": script_filter,
    "duplicate_transcripts": duplicate_transcripts,
    "normalized_sample": normalized_sample,
    "normalize_text_compatibility": normalize_text_compatibility,
    "coerced_durations": coerced_durations,
    "null_texts": null_texts,
    "audio_struct_column": audio_struct_column,
    "inspect_report": inspect_report,
    "preview": lambda s, d: catalog.preview(s, _conversations(d), "train"),
    "inspect_counts": lambda s, d: catalog.inspect_sources(
        s, [*_three(d), _mixed(d)], sample_size=700
    ),
    "catalog_split_counts": catalog_split_counts,
    "export_split_rows": export_split_rows,
    "positional_record_id": positional_record_id,
    "normalize_text_nfkc": normalize_text_nfkc,
    "materialize_roundtrip": materialize_roundtrip,
    "materialize_arrow_roundtrip": materialize_arrow_roundtrip,
    "materialize_manifest": materialize_manifest,
    "stream_documents": stream_documents,
    "stream_first_transcripts": stream_first_transcripts,
}


# The training-data operators and their pipeline can be left out of an installation.
try:
    import corpus_pipeline
    from utterflow.llm.queries import ORACLE as LLM_ORACLE
    from utterflow.llm.queries import QUERIES as LLM_QUERIES
except ModuleNotFoundError as missing:
    if not re.fullmatch(r"corpus_pipeline|utterflow\.llm(\.queries)?", missing.name or ""):
        raise
    LLM_QUERIES, LLM_ORACLE = {}, {}
else:
    LLM_QUERIES = LLM_QUERIES | {"pipeline": corpus_pipeline.run}


def entry(spark: SparkSession) -> DataFrame:
    return prepare_documents(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One entry per operator; each callable takes (spark, sf_dir)."""
    return QUERIES | LLM_QUERIES


# --- the same in SQL ---------------------------------------------------------

_BLANK_SET = "||".join(f"chr({ord(c)})" for c in BLANKS)
_BLANK_RUN = "[" + "".join(rf"\x{{{ord(c):x}}}" for c in BLANKS) + "]+"
_NULL = "CAST(NULL AS VARCHAR)"


def _strip(column: str) -> str:
    return f"nullif(trim(CAST({column} AS VARCHAR), {_BLANK_SET}), '')"


def _tokens(column: str = "text") -> str:
    pieces = f"string_split_regex(lower({column}), '{_BLANK_RUN}')"
    return f"list_filter({pieces}, lambda t: t <> '')"


def _derived(key: str, file: str, row: str) -> str:
    return f"'derived:' || substr(sha1('{key}|{file}|' || CAST({row} AS VARCHAR)), 1, 16)"


def _canonical(subset, key, split, table, record_id, speaker, gender, language, text, duration):
    return f"""SELECT 'testdata' AS source_dataset, '{subset}' AS source_subset,
 '{split}' AS source_split, '{key}' AS dataset_key, {record_id} AS record_id,
 {speaker} AS speaker_id, {gender} AS gender, {language} AS language,
 {_strip(text)} AS text, {duration} AS duration_seconds FROM {table}"""


# The conversations file is in (conv_id, turn) order, the documents and
# benchmark files in id order: that gives SQL the row index.
_TURNS = "(SELECT *, row_number() OVER (ORDER BY conv_id, turn) - 1 AS i FROM conversations)"
_ITEMS = "(SELECT *, row_number() OVER (ORDER BY item_id) - 1 AS i FROM benchmark)"
_NO_DURATION = "CAST(NULL AS DOUBLE)"

_DOCS = _canonical(
    "documents", "documents", "train", "documents", "CAST(doc_id AS VARCHAR)",
    _strip("source"), _NULL, _strip("lang"), "text", _NO_DURATION,
)
_CONVS = _canonical(
    "conversations", "conversations", "train", _TURNS,
    _derived("conversations", "conversations.parquet", "i"),
    _strip("role"), _NULL, "'und'", "text", _NO_DURATION,
)
_EVENTS = _canonical(
    "events", "events", "train", "events", "CAST(event_id AS VARCHAR)",
    _strip("user_id"), _strip("event_type"), "'und'", "props", "CAST(value AS DOUBLE)",
)
_MIXED = " UNION ALL ".join(
    [
        _canonical(
            "mixed", "mixed", "train", "documents",
            _derived("mixed", "documents.parquet", "doc_id"),
            _NULL, _NULL, _strip("lang"), "text", _NO_DURATION,
        ),
        _canonical(
            "mixed", "mixed", "validation", _TURNS,
            _derived("mixed", "conversations.parquet", "i"),
            _strip("role"), _NULL, _NULL, "text", _NO_DURATION,
        ),
        _canonical(
            "mixed", "mixed", "unlabeled", _ITEMS,
            _derived("mixed", "benchmark.parquet", "i"),
            _NULL, _NULL, _NULL, "text", _NO_DURATION,
        ),
    ]
)
_UNION = f"{_DOCS} UNION ALL {_CONVS} UNION ALL {_EVENTS}"
_WITH_DOCS = f"WITH docs AS ({_DOCS})"
_WITH_ALL = f"WITH rows_ AS ({_UNION})"
_CANONICAL_NAMES = ", ".join(CANONICAL_SCHEMA.fieldNames())


def _bucket() -> str:
    return "CAST(('0x' || substr(sha1(record_id), 1, 8)) AS BIGINT)::DOUBLE / 4294967295::DOUBLE"


def _split_label(val: float, test: float) -> str:
    b = _bucket()
    return f"""CASE WHEN {test} > 0 AND {b} < {test}::DOUBLE THEN 'test'
 WHEN ({b} - {test}::DOUBLE) / (1::DOUBLE - {test}::DOUBLE) < {val}::DOUBLE THEN 'validation'
 ELSE 'train' END"""


def _top(table: str, k: int) -> str:
    return f"""SELECT token, count(*) AS cnt FROM
 (SELECT unnest({_tokens()}) AS token FROM {table}) GROUP BY token
 ORDER BY cnt DESC, token LIMIT {k}"""


def _share(vocabulary: str, tokens: str = "w") -> str:
    """Share of a row's tokens (list ``w``) that are in a vocabulary list."""
    hits = f"len(list_filter({tokens}, lambda t: list_contains({vocabulary}, t)))"
    return f"{hits}::DOUBLE / len({tokens})::DOUBLE"


def _covered(word_source: str, ratio: float, least: int = 1, columns: str = "record_id, text"):
    """Documents whose tokens the words of ``word_source`` cover to a share."""
    return f"""{_WITH_DOCS}, words AS ({word_source}),
 hit AS (SELECT d.record_id, count(*) AS n, count(w.token) AS hits
 FROM (SELECT record_id, unnest({_tokens()}) AS token FROM docs) d
 LEFT JOIN words w ON d.token = w.token GROUP BY d.record_id)
 SELECT {columns} FROM docs JOIN hit USING (record_id)
 WHERE n >= {least} AND hits::DOUBLE / n::DOUBLE >= {ratio}::DOUBLE"""


_TOTALS = """count(*) AS rows,
 round(sum(coalesce(duration_seconds, 0)), 4) AS duration_seconds,
 round(round(sum(coalesce(duration_seconds, 0)) / 3600, 6), 5) AS duration_hours"""

_CONFIGURED = f"""{_WITH_ALL}, t AS (SELECT *, {_tokens()} AS w FROM rows_),
 dv AS (SELECT list(token) AS v FROM ({_top("(SELECT * FROM rows_ WHERE dataset_key = 'documents')", 200)})),
 cv AS (SELECT list(token) AS v FROM ({_top("(SELECT * FROM rows_ WHERE dataset_key = 'conversations')", 100)}))
 SELECT dataset_key, record_id, text FROM t, dv, cv WHERE
 CASE dataset_key WHEN 'documents' THEN text IS NOT NULL AND len(w) BETWEEN 2 AND 400
 AND {_share("dv.v")} >= 0.3::DOUBLE
 WHEN 'conversations' THEN text IS NOT NULL AND {_share("cv.v")} >= 0.4::DOUBLE
 ELSE TRUE END"""

_SELECTED = f"""WITH docs AS ({_DOCS}), words AS ({_top("docs", 500)}),
 hit AS (SELECT d.record_id, count(*) AS n, count(w.token) AS hits
 FROM (SELECT record_id, unnest({_tokens()}) AS token FROM docs) d
 LEFT JOIN words w ON d.token = w.token GROUP BY d.record_id),
 kept AS (SELECT {_CANONICAL_NAMES} FROM docs JOIN hit USING (record_id)
 WHERE hits::DOUBLE / n::DOUBLE >= 0.5::DOUBLE
 UNION ALL SELECT {_CANONICAL_NAMES} FROM ({_CONVS}) WHERE len({_tokens()}) BETWEEN 5 AND 60
 UNION ALL {_EVENTS}),
 assigned AS (SELECT *, {_split_label(0.1, 0.1)} AS split FROM kept)"""

_OVERLAP_JOINED = _covered(
    f"""SELECT token FROM (SELECT unnest({_tokens()}) AS token FROM docs)
 GROUP BY token HAVING count(*) >= 3""",
    0.98,
)


def _catalog_row(key: str, split: str, table: str, exported: str, only: str, text: str) -> str:
    return f"""SELECT '{key}' AS dataset_key, 'testdata' AS source_dataset,
 '{key}' AS source_subset, '{split}' AS source_split, count(*) AS rows,
 {exported} AS exported, {only} AS train_only, '{text}' AS text_column FROM {table}"""


def _inspected(key: str, split: str, table: str, splits_: str) -> str:
    return f"""SELECT '{key}' AS dataset_key, 'testdata' AS source_dataset,
 '{key}' AS source_subset, '{split}' AS source_split, least(count(*), 700) AS rows_sampled,
 '{splits_}' AS available_splits FROM {table}"""


def _observed(name: str, kind: str) -> str:
    return f"""SELECT count(*) AS rows, '{name}' AS field,
 CASE WHEN count({name}) > 0 THEN '{kind}' END AS observed_type,
 count({name}) AS non_null_rows FROM rows_"""


_MIXED_SPLITS = "train,unlabeled,validation"

ORACLE: dict[str, str] = {
    "prepare_documents": f"""WITH kept AS ({
        _covered(_top("docs", 200), 0.2, columns="*")
    }) SELECT split, count(*) AS rows,
 0::DOUBLE AS duration_seconds, 0::DOUBLE AS duration_hours
 FROM (SELECT *, {_split_label(0.1, 0.1)} AS split FROM kept) GROUP BY split""",
    "canonicalize_documents": _DOCS,
    "canonicalize_events": _EVENTS,
    "derived_record_id": _CONVS,
    "union_all_sources": _UNION,
    "limited_read": "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 250",
    "audio_struct": """SELECT CAST(page_id AS VARCHAR) AS record_id, url AS audio_path,
 TRUE AS no_bytes FROM pages""",
    "observed_schema": f"{_WITH_ALL} "
    + " UNION ALL ".join(
        _observed(f.name, profiles.TYPE_NAMES[f.dataType.simpleString()]) for f in CANONICAL_SCHEMA
    ),
    "token_frequency_top20": f"{_WITH_DOCS} {_top('docs', 20)}",
    "token_frequency_top50": f"{_WITH_ALL} {_top('rows_', 50)}",
    "token_frequency_first_seen": f"""{_WITH_DOCS},
 placed AS (SELECT CAST(record_id AS BIGINT) AS i, unnest({_tokens()}) AS token,
 generate_subscripts({_tokens()}, 1) AS pos FROM docs)
 SELECT token, count(*) AS cnt FROM placed GROUP BY token
 ORDER BY cnt DESC, min(i * 10000000 + pos) LIMIT 300""",
    "text_length_profile": f"""{_WITH_ALL},
 n AS (SELECT CASE WHEN text IS NOT NULL THEN len({_tokens()}) END AS n FROM rows_)
 SELECT count(*) AS rows, count(n) AS count_with_text, min(n) AS min_tokens,
 max(n) AS max_tokens, round(avg(n), 4) AS mean_tokens FROM n""",
    "text_metrics": f"""{_WITH_DOCS} SELECT record_id, length(coalesce(text, '')) AS char_count,
 len({_tokens("coalesce(text, '')")}) AS word_count, coalesce(text, '') = '' AS is_empty_text
 FROM docs""",
    "gender_distribution": f"""{_WITH_ALL} SELECT coalesce(gender, '<missing>') AS gender,
 count(*) AS rows FROM rows_ GROUP BY 1""",
    "gender_breakdown": f"""{_WITH_ALL} SELECT coalesce(gender, 'UNKNOWN') AS gender,
 count(*) AS rows, round(count(*)::DOUBLE / (SELECT count(*) FROM rows_), 6) AS share
 FROM rows_ GROUP BY 1""",
    "duration_profile": f"""{_WITH_ALL} SELECT count(*) AS rows,
 count(duration_seconds) AS count_with_duration, min(duration_seconds) AS min_seconds,
 max(duration_seconds) AS max_seconds, round(avg(duration_seconds), 4) AS mean_seconds
 FROM rows_""",
    "duration_summary_median": f"""{_WITH_ALL} SELECT
 count(duration_seconds) AS rows_with_duration, min(duration_seconds) AS min_seconds,
 median(duration_seconds) AS median_seconds, round(avg(duration_seconds), 6) AS mean_seconds,
 max(duration_seconds) AS max_seconds FROM rows_""",
    "metadata_overview": f"""{_WITH_ALL} SELECT count(*) AS rows,
 count(*) FILTER (WHERE coalesce(text, '') = '') AS empty_text_rows,
 count(DISTINCT speaker_id) AS unique_speakers, count(gender) AS known_gender_rows,
 count(duration_seconds) AS duration_rows,
 round(avg(duration_seconds), 6) AS duration_mean_seconds FROM rows_""",
    "split_train_val": f"""{_WITH_ALL} SELECT dataset_key, record_id,
 {_split_label(0.15, 0.0)} AS split FROM rows_""",
    "split_train_val_test": f"""{_WITH_ALL} SELECT dataset_key, record_id,
 {_split_label(0.15, 0.1)} AS split FROM rows_""",
    "split_preserve": f"SELECT record_id, source_split AS split FROM ({_MIXED})",
    "split_summary": f"""{_WITH_ALL} SELECT split, {_TOTALS}
 FROM (SELECT *, {_split_label(0.15, 0.1)} AS split FROM rows_) GROUP BY split""",
    "split_totals": f"{_WITH_ALL} SELECT {_TOTALS} FROM rows_",
    "filter_token_bounds": f"""{_WITH_DOCS} SELECT record_id, text FROM docs
 WHERE text IS NOT NULL AND len({_tokens()}) BETWEEN 50 AND 300""",
    "filter_vocab_overlap": _covered(_top("docs", 500), 0.5, 5),
    "filter_vocab_sizes": f"""SELECT form, record_id FROM ({
        _covered(_top("docs", 200), 0.2, columns="record_id")
    }), (VALUES ('literal'), ('joined')) forms(form)""",
    "filter_vocab_join": _OVERLAP_JOINED,
    "filter_vocab_join_salted": _OVERLAP_JOINED,
    "filter_config_lookup": _CONFIGURED,
    "filter_config_lookup_join": _CONFIGURED,
    "vocabulary_report": f"""{_WITH_DOCS} SELECT CAST(row_number() OVER
 (ORDER BY cnt DESC, token) - 1 AS INTEGER) AS rank, token FROM ({_top("docs", 300)})""",
    "sample_prefix": f"""{_WITH_DOCS} SELECT record_id, text FROM docs
 ORDER BY CAST(record_id AS BIGINT) LIMIT 600""",
    "materialize_append_roundtrip": f"""WITH kept AS (SELECT {_CANONICAL_NAMES} FROM ({_DOCS})
 UNION ALL SELECT {_CANONICAL_NAMES} FROM ({_CONVS}) WHERE len({_tokens()}) BETWEEN 5 AND 60
 UNION ALL {_EVENTS}),
 twice AS (SELECT *, {_split_label(0.1, 0.1)} AS split FROM kept, range(2))
 SELECT dataset_key, split, count(*) AS rows, (SELECT count(*) FROM twice) AS parquet,
 (SELECT count(*) FROM twice) AS arrow FROM twice GROUP BY dataset_key, split""",
    "materialize_replay": f"{_SELECTED} SELECT * FROM assigned",
    "materialize_versions": f"{_SELECTED} SELECT * FROM assigned",
    "duplicate_transcripts": f"""{_WITH_ALL}, k AS (SELECT *, CASE WHEN len({_tokens()}) > 0
 THEN sha256(array_to_string({_tokens()}, ' ')) END AS d FROM rows_)
 SELECT dataset_key, source_split, record_id FROM (SELECT *, row_number() OVER (PARTITION BY d
 ORDER BY record_id NULLS FIRST, dataset_key NULLS FIRST, source_split NULLS FIRST) AS r FROM k)
 WHERE d IS NULL OR r = 1""",
    "script_filter": rf"""{_WITH_ALL} SELECT dataset_key, source_split, record_id, n_letters, n_script
 FROM (SELECT *, len(regexp_extract_all(coalesce(text, ''), '\p{{L}}')) AS n_letters,
 len(regexp_extract_all(coalesce(text, ''), '\p{{Latin}}')) AS n_script FROM rows_)
 WHERE n_letters > 0 AND n_script >= 0.5 * n_letters""",
    "gender_balance": f"""WITH rows_ AS ({_EVENTS}),
 c AS (SELECT min(n) AS k FROM (SELECT count(*) AS n FROM rows_ GROUP BY gender))
 SELECT dataset_key, source_split, record_id, gender FROM
 (SELECT *, row_number() OVER (PARTITION BY gender ORDER BY sha1(record_id) NULLS FIRST,
 record_id NULLS FIRST, dataset_key NULLS FIRST, source_split NULLS FIRST) AS r FROM rows_), c
 WHERE r <= k""",
    "speaker_cap": f"""{_WITH_ALL} SELECT dataset_key, source_split, record_id, speaker_id FROM
 (SELECT *, row_number() OVER (PARTITION BY speaker_id ORDER BY sha1(record_id) NULLS FIRST,
 record_id NULLS FIRST, dataset_key NULLS FIRST, source_split NULLS FIRST) AS r FROM rows_)
 WHERE r <= {SPEAKER_CAP}""",
    "normalized_sample": f"""SELECT 'train' AS source_split,
 'mixed:train:' || CAST(doc_id AS VARCHAR) AS record_id, coalesce(nullif(lang, ''), 'und') AS language,
 trim(regexp_replace(nfc_normalize(text), '{_BLANK_RUN}', ' ', 'g'), ' ') AS text
 FROM documents WHERE doc_id IN (SELECT doc_id FROM documents ORDER BY doc_id LIMIT 300)
 UNION ALL SELECT 'validation', 'mixed:validation:' || CAST(i AS VARCHAR), 'und',
 trim(regexp_replace(nfc_normalize(text), '{_BLANK_RUN}', ' ', 'g'), ' ')
 FROM {_TURNS} WHERE i < 300""",
    "normalize_text_compatibility": f"""SELECT doc_id,
 trim(regexp_replace(nfc_normalize(text), '{_BLANK_RUN}', ' ', 'g'), ' ') AS text FROM documents""",
    "coerced_durations": """WITH v AS (SELECT CAST(value AS DOUBLE) AS v FROM events
 WHERE event_id % 3 <> 0 AND event_id % 5 <> 0)
 SELECT count(*) AS rows_with_duration, min(v) AS min_seconds, median(v) AS median_seconds,
 round(avg(v), 6) AS mean_seconds, max(v) AS max_seconds FROM v""",
    "null_texts": f"""{_WITH_DOCS}, n AS (SELECT CASE WHEN CAST(record_id AS BIGINT) % 3 = 2
 THEN len({_tokens()}) END AS n FROM docs)
 SELECT count(*) AS rows, count(n) AS count_with_text, min(n) AS min_tokens, max(n) AS max_tokens,
 round(avg(n), 4) AS mean_tokens, count(n) AS kept_rows FROM n""",
    "audio_struct_column": """SELECT CAST(page_id AS VARCHAR) AS record_id, url AS audio_path,
 octet_length(encode(html))::BIGINT AS audio_bytes FROM pages""",
    "inspect_report": f"""WITH c AS ({_inspected("conversations", "train", "conversations", "train")}
 UNION ALL {_inspected("documents", "train", "documents", "train")}
 UNION ALL {_inspected("events", "train", "events", "train")}
 UNION ALL {_inspected("mixed", "train", "documents", _MIXED_SPLITS)}
 UNION ALL {_inspected("mixed", "unlabeled", "benchmark", _MIXED_SPLITS)}
 UNION ALL {_inspected("mixed", "validation", "conversations", _MIXED_SPLITS)}),
 p AS (SELECT dataset_key, source_split, record_id, i FROM
 (SELECT 'conversations' AS dataset_key, 'train' AS source_split,
 {_derived("conversations", "conversations.parquet", "i")} AS record_id, i FROM {_TURNS} WHERE i < 3
 UNION ALL SELECT 'documents', 'train', CAST(doc_id AS VARCHAR), doc_id FROM documents WHERE doc_id < 3
 UNION ALL SELECT 'events', 'train', CAST(event_id AS VARCHAR), rn FROM
 (SELECT event_id, row_number() OVER (ORDER BY event_id) AS rn FROM events) WHERE rn <= 3
 UNION ALL SELECT 'mixed', 'train', {_derived("mixed", "documents.parquet", "doc_id")}, doc_id
 FROM documents WHERE doc_id < 3
 UNION ALL SELECT 'mixed', 'unlabeled', {_derived("mixed", "benchmark.parquet", "i")}, i
 FROM {_ITEMS} WHERE i < 3
 UNION ALL SELECT 'mixed', 'validation', {_derived("mixed", "conversations.parquet", "i")}, i
 FROM {_TURNS} WHERE i < 3)),
 g AS (SELECT dataset_key, source_split, string_agg(record_id, ',' ORDER BY i) AS preview_ids
 FROM p GROUP BY ALL)
 SELECT dataset_key, source_split, rows_sampled, available_splits,
 CASE dataset_key WHEN 'documents' THEN 'source' WHEN 'events' THEN 'user_id' ELSE 'role' END
 AS speaker_column, preview_ids FROM c JOIN g USING (dataset_key, source_split)""",
    "preview": f"""SELECT {_CANONICAL_NAMES} FROM ({
        _CONVS.replace(f" FROM {_TURNS}", f", i FROM {_TURNS}")
    }) ORDER BY i LIMIT 5""",
    "inspect_counts": " UNION ALL ".join(
        [
            _inspected("conversations", "train", "conversations", "train"),
            _inspected("documents", "train", "documents", "train"),
            _inspected("events", "train", "events", "train"),
            _inspected("mixed", "train", "documents", _MIXED_SPLITS),
            _inspected("mixed", "unlabeled", "benchmark", _MIXED_SPLITS),
            _inspected("mixed", "validation", "conversations", _MIXED_SPLITS),
        ]
    ),
    "catalog_split_counts": " UNION ALL ".join(
        [
            _catalog_row("documents", "train", "documents", "TRUE", "TRUE", "text"),
            _catalog_row("conversations", "train", "conversations", "TRUE", "TRUE", "text"),
            _catalog_row("events", "train", "events", "TRUE", "TRUE", "props"),
            _catalog_row("mixed", "train", "documents", "TRUE", "FALSE", "text"),
            _catalog_row("mixed", "unlabeled", "benchmark", "FALSE", "FALSE", "text"),
            _catalog_row("mixed", "validation", "conversations", "TRUE", "FALSE", "text"),
        ]
    ),
    "export_split_rows": f"""SELECT source_split, record_id, speaker_id, language
 FROM ({_MIXED}) WHERE source_split <> 'unlabeled'""",
    "positional_record_id": f"""SELECT 'mixed:train:' || CAST(i AS VARCHAR) AS record_id,
 'und' AS language, 'text' AS text_source_column FROM {_TURNS}
 UNION ALL SELECT 'mixed:train:' ||
 CAST(doc_id + (SELECT count(*) FROM conversations) AS VARCHAR), coalesce(nullif(lang, ''), 'und'),
 'text' FROM documents""",
    # No text in the tables has a compatibility character, so NFC is NFKC on them;
    # DuckDB has only the former. Texts that NFKC changes are in tests/.
    "normalize_text_nfkc": f"""SELECT CAST(doc_id AS VARCHAR) AS record_id,
 trim(regexp_replace(nfc_normalize(text), '{_BLANK_RUN}', ' ', 'g'), ' ') AS text
 FROM documents""",
    "materialize_roundtrip": f"{_SELECTED} SELECT * FROM assigned",
    "materialize_arrow_roundtrip": f"{_SELECTED} SELECT * FROM assigned",
    "materialize_manifest": f"{_SELECTED} SELECT split, {_TOTALS} FROM assigned GROUP BY split",
    "stream_documents": f"""{_WITH_DOCS} SELECT *, {_split_label(0.1, 0.0)} AS split FROM docs
 WHERE text IS NOT NULL AND len({_tokens()}) BETWEEN 20 AND 2000""",
    "stream_first_transcripts": f"""{_WITH_DOCS}, k AS (SELECT dataset_key, CASE WHEN
 len({_tokens()}) > 0 THEN sha256(array_to_string({_tokens()}, ' ')) END AS digest FROM docs)
 SELECT DISTINCT * FROM k WHERE digest IS NOT NULL
 UNION ALL SELECT * FROM k WHERE digest IS NULL""",
}


def oracle_sql() -> dict[str, str]:
    """Equivalent DuckDB SQL, for the queries that SQL can express."""
    return ORACLE | LLM_ORACLE
