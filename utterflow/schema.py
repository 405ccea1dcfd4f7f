"""Data model: the canonical row, and how a source table maps onto it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import types as T

# Column names, order and types of the canonical transcript row.
CANONICAL_SCHEMA = T.StructType(
    [
        T.StructField("source_dataset", T.StringType()),
        T.StructField("source_subset", T.StringType()),
        T.StructField("source_split", T.StringType()),
        T.StructField("dataset_key", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("speaker_id", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("language", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("duration_seconds", T.DoubleType()),
    ]
)
AUDIO_TYPE = T.StructType(
    [T.StructField("bytes", T.BinaryType()), T.StructField("path", T.StringType())]
)

# Where a row came from. Scans add these, and they travel with the canonical
# columns only when asked for: they give an order (file, row) and a unique key,
# neither of which record_id guarantees.
PATH, ROW = "_path", "_row"


def canonical_schema(include_audio: bool = False, provenance: bool = False) -> T.StructType:
    fields = list(CANONICAL_SCHEMA)
    if include_audio:
        fields.append(T.StructField("audio", AUDIO_TYPE))
    if provenance:
        fields += [T.StructField(PATH, T.StringType()), T.StructField(ROW, T.LongType())]
    return T.StructType(fields)


@dataclass(frozen=True)
class SourceSpec:
    """Column mapping of one dataset configuration.

    Every ``*_column`` names a column of the source table; ``None`` means the
    source has no such column and the canonical value is null.
    """

    key: str
    dataset: str
    subset: str
    text_column: str
    record_id_column: str | None = None
    speaker_column: str | None = None
    gender_column: str | None = None
    language_column: str | None = None
    default_language: str | None = None
    duration_column: str | None = None
    audio_column: str = "audio"
    unexported_splits: tuple[str, ...] = ()
    # Declared, as what is known of the dataset; None leaves it to the splits that a source has.
    train_only: bool | None = None
    default_splits: tuple[str, ...] = ()

    def mapped_columns(self) -> list[str]:
        """Source columns the canonical row is made from; audio is never among them."""
        mapped = {
            self.text_column,
            self.record_id_column,
            self.speaker_column,
            self.gender_column,
            self.language_column,
            self.duration_column,
        }
        return sorted(c for c in mapped if c)

    def column_mapping(self) -> dict[str, str | None]:
        """Canonical column -> source column, as the recipe records it."""
        return {
            "record_id": self.record_id_column or "<derived>",
            "speaker_id": self.speaker_column,
            "gender": self.gender_column,
            "language": self.language_column or f"<default:{self.default_language}>",
            "text": self.text_column,
            "duration_seconds": self.duration_column,
        }


@dataclass(frozen=True)
class Source:
    """A spec plus the Parquet paths (files, directories, globs) of each split.

    ``root`` is cut off the front of file paths before they seed derived record
    ids, so that ids survive moving the data. ``schema`` replaces the schema
    Spark would infer from one file, for tables whose files differ.
    """

    spec: SourceSpec
    paths: Mapping[str, str | Sequence[str]] = field(default_factory=dict)
    root: str | None = None
    schema: T.StructType | None = None

    @property
    def splits(self) -> list[str]:
        return sorted(self.paths)

    def split_paths(self, split: str) -> list[str]:
        """Each path once: Spark reads a path as often as it is listed."""
        paths = self.paths.get(split, ())
        return [paths] if isinstance(paths, str) else list(dict.fromkeys(paths))

    def export_splits(self, include_unexported: bool = False) -> list[str]:
        return [
            s for s in self.splits if include_unexported or s not in self.spec.unexported_splits
        ]

    @property
    def train_only(self) -> bool:
        declared = self.spec.train_only
        return self.splits == ["train"] if declared is None else declared

    @property
    def first_split(self) -> str | None:
        """The split that stands for the source: its first default one that exists, or any."""
        known = [s for s in self.spec.default_splits if s in self.paths]
        return (known or self.splits or [None])[0]
