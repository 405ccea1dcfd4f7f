"""Speech-corpus preparation on Spark: canonical rows, profiles, filters, splits."""

from utterflow.schema import CANONICAL_SCHEMA, Source, SourceSpec

__all__ = ["CANONICAL_SCHEMA", "Source", "SourceSpec"]
