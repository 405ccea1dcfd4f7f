"""Vocabularies kept as the JSON report of a token-frequency profile."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utterflow.plans.storage import durable

# Fixed value: the layout of the report, {"result": {"top_tokens": [[token, count], ...]}}.
REPORT_SCHEMA = "result struct<top_tokens: array<array<string>>>"


def read_top_tokens(spark: SparkSession, path: str, top_k: int = 500) -> DataFrame:
    """The first ``top_k`` tokens in report order, as ``(rank, token)``."""
    report = spark.read.schema(REPORT_SCHEMA).json(path, multiLine=True)
    head = F.slice("result.top_tokens", 1, top_k)
    return report.select(F.posexplode(F.transform(head, lambda pair: pair[0]))).toDF(
        "rank", "token"
    )


MOST_TOKENS = 1_000_000  # a report is one JSON object, written by one task


def write_top_tokens(frequencies: DataFrame, path: str) -> None:
    """Writes a top-k ``(token, cnt)`` table in that layout, at most ``MOST_TOKENS`` of them.

    A larger table is an error: keep it as a table.
    """
    frequencies = durable(frequencies)
    if (n := frequencies.count()) > MOST_TOKENS:
        raise ValueError(f"{n} tokens are too many for a report; the most is {MOST_TOKENS}")
    pairs = F.collect_list(F.struct(-F.col("cnt"), "token", "cnt"))
    ordered = F.transform(
        F.array_sort(pairs), lambda p: F.array(p["token"], p["cnt"].cast("string"))
    )
    report = frequencies.agg(F.struct(ordered.alias("top_tokens")).alias("result"))
    report.coalesce(1).write.json(path)
