"""Queries of this subpackage, one per operator, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from utterflow.llm import (
    decontamination,
    extraction,
    language,
    mixing,
    prefix_trie,
    quality,
    secret_scan,
    sharding,
    simhash,
    spelling,
    suffix_dedup,
    url_filter,
    warc,
)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    benchmark = _table(spark, sf, "benchmark")
    return decontamination.contaminated(_table(spark, sf, "documents"), benchmark)


def op2_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.archived(_table(spark, sf, "pages"))


def op3_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return extraction.extracted(_table(spark, sf, "pages"))


def op4_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secret_scan.digest(secret_scan.with_secrets(_table(spark, sf, "documents")))


def op5_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.judged_urls(_table(spark, sf, "pages"))


def op6_language(spark: SparkSession, sf: str) -> DataFrame:
    return language.predicted(_table(spark, sf, "documents"))


def op7_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_dedup.repeated_strings_removed(_table(spark, sf, "documents"))


def op9_quality(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality.judged(quality.ledger(_table(spark, sf, "documents")))
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        # Bits of other policies are not part of this result.
        F.col("failures").bitwiseAND(F.lit(quality.POLICIES[quality.DEFAULT_POLICY])).alias("failures"),
    )


def op10_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mixed(_table(spark, sf, "documents"))


def op11_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie.trie(_table(spark, sf, "conversations")).drop("tour_enter", "tour_exit")


def op12_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.sharded(_table(spark, sf, "documents"))


def op13_spelling(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(_table(spark, sf, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontamination,
        op2_warc,
        op3_extraction,
        op4_secrets,
        op5_url_filter,
        op6_language,
        op7_simhash,
        op8_suffix_dedup,
        op9_quality,
        op10_mixing,
        op11_prefix_trie,
        op12_sharding,
        op13_spelling,
    )
}

# --- the same in SQL ---------------------------------------------------------
# The other operators have no form in SQL (iteration, hashes that the SQL engine lacks, parsers,
# models, seeded draws); tests/llm holds them against plain versions.

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_LINES = (
    "list_filter(string_split(coalesce(text, ''), chr(10)),"
    r" lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))"
)


def _pattern_count(pattern: str) -> str:
    return f"len(regexp_extract_all(coalesce(text, ''), '{pattern}'))"


_QUALITY = rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w, {_LINES} AS x,
 {_pattern_count("[#*$%&|<>]")} AS n_symbols, {_pattern_count("!")} AS n_bang,
 {_pattern_count("[A-ZÀ-ÖØ-Þ]{2}")} AS n_caps FROM documents),
 wins AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS win
 FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) > 5)),
 twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM wins)
 WHERE n > 1),
 cov AS (SELECT r, count(DISTINCT k) AS n FROM
 (SELECT r, unnest(range(i, i + 5)) AS k FROM twice) GROUP BY r),
 m AS (SELECT d.doc_id, len(w)::BIGINT AS n_words,
 length(array_to_string(w, ''))::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
 len(list_filter(range(2, len(w) + 1), lambda k: w[k] = w[k - 1])) AS n_stutters,
 (len(x) - len(list_distinct(x)))::BIGINT AS n_dup_lines, len(x) AS n_lines,
 coalesce(cov.n, 0)::BIGINT AS n_repeat_words, n_bang, n_caps
 FROM d LEFT JOIN cov ON d.r = cov.r),
 f AS (SELECT *, n_words < 10 AS f0, 100 * n_repeat_words > 20 * n_words AS f1,
 n_words > 0 AND n_symbols::DOUBLE / n_words > 0.1 AS f2,
 n_lines > 0 AND n_dup_lines::DOUBLE / n_lines > 0.4 AS f3,
 word_chars > 0 AND n_caps::DOUBLE / word_chars > 0.3 AS f4,
 n_words > 0 AND n_bang::DOUBLE / n_words > 0.3 AS f5,
 n_words = 0 OR word_chars::DOUBLE / n_words NOT BETWEEN 2 AND 14 AS f6,
 n_words > 0 AND n_stutters::DOUBLE / n_words > 0.3 AS f7 FROM m)
 SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
 f0 OR f1 AS base_failed, NOT (f0 OR f1 OR f2 OR f3 OR f4 OR f5 OR f6 OR f7) AS kept,
 (f0::BIGINT + 2 * f1::BIGINT + 4 * f2::BIGINT + 8 * f3::BIGINT + 16 * f4::BIGINT
 + 32 * f5::BIGINT + 64 * f6::BIGINT + 128 * f7::BIGINT)::BIGINT AS failures FROM f"""

# What the SQL engine can tell of an archive: payloads, digests and which page is the response.
_WARC = f"""WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS n,
 sha256(coalesce(html, '')) AS digest FROM pages),
 g AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first_id FROM p)
 SELECT page_id, n AS payload_bytes, digest AS payload_digest,
 CASE WHEN n >= {warc.REVISIT_BYTES} AND page_id <> first_id THEN 'revisit' ELSE 'response' END
 AS record_type,
 CASE WHEN n >= {warc.REVISIT_BYTES} AND page_id <> first_id THEN first_id END AS refers_to FROM g"""

ORACLE: dict[str, str] = {"op2_warc": _WARC, "op9_quality": _QUALITY}
