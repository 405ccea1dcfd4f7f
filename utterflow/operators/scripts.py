"""Language by script: the share of a text's letters that belong to a Unicode script.

Counts are taken by the JVM's regular expressions over the whole text, one count per script, in
the same projection as the rest of the row: no Python, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Unicode script names as the JVM's \p{Is<name>} and RE2's \p{<name>} know them.
SCRIPTS = ("Latin", "Greek", "Cyrillic", "Arabic", "Hebrew", "Han", "Hiragana", "Katakana", "Hangul", "Thai", "Devanagari")


def letter_count(text: Column) -> Column:
    """Letters (Unicode category L) of a text; 0 for null."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"\p{L}")).cast("long")


def script_count(text: Column, script: str) -> Column:
    """Letters of a text in one script; 0 for null."""
    if script not in SCRIPTS:
        raise ValueError(f"unknown script {script!r}, expected one of {', '.join(SCRIPTS)}")
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(rf"\p{{Is{script}}}")).cast("long")


def with_script_counts(rows: DataFrame, script: str = "Latin", text: str = "text") -> DataFrame:
    """Adds ``n_letters`` and ``n_script`` (letters of ``script``) to every row."""
    return rows.withColumns(
        {"n_letters": letter_count(F.col(text)), "n_script": script_count(F.col(text), script)}
    )


def by_script(rows: DataFrame, script: str = "Latin", min_share: float = 0.5, text: str = "text") -> DataFrame:
    """Rows whose letters are at least ``min_share`` in ``script``.

    A text without letters (also null or empty) has no share and goes. ``min_share`` is in
    [0, 1]; 0 keeps every text with a letter. Columns are kept; two counts are added.
    """
    if not 0.0 <= min_share <= 1.0:
        raise ValueError("min_share must be within [0, 1]")
    counted = with_script_counts(rows, script, text)
    return counted.where(
        (F.col("n_letters") > 0) & (F.col("n_script") >= F.lit(min_share) * F.col("n_letters"))
    )
