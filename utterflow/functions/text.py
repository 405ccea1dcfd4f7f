"""Text expressions. All of them stay in the JVM except Unicode NFKC."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 code points Python's str.split/str.strip treat as blank.
# Java's \s knows only six of them.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same set for java.util.regex. The Latin-1 members are spelled one by one,
# so Java tests them with one bitmap lookup; the rest sits behind a range check
# that almost every character fails. A flat class with ranges takes 3x as long.
BLANK_CLASS = (
    r"[\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x20\x85\xa0"
    r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]]"
)


def strip_blanks(text: Column) -> Column:
    """Unicode-aware strip. ``F.trim`` alone removes only U+0020."""
    return F.btrim(text, F.lit(BLANKS))


def blank_to_null(value: Column) -> Column:
    """Any value as trimmed text, null when nothing is left."""
    stripped = strip_blanks(value.cast("string"))
    return F.when(stripped != "", stripped)


def has_text(text: Column) -> Column:
    return F.coalesce(text != "", F.lit(False))


def pieces(text: Column) -> Column:
    """``text`` cut at blank runs, with an empty piece at a blank end or for ''."""
    return F.split(text, BLANK_CLASS + "+")


def tokens(text: Column) -> Column:
    """Blank-separated tokens of ``text``: empty array for blank, null for null."""
    return F.array_remove(pieces(text), "")


def lower_tokens(text: Column) -> Column:
    """Lower-cased tokens; one pass over the text instead of one per token."""
    return tokens(F.lower(text))


def token_count(text: Column) -> Column:
    return F.size(tokens(text))


def char_count(text: Column) -> Column:
    """Code points, 0 for null."""
    return F.char_length(F.coalesce(text, F.lit("")))


# Texts that are Python strings at one time.
NFKC_ROWS = 64


def _nfkc_udf(rows: int = NFKC_ROWS):
    # Nested so that workers get the code by value and need not import this package.
    @F.arrow_udf("string")
    def nfkc_slices(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        import unicodedata

        for batch in batches:
            for low in range(0, len(batch), rows):
                own = batch.slice(low, rows).to_pylist()
                yield pa.array(
                    [None if v is None else unicodedata.normalize("NFKC", v) for v in own], pa.string()
                )

    return nfkc_slices


def nfkc(text: Column) -> Column:
    """Unicode NFKC. Spark has no such function, so this is an Arrow UDF.

    Spark calls a UDF for every row, whatever ``when`` surrounds it, so the
    argument is nulled where NFKC can change nothing (pure ASCII): such texts
    never travel to Python, and no second scan is needed to spare them. A worker holds
    the batch it was sent and NFKC_ROWS results, whatever the input.
    """
    needs_python = F.when(text.rlike(r"[^\x00-\x7f]"), text)
    return F.coalesce(_nfkc_udf()(needs_python), text)


def collapse_blanks(text: Column) -> Column:
    return strip_blanks(F.regexp_replace(text, BLANK_CLASS + "+", " "))


def normalize_text(value: Column) -> Column:
    """NFKC, then every blank run to one space, then strip; null becomes ''."""
    return collapse_blanks(nfkc(F.coalesce(value.cast("string"), F.lit(""))))
