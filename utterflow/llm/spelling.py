"""Spelling variants grouped by one-edit neighbourhoods in a reduced alphabet.

Every letter is hashed to one of ``SYMBOLS`` symbols. A word's reduced form keeps its length, and
two words one edit apart have reduced forms at most one edit apart. So every reduced word emits
its whole one-edit neighbourhood over the few symbols (itself, deletions, substitutions,
insertions), the neighbourhoods are joined with the reduced vocabulary, and the candidates are
verified on the original strings by their edit distance. Nothing is compared that does not share
a neighbourhood key; no group is gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utterflow.llm.tables import Stored
from utterflow.plans.storage import BROADCAST_BYTES, fits_broadcast

# Fixed values of the task: letters, runs, the deletion rule and the thresholds.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
DROP_EVERY = 199
MIN_LENGTH = 6
MIN_COUNT = 5
FORM_RATIO = 5

# Symbols of the reduced alphabet: the top BITS bits of a multiplicative hash of the code point.
BITS = 3
SYMBOLS = 2**BITS
# The letters that runs can hold after lower-casing: a-z and U+00C0 to U+00FF.
LETTERS = LOWER + "".join(chr(c) for c in range(0xC0, 0x100))


def _symbol(letter: str) -> str:
    return str(((ord(letter) * 2654435761) % 2**32) >> (32 - BITS))


REDUCED = "".join(_symbol(c) for c in LETTERS)
ALPHABET = "".join(str(s) for s in range(SYMBOLS))


def occurrences(docs: DataFrame) -> DataFrame:
    """``(doc_id, word)`` for every letter run of every text, after the deletion rule.

    Runs are lower-cased in A-Z only. ``h`` is the unsigned CRC-32 of ``<doc_id>:<run>`` (a null
    id is written as nothing); when ``DROP_EVERY`` divides it, code point ``h % length`` goes. A
    null text has no runs.
    """
    runs = docs.select(
        "doc_id",
        F.explode(F.regexp_extract_all(F.coalesce(F.col("text").cast("string"), F.lit("")), F.lit(RUN), 0)).alias(
            "run"
        ),
    ).select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    h = F.crc32(
        F.encode(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), "run"), "UTF-8")
    )
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.left("run", at), F.substr("run", at + 2))
    return runs.withColumn("h", h).select(
        "doc_id", F.when(F.col("h") % DROP_EVERY == 0, cut).otherwise(F.col("run")).alias("word")
    )


def reduced(word: Column) -> Column:
    return F.translate(word, LETTERS, REDUCED)


def neighbourhood(r: Column) -> Column:
    """The reduced word, its deletions, substitutions and insertions over ``ALPHABET``, distinct."""
    symbols = F.array(*(F.lit(s) for s in ALPHABET))
    n = F.length(r)
    places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    gaps = F.sequence(F.lit(0), n)
    deletions = F.transform(places, lambda i: F.concat(F.left(r, i), F.substr(r, i + 2)))
    substitutions = F.flatten(
        F.transform(places, lambda i: F.transform(symbols, lambda s: F.concat(F.left(r, i), s, F.substr(r, i + 2))))
    )
    insertions = F.flatten(
        F.transform(gaps, lambda i: F.transform(symbols, lambda s: F.concat(F.left(r, i), s, F.substr(r, i + 1))))
    )
    return F.array_distinct(F.concat(F.array(r), deletions, substitutions, insertions))


def variants(docs: DataFrame) -> DataFrame:
    """One row per word: ``word, form, root`` (strings), ``n, n_near, form_n`` (long).

    Words are the distinct results of ``occurrences`` of at least ``MIN_LENGTH`` code points seen
    at least ``MIN_COUNT`` times over all rows. Near words differ by exactly one inserted, deleted
    or replaced code point. ``form`` is the near word of largest ``n`` (ties: smallest in code
    point order) if that ``n`` is at least ``FORM_RATIO`` times the word's, else null; ``root``
    follows forms to the end (the word itself if it has none). Empty tables give no rows; other
    columns are ignored.
    """
    counts = occurrences(docs).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    vocabulary = Stored(
        counts.where((F.length("word") >= MIN_LENGTH) & (F.col("n") >= MIN_COUNT)).withColumn(
            "r", reduced(F.col("word"))
        ),
        "vocabulary",
    ).table
    emitted = vocabulary.select("word", F.explode(neighbourhood(F.col("r"))).alias("key"))
    keyed = vocabulary.select(F.col("r").alias("key"), F.col("word").alias("other"), F.col("n").alias("other_n"))
    # The neighbourhoods are some hundred times the vocabulary: when the vocabulary's size is
    # known to be small it is broadcast and they stream through the join where they are made.
    if fits_broadcast(vocabulary, BROADCAST_BYTES, "word", "r"):
        keyed = F.broadcast(keyed)
    candidates = emitted.join(keyed, "key").where(F.col("word") != F.col("other"))
    near = Stored(
        candidates.where(F.levenshtein("word", "other", 1) == 1)
        .select("word", "other", "other_n")
        .distinct(),
        "near",
    ).table
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.max("other_n").alias("form_n"))
    form = (
        near.join(best, "word")
        .where(F.col("other_n") == F.col("form_n"))
        .groupBy("word", "n_near", "form_n")
        .agg(F.min("other").alias("best"))
    )
    judged = Stored(
        vocabulary.join(form, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(F.col("form_n") >= FORM_RATIO * F.col("n"), F.col("best")).alias("form"),
            F.when(F.col("form_n") >= FORM_RATIO * F.col("n"), F.col("form_n")).alias("form_n"),
        ),
        "forms",
    ).table
    roots = _follow(judged.select("word", "form"))
    return judged.join(roots, "word").select("word", "form", "root", "n", "n_near", "form_n")


def _follow(forms: DataFrame) -> DataFrame:
    """``(word, root)`` by pointer doubling: forms have more occurrences, so chains end."""
    current = Stored(forms.select("word", F.coalesce("form", "word").alias("root")), "roots")
    while True:
        step = current.table.alias("a").join(
            current.table.select(F.col("word").alias("root"), F.col("root").alias("further")), "root", "left"
        )
        moved = step.where(F.col("further").isNotNull() & (F.col("further") != F.col("root")))
        if moved.isEmpty():
            return current.table
        following = Stored(step.select("word", F.coalesce("further", "root").alias("root")), "roots")
        current.drop()
        current = following
