"""Quality rules as a ledger of bits.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per
failed rule, so that policies (versioned bit masks) are applied, changed and ablated later without
reading a text again. All of it is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utterflow.llm.tables import words

WINDOW = 5
# Letters of scripts that put no blanks between words: Thai, Lao, Tibetan, Burmese, Khmer, kana and
# Han. The outer range comes first, so that other letters are told by one comparison.
UNSPACED = (
    r"[\x{0E00}-\x{323AF}&&[\x{0E01}-\x{0E4E}\x{0E81}-\x{0ECE}\x{0EDC}-\x{0EDF}\x{0F40}-\x{0FBC}"
    r"\x{1000}-\x{103F}\x{1050}-\x{108F}\x{1780}-\x{17D3}\x{3005}-\x{3007}\x{3041}-\x{30FF}\x{31F0}-\x{31FF}"
    r"\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{A9E0}-\x{A9FE}\x{AA60}-\x{AA7F}\x{F900}-\x{FAFF}"
    r"\x{FF66}-\x{FF9D}\x{20000}-\x{323AF}]]"
)
# From this share of the characters on, words are not told apart by blanks.
UNSPACED_SHARE = 0.2


@dataclass(frozen=True)
class Rule:
    """A rule: its place in the bitmask, its name, and when a document fails it."""

    bit: int
    name: str
    fails: Callable[[], Column]


def _share(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


# Bits 0 and 1 are the base rules. A bit never changes its meaning; new rules take new bits.
RULES = (
    Rule(0, "few_words", lambda: F.col("n_words") < 10),
    Rule(1, "repeated_windows", lambda: 100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
    Rule(2, "symbols", lambda: _share("n_symbols", "n_words") > 0.1),
    Rule(3, "repeated_lines", lambda: _share("n_dup_lines", "n_lines") > 0.4),
    Rule(4, "capitals", lambda: _share("n_capital_pairs", "word_chars") > 0.3),
    Rule(5, "exclamations", lambda: _share("n_exclamations", "n_words") > 0.3),
    Rule(
        6,
        "word_length",
        lambda: ~_share("word_chars", "n_words").between(2.0, 14.0)
        & (_share("n_unspaced", "word_chars") < UNSPACED_SHARE),
    ),
    Rule(7, "stutter", lambda: _share("n_stutters", "n_words") > 0.3),
    # The symbols rule as v1 and v2 were published with; bit 2 was lowered to 0.1 after them.
    Rule(8, "many_symbols", lambda: _share("n_symbols", "n_words") > 0.25),
)
BASE_BITS = 0b11
# A policy is the set of bits that reject a document. Published versions stay as they are.
POLICIES = {"v1": 0b100001011, "v2": 0b101111011, "v3": 0b011111111}
DEFAULT_POLICY = "v3"


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with one column per measurement; no shuffle, whole texts.

    ``n_repeat_words``: windows of five words are compared by their 64-bit hash. Only documents in
    which a hash occurs twice sort their windows. A null text counts as an empty one.
    Measurements replace columns of ``docs`` of the same name.
    """
    source = F.coalesce(F.col(text), F.lit(""))
    w, g, s, p, x = "__words", "__windows", "__sorted", "__places", "__lines"
    rows = docs.withColumns(
        {
            w: words(F.col(text)),
            x: F.filter(F.split(source, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]")),
            "n_symbols": F.regexp_count(source, F.lit("[#*$%&|<>]")).cast("long"),
            "n_unspaced": F.regexp_count(source, F.lit(UNSPACED)).cast("long"),
            "n_exclamations": F.regexp_count(source, F.lit("!")).cast("long"),
            "n_capital_pairs": F.regexp_count(source, F.lit("[A-ZÀ-ÖØ-Þ]{2}")).cast("long"),
        }
    )
    rows = rows.withColumns(
        {
            "n_words": F.size(w).cast("long"),
            "word_chars": F.length(F.array_join(w, "")).cast("long"),
            "n_stutters": F.size(F.filter(w, lambda v, i: v.eqNullSafe(F.get(F.col(w), i - 1)))).cast("long"),
            "n_lines": F.size(x).cast("long"),
            "n_dup_lines": (F.size(x) - F.size(F.array_distinct(x))).cast("long"),
            g: F.when(
                F.size(w) > WINDOW,
                F.transform(
                    F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)),
                    lambda i: F.xxhash64(F.slice(w, i, WINDOW)),
                ),
            ),
        }
    )
    rows = rows.withColumn(
        s,
        F.when(
            F.size(F.array_distinct(g)) < F.size(g),
            F.array_sort(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    hash_at = lambda i: F.get(F.col(s), i)["h"]
    rows = rows.withColumn(
        p,
        F.array_sort(
            F.transform(
                F.filter(
                    s,
                    lambda e, i: F.coalesce(hash_at(i - 1) == e["h"], F.lit(False))
                    | F.coalesce(hash_at(i + 1) == e["h"], F.lit(False)),
                ),
                lambda e: e["i"],
            )
        ),
    )
    covered = F.aggregate(
        F.transform(
            p,
            lambda i, k: F.least(
                F.lit(WINDOW), F.coalesce(F.get(F.col(p), k + 1) - i, F.lit(WINDOW))
            ),
        ),
        F.lit(0),
        lambda total, n: total + n,
    )
    repeated = F.coalesce(covered, F.lit(0)).cast("long")
    return rows.withColumn("n_repeat_words", repeated).drop(w, g, s, p, x)


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measurements and ``failures``, the bits of the rules that fail."""
    bits = F.lit(0).cast("long")
    for rule in RULES:
        failed = F.when(rule.fails(), F.lit(1 << rule.bit)).otherwise(F.lit(0))
        bits = bits.bitwiseOR(failed.cast("long"))
    # A filter on the bits would be pushed below the measurements, and each mention of one would
    # compute it again. Spark leaves filters above a column that depends on a row's place.
    held = F.when(F.monotonically_increasing_id() >= 0, bits)
    return measured(docs, text).withColumn("failures", held)


def judged(rows: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """A ledger with ``base_failed`` and ``kept`` under a policy; the base rules always reject."""
    mask = POLICIES[policy] | BASE_BITS
    return rows.withColumns(
        {
            "base_failed": F.col("failures").bitwiseAND(F.lit(BASE_BITS)) != 0,
            "kept": F.col("failures").bitwiseAND(F.lit(mask)) == 0,
        }
    )


def ablations(rows: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """Per rule of a policy: the documents that fail it, and those that only it rejects.

    The ledger is counted by its bits, of which there are at most 2 to the number of rules.
    """
    mask = POLICIES[policy] | BASE_BITS
    patterns = rows.groupBy(F.col("failures").bitwiseAND(F.lit(mask)).alias("bits")).count()
    rules = F.array(
        *[
            F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit"))
            for r in RULES
            if mask >> r.bit & 1
        ]
    )
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    n = F.col("count")
    return (
        patterns.select("bits", "count", F.explode(rules).alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(hit, n).otherwise(0)).alias("failed"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), n).otherwise(0)).alias("only_this"),
        )
    )


def clean_documents(docs: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """The documents that a policy keeps, with the columns of ``docs``."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), "text")
    return judged(ledger(whole), policy).where("kept").select("__row.*")
