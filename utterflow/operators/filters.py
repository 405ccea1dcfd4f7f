"""Transcript filters: token bounds and vocabulary overlap."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from utterflow.functions.text import BLANK_CLASS, lower_tokens, strip_blanks
from utterflow.operators.profiles import exploded_tokens
from utterflow.plans.storage import BROADCAST_BYTES, durable, fits_broadcast
from utterflow.schema import PATH, ROW

FILTER_TYPE = "text_frequency_overlap"  # fixed value: the one filter type recipes know

# Up to here a vocabulary is compiled into the plan as a hash set. The plan goes
# out with every task; 100,000 literals add seconds to planning and milliseconds
# to a task, and save shuffling the rows.
LITERAL_TOKENS, LITERAL_BYTES = 100_000, 2 * 1024 * 1024
# A frequent word may be in every text: one that brings more than this share of the
# rows is dealt out to as many join keys as it has shares, so at most SHARES words are.
SHARES = 1000
ROW_KEY = ("dataset_key", "source_split", PATH, ROW)


@dataclass(frozen=True)
class OverlapFilter:
    """Bounds on tokens, and the least share of them that a vocabulary must hold.

    Tokens are lower-cased, vocabulary entries are not. An empty vocabulary
    leaves only the bounds.
    """

    vocabulary: tuple[str, ...] = ()
    min_overlap_ratio: float = 0.0
    min_tokens: int = 1
    max_tokens: int | None = None


def _sql_string(value: str) -> str:
    """A Spark SQL literal that is plain ASCII whatever the token holds."""
    plain = {c: c for c in "-_.,:;!?()[]<>=+*/#@%&|~^ "}
    return "'" + "".join(
        c
        if c.isascii() and c.isalnum()
        else plain.get(c) or (f"\\u{ord(c):04x}" if ord(c) < 0x10000 else f"\\U{ord(c):08x}")
        for c in value
    ) + "'"


def _splits_text(config: OverlapFilter) -> bool:
    """Whether the filter has to look at tokens, and not just for any text at all."""
    tested = bool(config.vocabulary) and config.min_overlap_ratio > 0
    return tested or config.min_tokens > 1 or config.max_tokens is not None


def keep_condition(config: OverlapFilter | None) -> Column:
    """Whether a row passes. Without a config every row does, text or not."""
    if config is None:
        return F.lit(True)
    text = F.col("text")
    if not _splits_text(config):
        return F.coalesce(strip_blanks(text) != "", F.lit(False))
    conditions = ["size(w) > 0", f"size(w) >= {int(config.min_tokens)}"]
    if config.max_tokens is not None:
        conditions.append(f"size(w) <= {int(config.max_tokens)}")
    if config.vocabulary and config.min_overlap_ratio > 0:
        members = ", ".join(_sql_string(t) for t in dict.fromkeys(config.vocabulary))
        conditions.append(
            f"size(filter(w, t -> t IN ({members}))) / size(w) "
            f">= CAST({float(config.min_overlap_ratio)!r} AS DOUBLE)"
        )
    # exists() over a one-element array gives the token list a name, so that a
    # text is split once and not once per mention. SQL text because building
    # thousands of literals one by one from Python takes seconds.
    blank_runs = _sql_string(BLANK_CLASS + "+")
    words = f"array_remove(split(lower(text), {blank_runs}), '')"
    found = F.expr(f"exists(array({words}), w -> {' AND '.join(conditions)})")
    return F.coalesce(found, F.lit(False))


def apply_filter(rows: DataFrame, config: OverlapFilter | None) -> DataFrame:
    if config is None:
        return rows
    return rows.where(keep_condition(config))


def filters_of(pipeline: Iterable[Mapping[str, Any]]) -> dict[str, OverlapFilter]:
    """Filter per dataset key from a recipe's pipeline: other types are passed
    over, and of several entries for one dataset the last counts."""
    found = {}
    for entry in pipeline:
        if entry.get("type") != FILTER_TYPE or not entry.get("dataset_key"):
            continue
        limit = entry.get("max_text_tokens")
        named = entry.get("top_tokens") is not None or entry.get("vocabulary_path")
        if float(entry.get("min_overlap_ratio", 0.0)) > 0 and not named:
            raise ValueError(
                f"the filter of {entry['dataset_key']!r} asks for an overlap but has no vocabulary"
            )
        found[entry["dataset_key"]] = OverlapFilter(
            vocabulary=tuple(entry.get("top_tokens") or ()),
            min_overlap_ratio=float(entry.get("min_overlap_ratio", 0.0)),
            min_tokens=int(entry.get("min_text_tokens", 1)),
            max_tokens=None if limit is None else int(limit),
        )
    return found


def apply_filters(rows: DataFrame, configs: Mapping[str, OverlapFilter]) -> DataFrame:
    """Filters rows of several datasets; rows of a dataset without a config stay."""
    if not configs:
        return rows
    keep = None
    for key, config in configs.items():
        this = F.col("dataset_key") == key
        branch = keep_condition(config)
        keep = F.when(this, branch) if keep is None else keep.when(this, branch)
    return rows.where(keep.otherwise(F.lit(True)))


def literal_vocabulary(
    vocabulary: DataFrame, most: int = LITERAL_TOKENS
) -> tuple[str, ...] | None:
    """The ``token`` column as a tuple if it is small enough for the plan, else None.

    At most ``most`` + 1 rows reach the driver.
    """
    head = vocabulary.select("token").limit(most + 1).collect()
    found = tuple(r["token"] for r in head if r["token"] is not None)
    size = sum(len(t.encode("utf-8")) for t in found)
    return found if len(head) <= most and size <= LITERAL_BYTES else None


def row_key(rows: DataFrame, key: tuple[str, ...] | None = None) -> tuple[str, ...]:
    """The columns that tell rows apart: ``key``, or where they came from.

    Filters whose vocabulary is a table need them whatever its size, so that no table that grows
    turns a filter that works into one that cannot.
    """
    wanted = key or ROW_KEY
    missing = [c for c in wanted if c not in rows.columns]
    # Rows of one source may lack the first two; place in a file is what counts.
    if missing and (key or {PATH, ROW} & set(missing)):
        raise ValueError(
            f"rows lack {', '.join(missing)}: scan with provenance=True or name a unique key"
        )
    return tuple(c for c in wanted if c in rows.columns)


def filter_by_vocabulary(
    rows: DataFrame,
    vocabulary: DataFrame,
    min_overlap_ratio: float,
    min_tokens: int = 1,
    max_tokens: int | None = None,
    *,
    key: tuple[str, ...] | None = None,
    literal_tokens: int | None = None,
) -> DataFrame:
    """``apply_filter`` with the vocabulary as a table with a ``token`` column.

    Up to ``literal_tokens`` tokens (LITERAL_TOKENS if None; and LITERAL_BYTES) become a literal
    set, more are joined; the result is the same. Rows need a unique key either way, see ``row_key``.
    """
    key = row_key(rows, key)
    config = OverlapFilter((), min_overlap_ratio, min_tokens, max_tokens)
    if min_overlap_ratio > 0:
        # Used for its size and for the filter: both must see the same table.
        table = durable(vocabulary.select("token").where("token IS NOT NULL").distinct())
        most = LITERAL_TOKENS if literal_tokens is None else literal_tokens
        small = literal_vocabulary(table, most)
        if small is None:
            return join_overlap(apply_filter(rows, config), table, min_overlap_ratio, key=key)
        config = OverlapFilter(small, min_overlap_ratio, min_tokens, max_tokens)
    return apply_filter(rows, config)


def join_overlap(
    rows: DataFrame,
    vocabulary: DataFrame,
    min_overlap_ratio: float | str,
    on: tuple[str, ...] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
    key: tuple[str, ...] | None = None,
) -> DataFrame:
    """Rows whose tokens the (distinct) vocabulary covers to the given share.

    For vocabularies too large for the plan. ``on`` names further columns that
    vocabulary and rows must agree in; ``min_overlap_ratio`` may name a column
    of ``rows``. Tokens travel with a 16-byte hash of the row's key and nothing
    else of the row. A vocabulary beyond ``broadcast_bytes`` is joined by
    shuffle, for which texts are first dealt out by that hash: the words of one
    are then counted in place. The rows themselves stay where they are as long
    as the keys of those that pass can be broadcast; beyond, they are joined by
    shuffle.
    """
    named = row_key(rows, key)
    per_row = isinstance(min_overlap_ratio, str)
    ratio = F.col(min_overlap_ratio) if per_row else F.lit(float(min_overlap_ratio))
    # Two hashes of one column order each: equal for different rows once in 2^128.
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in named]
    key = ["_key_a", "_key_b"]
    hashes = dict(zip(key, (F.xxhash64(*parts), F.xxhash64(F.lit("b"), *parts[::-1]))))
    carried = list(dict.fromkeys([*key, *on, *([min_overlap_ratio] if per_row else [])]))
    hashed = rows.withColumns(hashes)
    known = vocabulary.select(*on, "token", F.lit(True).alias("_known"))
    match = [*on, "token"]
    if fits_broadcast(vocabulary, broadcast_bytes, *match):
        words = exploded_tokens(hashed, *carried)
        found = words.withColumn("_n", F.lit(1)).join(F.broadcast(known), match, "left")
    else:
        frequent = F.broadcast(_frequent(exploded_tokens(hashed, *on), match))
        # A word counts once per text from here on, however often it is in it.
        words = exploded_tokens(hashed.select(*carried, "text").repartition(*key), *carried)
        counted = words.groupBy(*carried, "token").agg(F.count("*").alias("_n"))
        salts = F.coalesce("_salts", F.lit(1).cast("long"))
        salt = F.pmod(F.xxhash64(*key), salts)
        last = F.sequence(F.lit(0).cast("long"), salts - 1)
        copies = known.join(frequent, match, "left").withColumn("_salt", F.explode(last))
        # Spark takes the copies for as few as the words: without the hint it would broadcast them.
        found = (
            counted.join(frequent, match, "left")
            .withColumn("_salt", salt)
            .join(copies.drop("_salts").hint("merge"), [*match, "_salt"], "left")
        )
    hits = F.coalesce(F.sum(F.when(F.col("_known"), F.col("_n"))), F.lit(0))
    passed = (
        found.groupBy(*carried)
        .agg((hits / F.sum("_n")).alias("_share"))
        .where(F.col("_share") >= ratio)
        .select(*key)
    )
    passed = durable(passed)
    small = fits_broadcast(passed, broadcast_bytes)
    passed = F.broadcast(passed) if small else passed.hint("merge")
    return rows.withColumns(hashes).join(passed, key, "left_semi").drop(*key)


def _frequent(words: DataFrame, match: list[str]) -> DataFrame:
    """``(*match, _salts)`` of the words with more than one in SHARES of all rows of ``words``.

    ``_salts`` is their number of shares. There are fewer than SHARES such words, whatever the rows.
    """
    counts = words.groupBy(*match).agg(F.count("*").alias("_rows"))
    counts = durable(counts.where("_rows > 1"))
    total = counts.agg(F.sum("_rows")).first()[0] or 1
    shares = F.ceil(F.col("_rows") * SHARES / total)
    return counts.select(*match, shares.alias("_salts")).where("_salts > 1")


def filter_by_config_table(
    rows: DataFrame,
    configs: DataFrame,
    literal_tokens: int = LITERAL_TOKENS,
    broadcast_bytes: int = BROADCAST_BYTES,
    *,
    key: tuple[str, ...] | None = None,
) -> DataFrame:
    """Left lookup of filters kept as a table.

    Columns: ``ord, dataset_key, vocabulary array<string>, min_overlap_ratio,
    min_tokens, max_tokens``; of several rows per dataset the highest ``ord``
    counts, and rows without a match stay. A table small enough for the plan
    (1000 configs, ``literal_tokens`` tokens, LITERAL_BYTES) is compiled into
    it; otherwise vocabularies are joined token by token, with the same result.
    Rows need a unique key either way, see ``row_key``.
    """
    key = row_key(rows, key)
    fields = ["vocabulary", "min_overlap_ratio", "min_tokens", "max_tokens"]
    latest = durable(
        configs.groupBy("dataset_key")
        .agg(F.max_by(F.struct(*fields), "ord").alias("f"))
        .select(
            "dataset_key",
            "f.vocabulary",
            F.coalesce("f.min_overlap_ratio", F.lit(0.0)).alias("min_overlap_ratio"),
            F.coalesce("f.min_tokens", F.lit(1)).alias("min_tokens"),
            "f.max_tokens",
        )
    )
    size = latest.agg(
        F.count("*").alias("configs"),
        F.sum(F.size(F.coalesce("vocabulary", F.array()))).alias("tokens"),
        F.sum(F.octet_length(F.array_join("vocabulary", ""))).alias("bytes"),
    ).first()
    small = (
        size["configs"] <= 1000
        and (size["tokens"] or 0) <= literal_tokens
        and (size["bytes"] or 0) <= LITERAL_BYTES
    )
    if small:
        table = {
            r["dataset_key"]: OverlapFilter(
                tuple(t for t in r["vocabulary"] or () if t is not None),
                r["min_overlap_ratio"],
                r["min_tokens"],
                r["max_tokens"],
            )
            for r in latest.collect()
        }
        return apply_filters(rows, table)
    return _join_configs(rows, latest, broadcast_bytes, key)


def _join_configs(
    rows: DataFrame, latest: DataFrame, broadcast_bytes: int, key: tuple[str, ...]
) -> DataFrame:
    settings = latest.select(
        "dataset_key",
        F.struct(
            (F.size(F.coalesce("vocabulary", F.array())) > 0).alias("has_vocabulary"),
            F.col("min_overlap_ratio").alias("ratio"),
            "min_tokens",
            "max_tokens",
        ).alias("_f"),
    )
    if fits_broadcast(settings, broadcast_bytes, "dataset_key"):
        settings = F.broadcast(settings)
    bounded = F.exists(
        F.array(lower_tokens(F.col("text"))),
        lambda w: (F.size(w) > 0)
        & (F.size(w) >= F.col("_f.min_tokens"))
        & F.coalesce(F.size(w) <= F.col("_f.max_tokens"), F.lit(True)),
    )
    matched = rows.join(settings, "dataset_key", "left").where(F.col("_f").isNull() | bounded)
    matched = matched.withColumn(
        "_ratio", F.when(F.col("_f.has_vocabulary") & (F.col("_f.ratio") > 0), F.col("_f.ratio"))
    ).drop("_f")
    pairs = latest.select("dataset_key", F.explode(F.array_distinct("vocabulary")).alias("token"))
    free = matched.where(F.col("_ratio").isNull())
    tested = matched.where(F.col("_ratio").isNotNull())
    covered = join_overlap(tested, pairs, "_ratio", ("dataset_key",), broadcast_bytes, key)
    kept = free.unionByName(covered)
    return kept.select(*rows.columns)
