"""Secret scans with a trigram inverted index.

From every rule's regular expression follows a Boolean query over trigrams that each match contains:
an alternation is an OR, a sequence an AND. Texts are indexed in segments (some hundred documents
that a task has in memory): for the trigrams of the rules' queries, the documents of the segment
that contain them. A rule's query intersects and unites these postings, and the rule's expression
runs only on the documents that remain. A rule without mandatory trigrams runs on all documents.

Segments are built and dropped batch by batch, so the index needs no shuffle and no storage.
"""

from __future__ import annotations

import re
import re._constants as sre
import re._parser as sre_parser
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``group`` of a match must have ``least`` characters. Expressions are for ASCII case rules."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The base rules first, in the order in which equal starts are listed.
RULES = (
    Rule(
        "assign",
        r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", r"[0-9a-f]+", least=32),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("payment", r"[rs]k_(?:live|test)_[A-Za-z0-9]{16,}"),
)
BASE_KINDS = ("assign", "access", "hex")

# --- from an expression to a query -------------------------------------------
# A query is True (all documents), a trigram, or ("and" | "or", queries). Trigrams are of lower-case
# text, so that one index serves rules of either case.

_MOST = 64  # strings that are listed for a part of an expression before it counts as "anything"


def _both(kind: str, queries: list):
    """AND or OR of queries, simplified."""
    if kind == "or" and any(q is True for q in queries):
        return True
    queries = list(dict.fromkeys(q for q in queries if q is not True))
    if not queries:
        return True
    return queries[0] if len(queries) == 1 else (kind, tuple(queries))


def _of_strings(strings: set[str]):
    """Some one of the strings occurs: OR over the strings, AND over a string's trigrams."""
    return _both(
        "or",
        [_both("and", [s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)],
    )


def _in_set(items: list) -> set[str] | None:
    found: set[str] = set()
    for op, value in items:
        if op is sre.LITERAL:
            found.add(chr(value).lower())
        elif op is sre.RANGE and value[1] - value[0] < _MOST:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found


def _parsed(part) -> tuple[set[str] | None, object]:
    """Of a part of an expression: all strings it can match, if few, and its query."""
    known: set[str] | None = {""}
    queries: list = []

    def flush() -> None:
        nonlocal known
        if known is not None:
            queries.append(_of_strings(known))
        known = {""}

    whole = True  # the strings in ``known`` are all of the part so far
    for op, value in part:
        strings: set[str] | None
        query: object = True
        if op is sre.LITERAL:
            strings = {chr(value).lower()}
        elif op is sre.IN:
            strings = _in_set(value)
        elif op is sre.SUBPATTERN:
            strings, query = _parsed(value[3])
        elif op is sre.BRANCH:
            each = [_parsed(b) for b in value[1]]
            strings = None
            if all(s is not None for s, _ in each):
                strings = set().union(*(s for s, _ in each))
            query = _both("or", [q for _, q in each])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            low, high, inner = value
            strings, query = _parsed(inner)
            if (low, high) == (0, 1) and strings is not None:
                strings, query = strings | {""}, True
            elif low == 0:
                strings, query = None, True
            elif (low, high) != (1, 1):
                strings = None
        elif op is sre.AT:
            strings = {""}
        else:
            strings = None
        queries.append(query)
        if strings is not None and known is not None:
            joined = {a + b for a, b in product(known, strings)}
            if len(joined) <= _MOST:
                known = joined
                continue
        whole = False
        flush()
        if strings is not None and len(strings) <= _MOST:
            known = strings
    if whole:
        return known, _both("and", [_of_strings(known), *queries])
    flush()
    return None, _both("and", queries)


def trigram_query(pattern: str):
    """The query that a text must satisfy to have a match; True if there is none."""
    return _parsed(sre_parser.parse(pattern))[1]


def trigrams_of(query) -> set[str]:
    if query is True:
        return set()
    if isinstance(query, str):
        return {query}
    return set().union(*(trigrams_of(q) for q in query[1]))


# --- the index of a segment --------------------------------------------------

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


class Lookup:
    """Which trigrams are indexed: by their first two bytes, then by the third."""

    def __init__(self, trigrams: set[str]):
        self.trigrams = sorted(t for t in trigrams if t.isascii())
        codes = [t.encode() for t in self.trigrams]
        self.pairs = np.zeros(1 << 16, bool)
        self.number = {}
        for i, (a, b, c) in enumerate(codes):
            self.pairs[a << 8 | b] = True
            self.number[a << 16 | b << 8 | c] = i
        self.codes = np.array(sorted(self.number), np.int64)

    def postings(self, texts: list[bytes]) -> dict[str, np.ndarray]:
        """The numbers of the texts that contain each trigram, ascending."""
        found = {t: np.empty(0, np.int64) for t in self.trigrams}
        data = np.frombuffer(b"\0\0".join(texts).translate(_LOWER) + b"\0\0", np.uint8)
        pair = data[:-1].astype(np.uint16)
        pair <<= 8
        pair |= data[1:]
        at = np.flatnonzero(self.pairs[pair[:-1]])
        code = pair[at].astype(np.int64) << 8 | data[at + 2]
        if not len(self.codes):
            return found
        place = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        hit = self.codes[place] == code
        at, place = at[hit], place[hit]
        ends = np.cumsum([len(t) + 2 for t in texts])
        pairs = np.unique(place * len(texts) + np.searchsorted(ends, at, side="right"))
        place, text = np.divmod(pairs, max(1, len(texts)))
        for i, code in enumerate(self.codes.tolist()):
            found[self.trigrams[self.number[code]]] = text[place == i]
        return found


def matching(query, postings: dict[str, np.ndarray], n: int) -> np.ndarray:
    """The numbers of the texts that satisfy a query."""
    if query is True:
        return np.arange(n)
    if isinstance(query, str):
        # A trigram with other than ASCII characters is not indexed.
        return postings.get(query, np.arange(n))
    parts = [matching(q, postings, n) for q in query[1]]
    join = np.intersect1d if query[0] == "and" else np.union1d
    found = parts[0]
    for part in parts[1:]:
        found = join(found, part)
    return found


def spans_of(rule: Rule, compiled: re.Pattern, text: str) -> list[tuple[int, int]]:
    """Leftmost matches that do not overlap, without those whose group is too short."""
    return [
        m.span() for m in compiled.finditer(text) if m.end(rule.group) - m.start(rule.group) >= rule.least
    ]


def _compiled(rule: Rule) -> re.Pattern:
    # A run shorter than a lone repeat's least length cannot become a match, and skipping it cannot
    # move another: the class ends where the run ends.
    if rule.kind == "hex":
        return re.compile(r"[0-9a-f]{%d,}" % rule.least)
    return re.compile(rule.pattern)


class Scanner:
    """Finds the spans of all rules in segments of texts."""

    SEGMENT_BYTES = 4 << 20

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = [(r, _compiled(r), trigram_query(r.pattern)) for r in rules]
        self.lookup = Lookup(set().union(*(trigrams_of(q) for _, _, q in self.rules)))

    def scan(self, texts: list[str | None]) -> list[list[tuple[int, int, str]]]:
        """Per text its ``(start, end, kind)`` in code points, by start, then as rules are listed."""
        found: list[list] = [[] for _ in texts]
        low = size = 0
        for i, text in enumerate(texts):
            size += len(text or "")
            if size >= self.SEGMENT_BYTES or i == len(texts) - 1:
                self._segment(texts[low : i + 1], found[low : i + 1])
                low, size = i + 1, 0
        for spans in found:
            spans.sort(key=lambda s: (s[0], s[3]))
        return [[s[:3] for s in spans] for spans in found]

    def _segment(self, texts: list[str | None], found: list[list]) -> None:
        postings = self.lookup.postings([(t or "").encode() for t in texts])
        for order, (rule, compiled, query) in enumerate(self.rules):
            for i in matching(query, postings, len(texts)).tolist():
                spans = spans_of(rule, compiled, texts[i] or "")
                found[i] += [(start, end, rule.kind, order) for start, end in spans]


# --- on Spark ----------------------------------------------------------------

SPANS = "array<struct<start: int, end: int, kind: string>>"


def with_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(doc_id, secrets)``: the spans of all rules in whole texts, null texts as empty ones."""
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            spans = scanner.scan(batch.column("text").to_pylist())
            rows = [[{"start": s, "end": e, "kind": k} for s, e, k in row] for row in spans]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(rows, pa.list_(span))], ["doc_id", "secrets"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, secrets {SPANS}")


def digest(found: DataFrame) -> DataFrame:
    """Counts, digest and list of the spans of ``with_secrets``, per document."""
    text = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("secrets", lambda s: s["kind"].isin(*BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(F.array_join(F.transform(base, text), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("secrets", text), ",").alias("spans"),
    )


def masked(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``[kind]``; ``n_chars`` follows, if there.

    Overlapping spans are replaced as one, by the kind of the first.
    """
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            new = [_masked(t, s) if s else t for t, s in zip(texts, scanner.scan(texts))]
            at = batch.schema.get_field_index("text")
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    rows = docs.mapInArrow(run, docs.schema)
    if "n_chars" in names:
        changed = F.length("text").cast(docs.schema["n_chars"].dataType)
        rows = rows.withColumn("n_chars", F.when(F.col("text").isNotNull(), changed).otherwise(F.col("n_chars")))
    return rows.select(*names)


def _masked(text: str, spans: list[tuple[int, int, str]]) -> str:
    parts, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            parts += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(parts) + text[at:]
