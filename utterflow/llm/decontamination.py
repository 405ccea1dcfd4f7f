"""Benchmark decontamination: BM25 over test items, block-max WAND, and an overlap check.

The index holds the test items. Training texts are cut into overlapping passages, and every passage
is a query that retrieves all items above a score. A score is BM25 divided by what the item scores
against itself, so one threshold fits items of any length, and the impacts that the index stores
are shares of it.

Block-max WAND skips what cannot reach the threshold. The items are divided into at most ``BLOCKS``
ranges, and the index knows the largest impact of every term in every range. A range stays for a
passage only if these maxima, summed over the terms of the passage, reach the threshold; only then
are the postings of the terms in this range read. This is done for a batch of passages at once, with
one sum of rows of maxima per half passage.

Bounds are never below a score, so the result is that of scoring all pairs. Retrieved items are
verified: the passage must contain enough word n-grams of the item's question and of its answer.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K1, B = 1.2, 0.75
BLOCKS = 64
BLOCK_ITEMS = 4  # items of a range at least
# An index of more text than this is built in parts, each of which is held against all documents.
INDEX_BYTES = 16 << 20
GRAM = 3
SLICE_CHARS = 1 << 20  # of text that is scored at once

# Scripts without blanks between words: each character is a term.
_UNSPACED = "฀-๿぀-ヿ㐀-䶿一-鿿"
_TERM = re.compile(f"[{_UNSPACED}]|[^\\W_{_UNSPACED}]+")


def terms(text: str | None) -> list[str]:
    """Words in lower case without punctuation; single characters of unspaced scripts."""
    return _TERM.findall((text or "").lower())


def question_and_answer(text: str | None) -> tuple[list[str], list[str]]:
    """Terms of a test item: the answer is its last line or sentence, or its second half."""
    parts = [p for p in map(terms, re.split(r"\n|(?<=[.?!])\s", text or "")) if p]
    if len(parts) > 1:
        return [t for p in parts[:-1] for t in p], parts[-1]
    whole = parts[0] if parts else []
    half = (len(whole) + 1) // 2
    return whole[:half], whole[half:]


def gram_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """The n-gram of term numbers at each place, as one number."""
    n = max(0, len(ids) - size + 1)
    found = np.zeros(n, np.uint64)
    for k in range(size):
        found = (found ^ ids[k : k + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        found ^= found >> np.uint64(29)
    return found


def grams(ids: np.ndarray, size: int) -> np.ndarray:
    """The distinct n-grams of a sequence of term numbers."""
    return np.unique(gram_hashes(ids, size))


@dataclass
class Index:
    """Postings by term and item range; impacts are shares of an item's score against itself."""

    items: list
    number: dict[str, int]
    of_item: np.ndarray
    impact: np.ndarray
    highest: np.ndarray  # impact by term and range; a row of zeros for unknown terms
    starts: np.ndarray  # of the postings by term and range, and where the term's end
    questions: list[np.ndarray]
    answers: list[np.ndarray]
    gram_sizes: list[tuple[int, int]]
    all_grams: np.ndarray  # those of GRAM terms
    longest: int

    @classmethod
    def of(cls, rows: list, found_in: dict[str, int], n_items: int, mean_length: float) -> Index:
        """Of ``(item_id, text)`` rows; document frequencies and lengths are those of all items."""
        number: dict[str, int] = {}
        items, questions, answers, sizes, counts, totals = [], [], [], [], [], []
        longest = 1
        for item, text in rows:
            q, a = question_and_answer(text)
            if not q:
                continue  # an item without a term matches nothing
            ids = np.array([number.setdefault(t, len(number)) for t in q + a], np.int64)
            longest = max(longest, len(ids))
            counts.append(np.unique(ids, return_counts=True))
            totals.append(len(ids))
            gq, ga = min(GRAM, len(q)), min(GRAM, len(a))
            items.append(item)
            questions.append(grams(ids[: len(q)], gq))
            answers.append(grams(ids[len(q) :], ga) if a else np.empty(0, np.uint64))
            sizes.append((gq, ga))
        frequency = np.array([found_in[t] for t in number], float)
        weight = np.log1p((n_items - frequency + 0.5) / (frequency + 0.5))
        none = np.empty(0, np.int64)
        term, of_item, impact = [none], [none], [np.empty(0)]
        for i, ((ids, tf), total) in enumerate(zip(counts, totals)):
            part = weight[ids] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * total / mean_length))
            term.append(ids)
            of_item.append(np.full(len(ids), i))
            # Against itself an item has each term as often as it has it.
            impact.append(part / (part * tf).sum())
        term, of_item, impact = map(np.concatenate, (term, of_item, impact))
        by = np.lexsort((of_item, term))
        term, of_item, impact = term[by], of_item[by], impact[by]
        n_blocks = max(1, min(BLOCKS, len(items) // BLOCK_ITEMS))
        block = of_item * n_blocks // max(1, len(items))
        cell = term * n_blocks + block
        cells = len(number) * n_blocks
        highest = np.zeros(cells + n_blocks)
        np.maximum.at(highest, cell, impact)
        starts = np.searchsorted(cell, np.arange(cells + n_blocks + 1))
        # Rounded up, so that a bound stays one.
        highest = np.nextafter(highest.astype(np.float32), np.float32(np.inf)) * (highest > 0)
        return cls(
            items, number, of_item, impact, highest.astype(np.float32).reshape(-1, n_blocks),
            starts, questions, answers, sizes,
            np.unique(np.concatenate([np.empty(0, np.uint64), *questions, *answers])), longest,
        )


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges, and which range each is of."""
    of = np.repeat(np.arange(len(starts)), lengths)
    begin = np.cumsum(lengths) - lengths
    return starts[of] + np.arange(len(of)) - begin[of], of


def retrieve(
    index: Index, ids: np.ndarray, hop: np.ndarray, last: np.ndarray, threshold: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All (passage, item, score) at or above the threshold.

    ``ids`` are term numbers (-1: not in the index), ``hop`` ascending numbers of half passages.
    Passage h is made of halves h and h + 1, or of h alone where ``last[h]`` says that h ends its
    document. A term counts as often as the passage has it.
    """
    none = np.empty(0, np.int64)
    n_items, n_hops, n_blocks = len(index.items), len(last), index.highest.shape[1]
    known = ids >= 0
    ids, hop = ids[known], hop[known]
    if not n_items or not len(ids):
        return none, none, np.empty(0)
    first = np.searchsorted(hop, np.arange(n_hops + 1))
    halves = np.zeros((n_hops + 1, n_blocks), np.float32)
    filled = np.flatnonzero(np.diff(first))
    halves[filled] = np.add.reduceat(index.highest[ids], first[filled], axis=0)
    bound = halves[:-1] + np.where(last, np.float32(0), np.float32(1))[:, None] * halves[1:]
    # The slack covers the rounding of the sums.
    passage, block = np.nonzero(bound >= threshold * (1 - 1e-4))
    # The terms of the passages that are left, once per range that is left.
    end = first[passage + np.where(last[passage], 1, 2)]
    at, of = _ranges(first[passage], end - first[passage])
    cell = ids[at] * n_blocks + block[of]
    place, row = _ranges(index.starts[cell], index.starts[cell + 1] - index.starts[cell])
    key = passage[of[row]] * n_items + index.of_item[place]
    pairs, at = np.unique(key, return_inverse=True)
    score = np.bincount(at, weights=index.impact[place], minlength=len(pairs))
    hit = score >= threshold
    return (*np.divmod(pairs[hit], n_items), score[hit])


class _Numbers(dict):
    """Term numbers of a raw word: one number, or a place in ``several`` below -1."""

    LIMIT = 1 << 20  # words remembered at a time

    def __init__(self, number: dict[str, int]):
        super().__init__()
        self.number, self.several = number, [()]

    def __missing__(self, word: str) -> int:
        if len(self) > self.LIMIT:
            self.clear()
            self.several = [()]
        found = [self.number.get(t, -1) for t in terms(word)]
        if len(found) == 1:
            self[word] = found[0]
        else:
            self[word] = -1 - len(self.several)
            self.several.append(tuple(found))
        return self[word]


def term_numbers(text: str, numbers: _Numbers) -> np.ndarray:
    words = text.split()
    if len(numbers) > numbers.LIMIT // 2:
        numbers.clear()
        numbers.several = [()]
    ids = [numbers[w] for w in words]
    if min(ids, default=0) < -1:
        several = numbers.several
        ids = [i for k in ids for i in ((k,) if k >= -1 else several[-1 - k])]
    return np.array(ids, np.int64)


COLUMNS = "item_id {item}, score double, question_overlap double, answer_overlap double"


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    score: float = 0.7,
    question_overlap: float = 0.5,
    answer_overlap: float = 0.5,
) -> DataFrame:
    """``(doc_id, item_id, score, question_overlap, answer_overlap)`` of test items in documents.

    One row per pair, with the best passage. Passages are twice as long as the longest item of the
    index and start every such item's length, so each item lies in one of them whole. Null texts
    match nothing; a document that occurs in two rows has its pairs twice.
    """
    doc_type = docs.schema["doc_id"].dataType.simpleString()
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    columns = f"doc_id {doc_type}, " + COLUMNS.format(item=item_type)
    found = None
    for index in _indexes(benchmark):
        spread = docs.sparkSession.sparkContext.broadcast(index)

        def run(
            batches: Iterator[pa.RecordBatch], spread=spread
        ) -> Iterator[pa.RecordBatch]:
            own = spread.value
            numbers = _Numbers(own.number)
            for batch in batches:
                rows = list(
                    _verified(own, numbers, batch, score, question_overlap, answer_overlap)
                )
                ids = batch.column("doc_id").take(pa.array([r[0] for r in rows], pa.int64()))
                rest = list(zip(*rows))[1:] or [[]] * 4
                yield pa.RecordBatch.from_arrays([ids, *map(pa.array, rest)], names)

        names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap"]
        part = docs.select("doc_id", "text").mapInArrow(run, columns)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], columns)
    return found


def _indexes(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes of at most about ``INDEX_BYTES`` of text each, made on the driver one by one."""
    rows = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
    n_items, size = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    n_parts = max(1, -(-(size or 0) // INDEX_BYTES))
    numbered = rows.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_parts)))
    words = F.pandas_udf(lambda s: s.map(lambda t: sorted(set(terms(t)))), "array<string>")
    lengths = F.pandas_udf(lambda s: s.map(lambda t: len(terms(t))), "bigint")
    mean = rows.agg(F.avg(lengths("text"))).first()[0] or 1.0
    found_in = rows.select(F.explode(words("text")).alias("term")).groupBy("term").count()
    for part in range(n_parts if n_items else 0):
        own = numbered.where(F.col("part") == part)
        own_terms = own.select(F.explode(words("text")).alias("term")).distinct()
        frequency = {r[0]: r[1] for r in found_in.join(own_terms, "term").collect()}
        items = [(r[0], r[1]) for r in own.select("item_id", "text").sort("item_id").collect()]
        yield Index.of(items, frequency, n_items, max(mean, 1.0))


def _verified(index, numbers, batch, *limits):
    """``(row, item, score, overlaps)`` of one batch: passages, retrieval, overlap check."""
    texts = batch.column("text").to_pylist()
    slices, weight = [0], 0
    for i, t in enumerate(texts):
        weight += len(t or "")
        if weight > SLICE_CHARS:
            slices.append(i + 1)
            weight = 0
    for low, high in zip(slices, [*slices[1:], len(texts)]):
        yield from _verified_slice(index, numbers, texts[low:high], low, limits)


def _verified_slice(index, numbers, texts, offset, limits):
    score, question_overlap, answer_overlap = limits
    size = index.longest
    parts = [term_numbers(t or "", numbers) for t in texts]
    lengths = np.array([len(p) for p in parts], np.int64)
    ids = np.concatenate(parts) if parts else np.empty(0, np.int64)
    halves = -(-lengths // size)
    row_of = np.repeat(np.arange(len(parts)), halves)
    first_half = np.cumsum(halves) - halves
    begin = np.cumsum(lengths) - lengths
    within = np.arange(len(ids)) - np.repeat(begin, lengths)
    hop = np.repeat(first_half, lengths) + within // size
    last = np.zeros(len(row_of), bool)
    last[(first_half + halves - 1)[halves > 0]] = True
    passages, items, scores = retrieve(index, ids, hop, last, score)
    rows = row_of[passages]
    starts = begin[rows] + (passages - first_half[rows]) * size
    ends = np.minimum(starts + 2 * size, begin[rows] + lengths[rows])
    # Most pairs fail already by the n-grams of any item that the passage has.
    known = np.isin(gram_hashes(ids, GRAM), index.all_grams)
    upto = np.r_[0, np.cumsum(known), np.full(GRAM, known.sum())]
    least = np.array(
        [
            max(question_overlap * len(q) * (gq == GRAM), answer_overlap * len(a) * (ga == GRAM))
            for q, a, (gq, ga) in zip(index.questions, index.answers, index.gram_sizes)
        ]
        or [0.0]
    )
    open_ = upto[ends] - upto[starts] >= least[items]
    best: dict[tuple[int, int], tuple] = {}
    for row, item, found, at, end in zip(*(x[open_] for x in (rows, items, scores, starts, ends))):
        own = ids[at:end]
        gq, ga = index.gram_sizes[item]
        q = np.isin(index.questions[item], grams(own, gq)).mean()
        answer = index.answers[item]
        a = np.isin(answer, grams(own, ga)).mean() if len(answer) else 1.0
        if q >= question_overlap and a >= answer_overlap:
            key = (int(row), int(item))
            best[key] = max(best.get(key, (0.0,)), (float(found), float(q), float(a)))
    for (row, item), values in sorted(best.items()):
        yield (offset + row, index.items[item], *values)


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a test item in them, with the columns of ``docs``."""
    found = contaminated(docs.where("doc_id IS NOT NULL"), benchmark)
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
