"""Language identification of mixed texts.

Learned are, per language, the counts of character trigrams in words and the scripts that its words
are written in. A word's script narrows the languages down; its trigrams give it a score in each.
Viterbi then finds the best labels of all words of a text, where every change of language costs
``penalty``, so that spans are labelled and not single words. A text's language is the one with most
letters.
"""

from __future__ import annotations

import functools
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PENALTY = 12.0
UNKNOWN = "und"
FOLDS, HELD_OUT = 3, 1
# The model is fitted on about this many labelled documents, chosen by a hash of the id; all if
# there are fewer.
TRAIN_DOCUMENTS = 20_000
SMOOTHING = 0.5
FOREIGN = -30.0  # score of a word in a language that does not use its script

# First and last code point of letters of a script, by script.
SCRIPTS = {
    "latin": ((0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF), (0xFF21, 0xFF5A)),
    "greek": ((0x370, 0x3FF), (0x1F00, 0x1FFF)),
    "cyrillic": ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)),
    "armenian": ((0x530, 0x58F),),
    "hebrew": ((0x590, 0x5FF),),
    "arabic": ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)),
    "devanagari": ((0x900, 0x97F),),
    "bengali": ((0x980, 0x9FF),),
    "tamil": ((0xB80, 0xBFF),),
    "telugu": ((0xC00, 0xC7F),),
    "thai": ((0xE00, 0xE7F),),
    "georgian": ((0x10A0, 0x10FF),),
    "ethiopic": ((0x1200, 0x139F),),
    "kana": ((0x3040, 0x30FF), (0x31F0, 0x31FF)),
    "han": ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF)),
    "hangul": ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)),
}
SCRIPT_SHARE = 0.01  # of a language's letters that makes a script one of its own


@functools.lru_cache(1 << 16)
def script_of(character: str) -> str:
    code = ord(character)
    for script, ranges in SCRIPTS.items():
        if any(low <= code <= high for low, high in ranges):
            return script
    return "other"


def letters(word: str) -> str:
    """The letters of a word in lower case, composed."""
    return "".join(c for c in unicodedata.normalize("NFC", word.lower()) if c.isalpha())


@functools.cache
def _alphabetic() -> np.ndarray:
    """Which code points are letters."""
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def trigrams(word: str) -> list[str]:
    padded = f"^{word}$"
    return [padded[i : i + 3] for i in range(len(padded) - 2)]


@dataclass
class Model:
    languages: list[str]
    number: dict[str, int]  # of a trigram
    weights: np.ndarray  # log probability by trigram and language; the last row is an unseen one's
    scripts: dict[str, np.ndarray]  # which languages use a script

    @classmethod
    def of(cls, counts: dict[str, dict[str, int]], scripts: dict[str, dict[str, int]]) -> Model:
        """Of counts by language of trigrams and of letters by script."""
        languages = sorted(counts)
        number = {t: i for i, t in enumerate(sorted({t for c in counts.values() for t in c}))}
        table = np.zeros((len(number) + 1, len(languages)))
        for k, language in enumerate(languages):
            for t, n in counts[language].items():
                table[number[t], k] = n
        table += SMOOTHING
        uses: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(languages), bool))
        for k, language in enumerate(languages):
            own = scripts.get(language, {})
            for script, n in own.items():
                uses[script][k] = n >= SCRIPT_SHARE * sum(own.values())
        return cls(languages, number, np.log(table / table.sum(axis=0)), dict(uses))

    def __post_init__(self):
        """Trigrams as sorted numbers over the characters that occur in them."""
        characters = sorted({c for t in self.number for c in t} | {"^", "$"})
        self._id = np.zeros(0x110000, np.int64)  # 0: in no trigram
        self._id[[ord(c) for c in characters]] = np.arange(1, len(characters) + 1)
        self._base = len(characters) + 1
        codes = np.array([self._code(*map(ord, t)) for t in self.number], np.int64)
        by = np.argsort(codes)
        self._codes = codes[by]
        self._rows = np.array(list(self.number.values()), np.int64)[by]
        names = sorted(self.scripts)
        self._uses = np.array(
            [np.zeros(len(self.languages), bool), *(self.scripts[n] for n in names)]
        )
        self._script = np.zeros(0x110000, np.int8)
        for k, name in enumerate(names, 1):
            for low, high in SCRIPTS.get(name, ()):
                self._script[low : high + 1] = k
        if "other" in names:
            known = np.zeros(0x110000, bool)
            for ranges in SCRIPTS.values():
                for low, high in ranges:
                    known[low : high + 1] = True
            self._script[~known] = names.index("other") + 1

    def _code(self, a, b, c):
        return (self._id[a] * self._base + self._id[b]) * self._base + self._id[c]

    def scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of the words' letters by language, and how many letters each has.

        All words at once: their letters end to end, each word in ``^`` and ``$``.
        """
        n_languages = len(self.languages)
        found = np.zeros((len(words), n_languages))
        text = unicodedata.normalize("NFC", "\n".join(words).lower())
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        word = np.cumsum(points == 10)  # split() leaves no line feed in a word
        kept = _alphabetic()[points]
        points, word = points[kept].astype(np.int64), word[kept]
        sizes = np.bincount(word, minlength=len(words))[: len(words)]
        some = np.flatnonzero(sizes)
        if not len(some) or not n_languages:
            return found, sizes
        own = sizes[some]
        ends = np.cumsum(own + 2)
        padded = np.empty(ends[-1], np.int64)
        inside = np.ones(len(padded), bool)
        inside[ends - 1] = inside[ends - own - 2] = False
        padded[ends - own - 2], padded[ends - 1] = ord("^"), ord("$")
        padded[inside] = points
        codes = self._code(padded[:-2], padded[1:-1], padded[2:])
        # The last two windows of a word run into the next.
        windows = np.ones(len(codes) + 2, bool)
        windows[ends - 1] = windows[ends - 2] = False
        codes = codes[windows[: len(codes)]]
        rows = np.full(len(codes), len(self.number))
        if len(self._codes):
            at = np.minimum(np.searchsorted(self._codes, codes), len(self._codes) - 1)
            rows = np.where(self._codes[at] == codes, self._rows[at], rows)
        first = np.cumsum(own) - own  # a word has as many trigrams as letters
        score = np.add.reduceat(self.weights[rows], first, axis=0)
        fit = np.maximum.reduceat(self._uses[self._script[points]].astype(np.int8), first, axis=0)
        foreign = (fit == 0) & fit.any(axis=1, keepdims=True)
        found[some] = np.where(foreign, score.max(axis=1, keepdims=True) + FOREIGN, score)
        return found, sizes

    def score(self, word: str) -> np.ndarray:
        """Scores of a word's letters by language."""
        return self.scores([word])[0][0]


class _Words(dict):
    """Rows of scores by raw word, and the number of letters of each."""

    LIMIT = 300_000

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.scores, self.weights = self.model.scores([])

    def rows(self, words: list[str]) -> np.ndarray:
        """The row of each word; those not seen before are scored together."""
        if len(self) > self.LIMIT:
            self.reset()
        new = sorted(set(words).difference(self))
        if new:
            scores, weights = self.model.scores(new)
            self.update(zip(new, range(len(self), len(self) + len(new))))
            self.scores = np.concatenate([self.scores, scores])
            self.weights = np.concatenate([self.weights, weights])
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def viterbi(scores: np.ndarray, rows: np.ndarray, lengths: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of every word of several texts.

    ``rows`` are the texts' words end to end, as rows of ``scores``. All texts move on together by
    one word, the longer ones further. Where a language is as good by staying as by a change, it
    stays; of equal languages the first is taken.
    """
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    starts = (np.cumsum(lengths) - lengths)[order]
    sizes = lengths[order]
    labels = np.zeros(len(rows), np.int16)
    if not len(order) or not scores.shape[1]:
        return labels
    longest = int(sizes[0])
    active = np.searchsorted(-sizes, -np.arange(longest), side="left")  # texts with a word t
    moved = np.zeros((len(rows), scores.shape[1]), bool)
    came_from = np.zeros(len(rows), np.int16)
    value = scores[rows[starts]]
    final = np.zeros(len(order), np.int16)
    for t in range(1, longest):
        n = active[t]
        if n < len(value):
            final[n : len(value)] = value[n:].argmax(axis=1)
            value = value[:n]
        best = value.argmax(axis=1)
        change = value[np.arange(n), best] - penalty
        at = starts[:n] + t
        came_from[at] = best
        change = change[:, None]
        moved[at] = value < change
        value = np.maximum(value, change) + scores[rows[at]]
    final[: len(value)] = value.argmax(axis=1)
    label = final.copy()
    for t in range(longest - 1, -1, -1):
        n = active[t]
        at = starts[:n] + t
        labels[at] = label[:n]
        left = moved[at, label[:n]]
        label[:n] = np.where(left, came_from[at], label[:n])
    return labels


class Identifier:
    SLICE_CHARS = 4 << 20

    def __init__(self, model: Model, penalty: float = PENALTY):
        self.model, self.penalty = model, penalty
        self.words = _Words(model)

    def labels(self, texts: list[str | None]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
        """Per text its words, their labels, and their numbers of letters."""
        low = size = 0
        for i, text in enumerate(texts):
            size += len(text or "")
            if size >= self.SLICE_CHARS or i == len(texts) - 1:
                yield from self._slice(texts[low : i + 1])
                low, size = i + 1, 0

    def _slice(self, texts: list[str | None]):
        words = self.words
        split = [(t or "").split() for t in texts]
        rows = words.rows([w for s in split for w in s])
        lengths = np.array([len(s) for s in split], np.int64)
        labels = viterbi(words.scores, rows, lengths, self.penalty)
        ends = np.cumsum(lengths)
        for own, n, end in zip(split, lengths.tolist(), ends.tolist()):
            yield own, labels[end - n : end], words.weights[rows[end - n : end]]

    def predict(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        """Per text the language of most letters, and its share of them."""
        n_languages = len(self.model.languages)
        for _, labels, weights in self.labels(texts):
            held = np.bincount(labels, weights=weights, minlength=n_languages)
            total = held.sum()
            if not total or not n_languages:
                yield UNKNOWN, 0.0
            else:
                k = int(held.argmax())
                yield self.model.languages[k], float(held[k] / total)

    def spans(self, text: str | None) -> list[tuple[int, int, str]]:
        """``(start, end, language)`` of the labelled spans of a text, in code points."""
        ((words, labels, weights),) = self.labels([text])
        found: list[tuple[int, int, str]] = []
        at = 0
        for word, label, weight in zip(words, labels.tolist(), weights.tolist()):
            start = text.index(word, at)
            at = start + len(word)
            if not weight:
                continue
            language = self.model.languages[label]
            if found and found[-1][2] == language:
                found[-1] = (found[-1][0], at, language)
            else:
                found.append((start, at, language))
        return found


# --- on Spark ----------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    """Whether a document's id belongs to the fold that is never learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS == HELD_OUT


def fitted(docs: DataFrame, train_documents: int = TRAIN_DOCUMENTS) -> Model:
    """A model of the labelled documents outside the held-out fold.

    Tasks count trigrams; the sums, whose number is bounded by ``train_documents``, go to the
    driver. Labels are the languages that occur.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).where(
        ~held_out(F.col("doc_id"))
    )
    n = known.count()
    if n > train_documents:
        share = F.pmod(F.xxhash64(F.lit("train"), "doc_id"), F.lit(1 << 32)) / float(1 << 32)
        known = known.where(share < train_documents / n)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for language, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "text"))):
                found[language].update(text.split())
        for language, words in found.items():
            parts: Counter = Counter()
            scripts: Counter = Counter()
            for word, n in words.items():
                if own := letters(word):
                    for t in trigrams(own):
                        parts[t] += n
                    for c in own:
                        scripts[script_of(c)] += n
            for kind, counter in (("trigram", parts), ("script", scripts)):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([language] * len(counter), pa.string()),
                        pa.array([kind] * len(counter), pa.string()),
                        pa.array(counter.keys(), pa.string()),
                        pa.array(counter.values(), pa.int64()),
                    ],
                    ["lang", "kind", "part", "n"],
                )

    rows = known.select("lang", "text").mapInArrow(count, "lang string, kind string, part string, n bigint")
    sums = rows.groupBy("lang", "kind", "part").agg(F.sum("n").alias("n"))
    counts: dict = {"trigram": defaultdict(dict), "script": defaultdict(dict)}
    for language, kind, part, n in sums.collect():
        counts[kind][language][part] = n
    return Model.of(counts["trigram"], counts["script"])


def predicted(docs: DataFrame, model: Model | None = None, penalty: float = PENALTY) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` of whole texts.

    Only the text decides. ``lang_pred`` is ``und`` with score 0 for null texts, texts without a
    letter, and if nothing was learned.
    """
    model = fitted(docs) if model is None else model
    spread = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Identifier(spread.value, penalty)
        for batch in batches:
            found = list(own.predict(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
