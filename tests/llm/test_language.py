import zlib
from itertools import product

import numpy as np
import pytest

from utterflow.llm import language as lg

TRAINING = {
    "aa": {"the house stands near the water and the wind": 30},
    "bb": {"ein haus steht nahe dem wasser und der wind": 30},
    "cc": {"дом стоит у воды и ветер": 30},
}


@pytest.fixture(scope="module")
def model():
    counts, scripts = {}, {}
    for language, texts in TRAINING.items():
        counts[language], scripts[language] = {}, {}
        for text, n in texts.items():
            for word in text.split():
                for t in lg.trigrams(word):
                    counts[language][t] = counts[language].get(t, 0) + n
                for c in word:
                    s = lg.script_of(c)
                    scripts[language][s] = scripts[language].get(s, 0) + n
    return lg.Model.of(counts, scripts)


def test_viterbi_is_the_best_of_all_labellings():
    rng = np.random.default_rng(1)
    scores = rng.normal(size=(40, 3)) * 3
    lengths = np.array([0, 1, 6, 3, 6, 0, 5])
    rows = rng.integers(0, 40, lengths.sum())
    for penalty in (0.0, 1.5, 100.0):
        labels = lg.viterbi(scores, rows, lengths, penalty)
        at = 0
        for n in lengths:
            own = rows[at : at + n]
            value = lambda path: sum(scores[r, k] for r, k in zip(own, path)) - penalty * sum(
                a != b for a, b in zip(path, path[1:])
            )
            best = max((value(p) for p in product(range(3), repeat=int(n))), default=0)
            assert value(labels[at : at + n].tolist()) == pytest.approx(best)
            at += n


def test_viterbi_with_two_hundred_languages():
    rng = np.random.default_rng(2)
    scores = rng.normal(size=(30, 200))
    favourite = rng.integers(128, 200, 30)
    scores[np.arange(30), favourite] += 100.0
    lengths = np.array([4, 0, 7, 3])
    rows = rng.integers(0, 30, lengths.sum())
    labels = lg.viterbi(scores, rows, lengths, 0.5)
    assert labels.tolist() == favourite[rows].tolist()


def test_spans_of_a_mixed_text(model):
    text = "the house stands near the water  ein haus steht nahe dem wasser, дом стоит у воды 12"
    spans = lg.Identifier(model, penalty=3.0).spans(text)
    assert [text[s:e] for s, e, _ in spans] == [
        "the house stands near the water", "ein haus steht nahe dem wasser,", "дом стоит у воды",
    ]
    assert [k for *_, k in spans] == ["aa", "bb", "cc"]


def test_scripts_narrow_the_languages(model):
    score = model.score("неизвестно")
    assert score.argmax() == model.languages.index("cc")
    assert score.max() - sorted(score)[-2] >= -lg.FOREIGN
    assert np.isfinite(model.score("日本")).all()


def test_predictions_without_letters_and_in_slices(model, monkeypatch):
    texts = [None, "", "12 34 !", "the house", "дом", "12 ein haus"]
    expected = [("und", 0.0)] * 3 + [("aa", 1.0), ("cc", 1.0), ("bb", 1.0)]
    assert list(lg.Identifier(model).predict(texts)) == expected
    monkeypatch.setattr(lg.Identifier, "SLICE_CHARS", 5)
    monkeypatch.setattr(lg._Words, "LIMIT", 1)
    assert list(lg.Identifier(model).predict(texts)) == expected


def test_held_out_accuracy(sample):
    docs = sample("documents")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    rows = lg.predicted(docs).collect()
    assert len(rows) == len(truth)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) >= 0.97


def test_labels_of_the_held_out_fold_are_not_read(spark):
    rows = [(i, "the house stands here" if i % 2 else "ein haus steht hier", "en" if i % 2 else "de", "s", 1) for i in range(60)]
    held = {i for i in range(60) if zlib.crc32(str(i).encode()) % 3 == 1}
    wrong = [(i, t, "xx" if i in held else k, s, n) for i, t, k, s, n in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    first = sorted(tuple(r) for r in lg.predicted(spark.createDataFrame(rows, schema)).collect())
    assert first == sorted(tuple(r) for r in lg.predicted(spark.createDataFrame(wrong, schema)).collect())


def test_a_bounded_sample_for_training(documents):
    rows = [(i, "the house" if i % 2 else "ein haus", "en" if i % 2 else "de", "s", 1) for i in range(300)]
    assert lg.fitted(documents(rows), train_documents=60).languages == ["de", "en"]


def test_nothing_to_learn_from(documents):
    rows = [(1, "some text", None, None, None), (None, None, None, None, None), (1, "some text", None, None, None)]
    found = lg.predicted(documents(rows)).collect()
    assert [(r.lang_pred, r.score) for r in found] == [("und", 0.0)] * 3
    assert lg.predicted(documents([])).count() == 0
