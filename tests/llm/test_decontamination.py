import random
from collections import Counter

import numpy as np
import pytest

from utterflow.llm import decontamination as dc

WORDS = [f"word{i}" for i in range(400)] + ["the", "of", "and"] * 60


def items_and_docs(seed, n_items=30, n_docs=60):
    rng = random.Random(seed)
    prose = lambda n: " ".join(rng.choices(WORDS, k=n))
    items = [(i, f"{prose(rng.randrange(6, 30))}?\n{prose(rng.randrange(3, 12))}.") for i in range(n_items)]
    docs, planted = [], set()
    for d in range(n_docs):
        parts = [prose(rng.randrange(0, 200))]
        for _ in range(rng.choice([0, 0, 1, 2])):
            item, text = rng.choice(items)
            parts += [text.upper() if rng.random() < 0.3 else text, prose(rng.randrange(50))]
            planted.add((d, item))
        docs.append((d, " ".join(parts)))
    return items, docs, planted


def index_of(items):
    frequency = Counter(t for _, x in items for t in set(dc.terms(x)))
    return dc.Index.of(items, frequency, len(items), np.mean([len(dc.terms(x)) for _, x in items]))


@pytest.mark.parametrize("threshold", [0.1, 0.3, 0.5, 0.8])
@pytest.mark.parametrize("n_items", [1, 3, 30, 150])
def test_block_max_retrieval_is_that_of_scoring_everything(threshold, n_items):
    items, docs, _ = items_and_docs(n_items, n_items, 25)
    index = index_of(items)
    numbers = dc._Numbers(index.number)
    ids, hop, last = [], [], []
    for _, text in docs:
        own = dc.term_numbers(text, numbers)
        for at in range(0, len(own), index.longest):
            part = own[at : at + index.longest]
            ids.append(part)
            hop += [len(last)] * len(part)
            last.append(at + index.longest >= len(own))
    ids, hop, last = np.concatenate(ids), np.array(hop), np.array(last)
    result = {(p, i): s for p, i, s in zip(*dc.retrieve(index, ids, hop, last, threshold))}
    n_blocks = index.highest.shape[1]
    expected = {}
    for h in range(len(last)):
        scores = np.zeros(len(items))
        for t in ids[(hop == h) | ((hop == h + 1) & ~last[h])]:
            if t >= 0:
                own = slice(index.starts[t * n_blocks], index.starts[(t + 1) * n_blocks])
                scores[index.of_item[own]] += index.impact[own]
        expected |= {(h, i): scores[i] for i in np.flatnonzero(scores >= threshold)}
    assert result.keys() == expected.keys()
    assert all(result[k] == pytest.approx(expected[k]) for k in expected)


def test_planted_items_are_found_and_others_not(spark, documents):
    items, docs, planted = items_and_docs(5)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    result = dc.contaminated(documents(docs), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in result} == planted
    assert all(r.score >= 0.7 and r.question_overlap >= 0.5 for r in result)
    clean = dc.decontaminated(documents(docs), benchmark)
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in planted}


def test_an_index_in_parts_finds_the_same(spark, documents, monkeypatch):
    items, docs, planted = items_and_docs(6)
    monkeypatch.setattr(dc, "INDEX_BYTES", 700)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    result = dc.contaminated(documents(docs), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in result} == planted


def test_a_question_without_its_answer_is_no_leak(spark, documents):
    question, answer = "what is the name of the river that runs north of here", "it is the long river"
    benchmark = spark.createDataFrame([(1, f"{question}?\n{answer}.")], "item_id long, text string")
    docs = documents([(1, f"{question} nobody knows"), (2, f"so, {question.upper()}?  {answer}!"), (3, answer)])
    assert [r.doc_id for r in dc.contaminated(docs, benchmark).collect()] == [2]


def test_nulls_empty_texts_and_tables(spark, documents):
    benchmark = spark.createDataFrame(
        [(1, None), (2, ""), (3, " ?! "), (None, "one two three four"), (5, "solo")],
        "item_id long, text string",
    )
    docs = documents([(1, None), (2, ""), (None, "one two three four"), (4, "solo and more"), (4, "solo and more")])
    result = {(r.doc_id, r.item_id) for r in dc.contaminated(docs, benchmark).collect()}
    assert result == {(None, None), (4, 5)}
    assert dc.contaminated(documents([]), benchmark).count() == 0
    assert dc.contaminated(docs, benchmark.limit(0)).count() == 0
    assert dc.decontaminated(docs, benchmark.limit(0)).count() == 5


def test_words_of_several_terms_and_unspaced_scripts():
    assert dc.terms("Don't stop-now") == ["don", "t", "stop", "now"]
    assert dc.terms("日本 go") == ["日", "本", "go"]
    index = index_of([(1, "don't stop now 日本語 please")])
    numbers = dc._Numbers(index.number)
    found = dc.term_numbers("Don't, STOP! now 日本語 other", numbers)
    assert found.tolist() == [index.number.get(t, -1) for t in dc.terms("don t stop now 日本語 other")]


def test_real_items_in_real_texts(sample):
    items = [(r.item_id, r.text) for r in sample("benchmark").collect()]
    docs = sample("documents")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    planted = {(d, i) for d, t in texts for i, x in items if x in t}
    result = {(r.doc_id, r.item_id) for r in dc.contaminated(docs, sample("benchmark")).collect()}
    assert planted and planted <= result
    assert len(result - planted) <= 1
