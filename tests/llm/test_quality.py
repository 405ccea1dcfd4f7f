import random

import pytest

from tests.llm import brute
from utterflow.llm import quality

EDGES = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, "one"),
    (5, "a b c d e"),
    (6, "a a a a a a"),
    (7, "x y z w v x y z w v"),
    (8, "#*$%&|<> a\n\na\n a\n#\n\n \n"),
    (9, "line one\nline one\nline two\nline one\n"),
    (10, "a b c d e"),
    (11, "ABC!! DEF!! " * 30),
    (12, "a b c d e " * 3000),
]


def test_measurements_are_those_of_the_plain_version(documents, texts):
    rng = random.Random(1)
    rows = EDGES + list(texts.items())[:60]
    rows += [(100 + i, " ".join(rng.choices("ab c de\nf", k=rng.randrange(60)))) for i in range(60)]
    rows = [(i, t) for i, (_, t) in enumerate(rows)]
    result = quality.judged(quality.ledger(documents(rows))).collect()
    assert len(result) == len(rows)
    by_id = {r.doc_id: r for r in result}
    for i, text in rows:
        for name, value in brute.quality(text).items():
            assert by_id[i][name] == value, (text, name)
        assert not (by_id[i].base_failed and by_id[i].kept)


def test_policies_share_one_ledger(documents):
    good = " ".join(f"word{i}" for i in range(40))
    rows = [(1, good), (2, "SHOUT!! " + " ".join(f"LOUD{i}!!" for i in range(40))), (3, "short")]
    ledger = quality.ledger(documents(rows))
    kept = lambda p: {r.doc_id for r in quality.judged(ledger, p).where("kept").collect()}
    assert kept("v2") == {1}
    assert kept("v1") == {1, 2}


def test_each_word_said_twice_is_a_stutter(documents):
    text = " ".join(f"w{i} w{i}" for i in range(20))
    (row,) = quality.judged(quality.ledger(documents([(1, text)]))).collect()
    assert (row.n_stutters, row.n_repeat_words, row.failures, row.kept) == (20, 0, 128, False)


def test_ablations_count_what_only_one_rule_rejects(documents):
    good = " ".join(f"word{i}" for i in range(40))
    rows = [(1, good), (2, "few words"), (3, ""), (4, " ".join(f"w{i}#*" for i in range(40)))]
    result = {r.rule: (r.failed, r.only_this) for r in quality.ablations(quality.ledger(documents(rows))).collect()}
    assert result["few_words"] == (2, 1)  # the empty text also fails by its word length
    assert result["symbols"] == (1, 1)
    assert result["repeated_lines"] == (0, 0)


def test_bits_are_distinct():
    assert len({r.bit for r in quality.RULES}) == len(quality.RULES)


def test_clean_documents_keep_their_columns(spark):
    good = " ".join(f"word{i}" for i in range(40))
    docs = spark.createDataFrame(
        [(1, good, 9, "x"), (2, "bad", 9, None)], "doc_id long, text string, n_words long, kept string"
    )
    kept = quality.clean_documents(docs)
    assert kept.columns == docs.columns
    assert [tuple(r) for r in kept.collect()] == [(1, good, 9, "x")]


def test_empty_table(documents):
    assert quality.judged(quality.ledger(documents([]))).count() == 0


@pytest.mark.parametrize("step", ["ledger", "clean_documents"])
def test_no_python_and_no_shuffle(documents, step):
    plan = getattr(quality, step)(documents([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_scripts_without_blanks_have_no_word_length(documents):
    chinese = " ".join(f"这是一个没有空格的句子它的长度超过十四个字{c}。" for c in "甲乙丙丁戊己庚辛壬癸子丑")
    thai = " ".join(f"ประโยคภาษาไทยไม่มีช่องว่างระหว่างคำ{c}" for c in "กขคงจฉชซญดตถ")
    japanese = " ".join(f"これは空白のない日本語の文章でとても長い{c}。" for c in "あいうえおかきくけこさし")
    latin = " ".join(f"{c}" * 20 for c in "abcdefghijkl")
    rows = quality.judged(quality.ledger(documents([(1, chinese), (2, thai), (3, japanese), (4, latin)])))
    assert {r.doc_id: (r.kept, r.failures) for r in rows.collect()} == {
        1: (True, 0), 2: (True, 0), 3: (True, 0), 4: (False, 64)
    }


def test_published_policies_have_their_threshold_of_symbols(documents):
    some = " ".join(f"word{i}" + "#" * (i % 5 == 0) for i in range(40))
    many = " ".join(f"word{i}" + "#" * (i % 3 == 0) for i in range(40))
    ledger = quality.ledger(documents([(1, some), (2, many)]))
    kept = lambda p: {r.doc_id for r in quality.judged(ledger, p).where("kept").collect()}
    assert (kept("v1"), kept("v2"), kept("v3")) == ({1}, {1}, set())
