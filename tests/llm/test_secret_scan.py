import hashlib
import random
import re

import pytest

from utterflow.llm import secret_scan as ss

PIECES = [
    "password", "PassWd", "secret", "TOKEN", "api_key", "apikey", "aKIA", "AKIA", "AKIAABCD1234EFGH",
    "deadbeef", "0123456789abcdef", ":", "=", " ", "'", '"', "x", "é", "\n", "-----BEGIN ", "PRIVATE KEY-----",
    "RSA ", "ghp_", "xoxb-", "sk_live_", "eyJ", ".", "A" * 20, "ſecret", "toKen",
]


def plain(text):
    found = []
    for k, rule in enumerate(ss.RULES):
        for m in re.finditer(rule.pattern, text or ""):
            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                found.append((m.start(), k, m.end(), rule.kind))
    return [(s, e, kind) for s, _, e, kind in sorted(found)]


def random_texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randrange(40))) for _ in range(n)]


def test_scan_finds_what_the_expressions_find_on_all_texts():
    texts = [None, "", *random_texts(1, 3000)]
    assert ss.Scanner().scan(texts) == [plain(t) for t in texts]


def test_segments_do_not_change_the_result(monkeypatch):
    texts = random_texts(2, 300)
    monkeypatch.setattr(ss.Scanner, "SEGMENT_BYTES", 50)
    assert ss.Scanner().scan(texts) == [plain(t) for t in texts]


@pytest.mark.parametrize(
    ("pattern", "query"),
    [
        ("abcd", ("and", ("abc", "bcd"))),
        ("[0-9a-f]+", True),
        ("abc|xyz", ("or", ("abc", "xyz"))),
        ("abc|x", True),
        ("ABC.*xyz", ("and", ("abc", "xyz"))),
        ("(abc)*", True),
        ("(?:abc)+", "abc"),
        ("ab", True),
        ("", True),
        ("a?bcd", ("or", ("bcd", ("and", ("abc", "bcd"))))),
    ],
)
def test_queries_of_expressions(pattern, query):
    found = ss.trigram_query(pattern)
    if pattern == "a?bcd":
        assert ss.trigrams_of(found) == {"abc", "bcd"}
    else:
        assert found == query


def test_rules_without_trigrams_are_the_hex_rule_only():
    assert [r.kind for r in ss.RULES if ss.trigram_query(r.pattern) is True] == ["hex"]


def test_digest(documents):
    texts = [(i, t) for i, t in enumerate([None, "", *random_texts(3, 200)])]
    rows = {r.doc_id: r for r in ss.digest(ss.with_secrets(documents(texts))).collect()}
    for i, text in texts:
        spans = plain(text)
        base = [s for s in spans if s[2] in ss.BASE_KINDS]
        for kind in ss.BASE_KINDS:
            assert rows[i][f"n_{kind}"] == sum(k == kind for *_, k in spans)
        listed = lambda x: ",".join(f"{k}:{s}:{e}" for s, e, k in x)
        assert rows[i].base_sha256 == hashlib.sha256(listed(base).encode()).hexdigest()
        assert rows[i].spans == listed(spans)


def test_masking_keeps_rows_and_columns(documents):
    rows = [(1, "my token = abcdefgh12 é"), (2, None), (3, "clean"), (3, "clean"), (4, "f" * 40)]
    docs = documents(rows)
    masked = ss.masked(docs)
    assert masked.schema.names == docs.schema.names
    found = sorted((r.doc_id, r.text, r.n_chars) for r in masked.where("text IS NOT NULL").collect())
    assert found == [(1, "my [assign] é", 13), (3, "clean", 5), (3, "clean", 5), (4, "[hex]", 5)]
    assert masked.where("text IS NULL").count() == 1
    assert all(not s for s in ss.Scanner().scan([t for _, t, _ in found]))
    assert ss.masked(documents([])).count() == 0


def test_overlapping_secrets_are_masked_as_one(documents):
    text = 'token = "' + "0a" * 20 + '"'
    (row,) = ss.masked(documents([(1, text)])).collect()
    assert row.text == '[assign]"'


def test_a_very_long_text():
    text = "abcdef " * 300_000 + "secret: abcdefghij"
    assert ss.Scanner().scan([text]) == [[(2_100_000, 2_100_018, "assign")]]
