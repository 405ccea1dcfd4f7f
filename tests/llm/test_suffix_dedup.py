import random

import numpy as np
import pytest

from tests.llm import brute
from utterflow.llm import suffix_dedup as sd


def array(data):
    return np.frombuffer(data, np.uint8)


@pytest.mark.parametrize("alphabet", [b"a", b"ab", b"abc", b"\0a", bytes(range(256))])
def test_suffix_array_and_common_prefixes(alphabet):
    rng = random.Random(len(alphabet))
    for n in [0, 1, 2, 3, 9, 17, 64, 150]:
        data = bytes(rng.choice(alphabet) for _ in range(n))
        order = sd.suffix_array(array(data), depth=200)
        assert order.tolist() == sorted(range(n), key=lambda i: data[i:])
        shared = sd.common_prefixes(array(data), order, 50)
        for k in range(1, n):
            a, b = data[order[k - 1] :], data[order[k] :]
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert shared[k] == min(same, 50)


def test_equal_strings_have_equal_anchors():
    rng = random.Random(4)
    core = bytes(rng.choice(b"abcd ") for _ in range(50))
    places = set()
    for _ in range(20):
        before = bytes(rng.choice(b"abcd ") for _ in range(rng.randrange(80)))
        data = before + core + bytes(rng.choice(b"abcd ") for _ in range(40))
        hashes = sd.string_hashes(array(data), sd.ANCHOR)
        places.add(int(sd.anchor_places(hashes, 50 - sd.ANCHOR + 1)[len(before)]) - len(before))
    assert len(places) == 1


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 8)))
    passages = [" ".join(word() for _ in range(rng.randrange(8, 30))) for _ in range(6)]
    rows = {}
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(0, 6)):
            parts.append(rng.choice(passages) if rng.random() < 0.4 else " ".join(word() for _ in range(20)))
        rows[i * 3] = " ".join(parts)
    rows[500] = rows[3]
    rows[501] = rows[3]
    rows[502] = "x" * 49
    rows[503] = "x" * 49
    rows[504] = "x" * 300
    rows[505] = "x" * 200
    rows[506] = None
    rows[507] = ""
    return rows


def found(docs, **options):
    result = sd.repeated_strings_removed(docs, **options).collect()
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in result}


@pytest.mark.parametrize("chunk_bytes", [1 << 22, 700])
def test_removal_is_that_of_the_plain_version(documents, chunk_bytes):
    rows = corpus(chunk_bytes)
    docs = documents(list(rows.items()))
    assert found(docs, chunk_bytes=chunk_bytes) == brute.repeated_strings(rows)


def test_other_length_and_kept_text(documents):
    rows = corpus(9, 20)
    docs = documents(list(rows.items()))
    result = sd.repeated_strings_removed(docs, length=30, kept_text=True).collect()
    expected = brute.repeated_strings(rows, 30)
    assert {r.doc_id: r.kept_sha256 for r in result} == {i: e[3] for i, e in expected.items()}
    assert all(len(r.kept) == r.n_bytes - r.n_removed for r in result)
    with pytest.raises(ValueError):
        sd.repeated_strings_removed(docs, length=10)


def test_equal_and_missing_ids(documents):
    text = "the same text that is long enough to count as a repeated string of bytes"
    result = sd.repeated_strings_removed(documents([(5, text), (5, text), (None, text)])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in result) == [(0, len(text)), (5, 0), (5, 0)]


def test_empty_table(documents):
    assert found(documents([])) == {}


def test_real_texts(documents, texts):
    assert found(documents(list(texts.items())), chunk_bytes=1 << 16) == brute.repeated_strings(texts)
