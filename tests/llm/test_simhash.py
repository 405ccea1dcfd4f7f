import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from utterflow.llm import collisions, simhash
from utterflow.llm.components import components

WORDS = [f"w{i}" for i in range(300)]


def near_copies(seed=1, n=60):
    rng = random.Random(seed)
    rows = {}
    for group in range(n // 6):
        base = rng.choices(WORDS, k=rng.choice([3, 40, 120]))
        for _ in range(6):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            rows[len(rows)] = " ".join(words)
    return rows


def found(docs, **options):
    rows = simhash.near_duplicates(docs, **options).collect()
    return {r.doc_id: (r.fingerprint, r.component_id) for r in rows}


@pytest.mark.parametrize(
    "text", [None, "", " \t\n", "One", "a b c", "A b C d", "ÄÖ äö É x y", "x y z w " * 50, "a b c"]
)
def test_fingerprint_is_that_of_the_plain_version(text):
    data = None if text is None else text.encode()
    assert simhash.fingerprint(data) == brute.fingerprint(text)


def test_fingerprint_of_a_text_over_one_slice(monkeypatch):
    text = " ".join(random.Random(2).choices(WORDS, k=500))
    monkeypatch.setattr(simhash, "_SLICE", 64)
    assert simhash.fingerprint(text.encode()) == brute.fingerprint(text)


def test_components_are_those_of_all_pairs(documents):
    rows = near_copies() | {100: None, 101: "", 102: "  ", 103: "lonely text of its own here"}
    assert found(documents(list(rows.items()))) == brute.simhash_components(rows)


def test_links_of_close_fingerprints(spark):
    rng = random.Random(3)
    prints = set()
    for _ in range(40):
        base = rng.getrandbits(64)
        prints.add(base)
        for distance in (1, 2, 3, 4, 5, 6):
            flip = sum(1 << b for b in rng.sample(range(64), distance))
            prints.add(base ^ flip)
    prints = sorted(prints)
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    table = spark.createDataFrame([(p,) for p in signed], "fp long").repartition(4)
    links = components(simhash.near_links(table, chunk=16)).collect()
    root = dict(links)
    same = lambda a, b: root.get(a, a) == root.get(b, b)
    parent = {p: p for p in prints}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, p in enumerate(prints):
        for q in prints[:i]:
            if (p ^ q).bit_count() <= 4:
                parent[find(p)] = find(q)
    for i, (p, s) in enumerate(zip(prints, signed)):
        for q, t in zip(prints[:i], signed[:i]):
            assert same(s, t) == (find(p) == find(q))


def test_repeated_rows_and_clashing_columns(documents, spark):
    rows = spark.createDataFrame(
        [(7, "a b c d e", 1, "x"), (7, "a b c d e", 2, "y"), (3, "a b c d e", 3, "z")],
        "doc_id long, text string, fp long, root string",
    )
    result = simhash.near_duplicates(rows).collect()
    assert sorted((r.doc_id, r.component_id) for r in result) == [(3, 3), (7, 3), (7, 3)]
    kept = simhash.first_of_each_group(rows)
    assert kept.columns == rows.columns
    assert [r.doc_id for r in kept.collect()] == [3]


def test_empty_table(documents):
    assert found(documents([])) == {}
    assert simhash.first_of_each_group(documents([])).count() == 0


def test_one_of_each_group_stays(documents):
    rows = near_copies(5)
    kept = {r.doc_id for r in simhash.first_of_each_group(documents(list(rows.items()))).collect()}
    assert kept == {c for _, c in brute.simhash_components(rows).values()}


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1300)]
    edges += [(5000, 5000), (1001, 1000), (1000, 1001)]
    random.Random(1).shuffle(edges)
    result = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    assert len({result[i] for i in range(201)}) == 1
    assert len({result[i] for i in range(1000, 1300)}) == 1
    assert result[0] != result[1000]
    assert 5000 not in result


def test_components_without_edges(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("bits", [0, 3, 9])
def test_packed_blocks(bits):
    rng = np.random.default_rng(bits)
    values = np.unique(rng.integers(0, 1 << 64, 1000, dtype=np.uint64))
    labels = rng.integers(-5, 1 << 40, len(values))
    back = [
        (row["bucket"], *collisions.unpack(row["packed"]))
        for row in collisions.split_buckets(1, values, bits, labels=labels)
    ]
    whole = np.concatenate(
        [v | np.uint64(b << (64 - bits) if bits else 0) for b, v, _ in back]
    )
    assert (whole == values).all()
    assert (np.concatenate([own for _, _, own in back]) == labels).all()


def test_packed_block_without_values():
    values, labels = collisions.unpack(
        collisions.pack(np.empty(0, np.uint64), np.empty(0, np.int64))
    )
    assert len(values) == len(labels) == 0


def test_balls_are_sent_packed_and_not_as_rows(documents):
    table = documents([(i, f"text number {i} of some") for i in range(20)])
    prints = simhash.fingerprints(table).groupBy("fp").agg(F.min("doc_id"))
    plan = simhash.near_links(prints)._jdf.queryExecution().optimizedPlan().toString()
    assert "packed" in plan and "Join" not in plan
