import zlib

from utterflow.llm import sharding


def test_differencing_known_case():
    # Two-way differencing of 8 7 6 5 4: 8-7, 6-5, 4-1, 3-1 leave 2 (the best split leaves 0).
    subsets = sharding.differencing([(s, s) for s in (8, 7, 6, 5, 4)], 2)
    assert sorted(t for t, _ in subsets) == [14, 16]
    assert sorted(x for _, xs in subsets for x in xs) == [4, 5, 6, 7, 8]
    assert all(t == sum(xs) for t, xs in subsets)


def test_differencing_is_tighter_than_greedy_on_random_sizes():
    import random

    rng = random.Random(7)
    sizes = [rng.randint(1, 10**6) for _ in range(2000)]
    subsets = sharding.differencing([(s, i) for i, s in enumerate(sorted(sizes, reverse=True))], 40)
    totals = [t for t, _ in subsets]
    assert max(totals) - min(totals) <= max(sizes) // 100
    assert sorted(i for _, xs in subsets for i in xs) == list(range(2000))


def test_empty_input():
    assert sharding.differencing([], 3) == [(0, []), (0, []), (0, []), ]


def check(rows, result, shards=40):
    assert len(result) == len(rows)
    by_text = {}
    for r in result:
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
    for (doc_id, text), r in zip(sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, zlib.crc32((x[1] or "").encode()))),
                                 sorted(result, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text_crc32))):
        assert r.doc_id == doc_id
        assert r.size == len((text or "").encode()) + 16
        assert r.text_crc32 == zlib.crc32((text or "").encode())
        by_text.setdefault(text, set()).add(r.shard)
    assert all(len(s) == 1 for s in by_text.values())
    slots = {}
    for r in result:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    loads = {}
    for r in result:
        loads[r.shard] = loads.get(r.shard, 0) + r.size
    return loads


def test_shards_of_a_table(spark, documents):
    rows = [(i, "word " * (i % 97) + str(i % 300)) for i in range(3000)]
    rows += [(5000, None), (5001, None), (None, "x"), (7, "repeat"), (7, "repeat"), (8, "")]
    result = sharding.sharded(documents(rows)).collect()
    loads = check(rows, result)
    assert len(loads) == 40
    biggest_group = max(len((t or "").encode()) + 16 for _, t in rows) * 10
    assert max(loads.values()) - min(loads.values()) <= biggest_group


def test_one_hot_group_stays_whole(spark, documents):
    rows = [(i, "hot text") for i in range(500)] + [(1000 + i, f"cold {i}") for i in range(200)]
    result = sharding.sharded(documents(rows)).collect()
    check(rows, result)
    assert len({r.shard for r in result if r.doc_id < 1000}) == 1


def test_empty_and_clashing_columns(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.sharded(empty).collect() == []
    clash = spark.createDataFrame([(1, "a", 3, "x")], "doc_id long, text string, shard int, slot string")
    rows = sharding.sharded(clash).collect()
    assert len(rows) == 1 and rows[0].slot == 0


def test_reruns_agree(spark, sample):
    docs = sample("documents")
    first = sorted(tuple(r) for r in sharding.sharded(docs).collect())
    again = sorted(tuple(r) for r in sharding.sharded(docs).collect())
    assert first == again
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check(rows, [r for r in sharding.sharded(docs).collect()])
