import random

import pytest
from pyspark.sql import functions as F

from tests.llm import brute
from utterflow.llm import mixing


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["big"] * 6 + ["b", "c", "é", "Z", "", None])
        text = " ".join("w" for _ in range(rng.choice([0, 1, 5, 80, 300, 900])))
        rows.append((i, text, "en", source, len(text)))
    return rows


def test_targets_are_those_of_repeated_sharing(spark):
    rng = random.Random(2)
    for n in (1, 2, 3, 7, 20):
        sizes = {f"s{k:02}": rng.choice([0, 1, 10, 100, 5000]) for k in range(n)}
        sizes[None] = 17
        table = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        result = {r.source: r.target for r in mixing.source_targets(table).collect()}
        expected = brute.targets(sizes)
        for source in sizes:
            assert result[source] == pytest.approx(expected[source]), (sizes, source)


def test_permutation_is_one(spark):
    for n in (1, 2, 3, 5, 16, 17, 100, 1000):
        rows = spark.range(n).select(
            mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(7).cast("long")).alias("p")
        )
        assert sorted(r.p for r in rows.collect()) == list(range(n))


def test_compiled_permutation_is_the_same(spark):
    sizes = (1, 2, 3, 5, 17, 100)
    rows = spark.createDataFrame([(i, n) for n in sizes for i in range(n)], "i long, n long")
    index, size, key = F.col("i"), F.col("n"), F.lit(-7).cast("long")
    compiled = mixing.with_permuted(rows, "p", index, size, key)
    assert compiled.columns == ["i", "n", "p"]
    both = compiled.withColumn("q", mixing.permuted(index, size, key)).collect()
    assert all(r.p == r.q for r in both)
    assert sorted((r.n, r.p) for r in both) == [(n, i) for n in sizes for i in range(n)]


def test_mix_comes_near_its_targets(documents):
    rows = corpus()
    result = mixing.mixed(documents(rows), block_words=16, shard_slots=256).collect()
    assert len(result) == len(rows)
    source = {r[0]: r[3] for r in rows}
    size = {r[0]: len(r[1].split()) for r in rows}
    totals, sizes, targets = {}, {}, {}
    for r in result:
        s = source[r.doc_id]
        assert r.size == size[r.doc_id]
        assert 0 <= r.taken <= 3 * r.size
        totals[s] = totals.get(s, 0) + r.taken
        sizes[s] = sizes.get(s, 0) + r.size
        targets[s] = r.target
    expected = brute.targets(sizes)
    for s, target in targets.items():
        assert target == pytest.approx(expected[s])
        assert totals[s] == pytest.approx(target, rel=0.03, abs=40)
    assert {r.source_size for r in result} == set(sizes.values())


def test_reruns_agree(documents):
    rows = corpus(100, 3)
    first = {tuple(r) for r in mixing.mixed(documents(rows)).collect()}
    again = {tuple(r) for r in mixing.mixed(documents(rows[::-1]).repartition(5)).collect()}
    assert first == again


def test_shards_draw_their_slots(documents, spark):
    sources = spark.createDataFrame(
        [(0, 30.5, 20), (1, 60.0, 40), (2, 9.5, 9), (3, 0.0, 0)], "source_id long, wanted double, blocks long"
    )
    counts = mixing.shard_counts(sources, 16, 5).collect()
    per_shard = {}
    for r in counts:
        per_shard[r.shard] = per_shard.get(r.shard, 0) + r.slots
    assert per_shard == {0: 16, 1: 16, 2: 16, 3: 16, 4: 16, 5: 16, 6: 4}


def test_repeated_rows_empty_texts_and_nulls(documents):
    rows = [
        (1, "a b c", "en", "x", 5), (1, "a b c", "en", "x", 5), (2, None, None, None, None),
        (2, None, None, None, None), (3, "", "en", "x", 0), (None, "d e", "en", None, 3),
    ]
    result = mixing.mixed(documents(rows)).collect()
    assert sorted((r.doc_id or 0, r.size) for r in result) == [(0, 2), (1, 3), (1, 3), (2, 0), (2, 0), (3, 0)]
    assert all(r.taken <= 3 * r.size for r in result)


def test_no_words_and_no_rows(documents):
    assert [r.taken for r in mixing.mixed(documents([(1, ""), (2, None)])).collect()] == [0, 0]
    assert mixing.mixed(documents([])).count() == 0


def test_no_python_and_no_broadcast_of_blocks(documents):
    plan = mixing.mixed(documents(corpus(50)))._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "strategy=merge" in plan


def test_blocks_hold_the_words_of_their_sources(documents):
    rng = random.Random(8)
    rows = [
        (i if i % 9 else None, "\n ".join(f"{i}.{k}" for k in range(rng.choice([0, 1, 7, 16, 50]))), "en", rng.choice("ab"), 0)
        for i in range(60)
    ]
    options = {"block_words": 16, "shard_slots": 32}
    blocks = mixing.mixed_blocks(documents(rows), **options).collect()
    assert len({(b.shard, b.slot) for b in blocks}) == len(blocks)
    assert len({b.shard for b in blocks}) > 1 and all(0 <= b.slot < 32 for b in blocks)
    source = {w: r[3] for r in rows for w in r[1].split()}
    size = {r[1].split()[0].split(".")[0]: len(r[1].split()) for r in rows if r[1]}
    times, by_block, taken = {}, {}, {}
    for b in blocks:
        own = b.text.split(" ")
        assert len(own) == sum(p.n_words for p in b.pieces) <= 16
        assert {source[w] for w in own} == {b.source}
        assert by_block.setdefault((b.source, b.block), own) == own
        for w, follower in zip(own, own[1:]):  # a text runs on, or another begins
            (i, k), (j, m) = w.split("."), follower.split(".")
            assert (i == j and int(m) == int(k) + 1) or (int(k) == size[i] - 1 and m == "0")
        for w in own:
            times[w] = times.get(w, 0) + 1
            taken[w.split(".")[0]] = taken.get(w.split(".")[0], 0) + 1
    assert max(times.values()) <= 3
    order = [(b.shard, b.slot) for b in blocks]
    for shard in {s for s, _ in order}:
        own = [t for s, t in order if s == shard]
        assert own == sorted(own)
    counted = mixing.mixed(documents(rows), **options).collect()
    expected = sorted((len(r[1].split()), taken.get(str(i), 0)) for i, r in enumerate(rows))
    assert sorted((r.size, r.taken) for r in counted) == expected


def test_texts_are_shuffled_once(documents, monkeypatch):
    plans = {}

    class Watched(mixing.Stored):
        def __init__(self, table, name="step"):
            plans[name] = table._jdf.queryExecution().explainString(
                table.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
            )
            super().__init__(table, name)

    monkeypatch.setattr(mixing, "Stored", Watched)
    rows = [(i, " ".join(f"{i}.{k}" for k in range(40)), "en", "ab"[i % 2], 0) for i in range(50)]
    table = mixing.mixed_blocks(documents(rows), block_words=16, shard_slots=32)
    # 2000 words, as many buckets as texts: nearly every block has parts in several buckets.
    assert table.selectExpr("sum(size(split(text, ' ')))").first()[0] == pytest.approx(2000, abs=40)
    fields = plans["blocks"].split("\n\n")
    dealt = [f for f in fields if ") Exchange\n" in f and "hashpartitioning" in f]
    assert len([f for f in dealt if "text#" in f.split("Arguments")[0]]) == 1
    # Pieces travel in no exchange: those by block have lean columns only.
    assert not [f for f in dealt if "hashpartitioning(source_key" in f and "block#" in f.split("Arguments")[1] and "source_id" in f]


def test_shard_counts_are_multinomial_draws_that_add_up(spark):
    """Shares in a shard vary as draws without replacement do, not by one slot as with one phase."""
    sources = spark.createDataFrame(
        [(0, 5000.2, 9000), (1, 3000.5, 9000), (2, 2000.3, 9000)], "source_id long, wanted double, blocks long"
    )
    counts = {(r.source_id, r.shard): r.slots for r in mixing.shard_counts(sources, 100, 5).collect()}
    assert len({shard for _, shard in counts}) == 101  # the last has one slot
    for k, n in enumerate((5000, 3001, 2000)):
        own = [counts.get((k, shard), 0) for shard in range(101)]
        share = n / 10001
        expected = 100 * share * (1 - share) * (10001 - 100) / 10000
        mean = sum(own[:100]) / 100
        assert sum(own) == n
        assert 0.5 < sum((x - mean) ** 2 for x in own[:100]) / 99 / expected < 1.7
    slots = mixing.drawn_slots(sources, 100, 5).collect()
    assert len({(r.shard, r.slot) for r in slots}) == len(slots) == 10001


def stored_plans(monkeypatch):
    """Gets the optimized plan of every table that the mix stores, by its name."""
    plans = {}

    class Watched(mixing.Stored):
        def __init__(self, table, name="step"):
            plans[name] = table._jdf.queryExecution().optimizedPlan().toString()
            super().__init__(table, name)

    monkeypatch.setattr(mixing, "Stored", Watched)
    return plans


def test_joins_do_not_write_out_the_permutation_in_filters(documents, monkeypatch):
    """The join by block asked for blocks that are not null, in terms of the slots: 2 ** 12 times as long."""
    plans = stored_plans(monkeypatch)
    plans["taken"] = mixing.mixed(documents(corpus(50)))._jdf.queryExecution().optimizedPlan().toString()
    for name, plan in plans.items():
        assert len(plan) < 100_000, (name, len(plan))


def test_no_filter_splits_the_texts_again(documents, monkeypatch):
    """The join by bucket asked for buckets that are not null, which are hashes of the joined words."""
    plans = stored_plans(monkeypatch)
    mixing.mixed(documents(corpus(50)))
    filters = [line for line in plans["blocks"].split("\n") if "Filter" in line]
    assert filters and not [line for line in filters if "xxhash64" in line or "split" in line]
