import pytest

from tests.conftest import plan_of
from utterflow.operators import balance

SCHEMA = "record_id string, dataset_key string, source_split string, speaker_id string, text string"


def brute(rows, cap):
    import hashlib

    def key(r):
        h = None if r[0] is None else hashlib.sha1(r[0].encode()).hexdigest()
        return tuple((v is not None, v or "") for v in (h, r[0], r[1], r[2]))

    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    kept = []
    for members in groups.values():
        kept += sorted(members, key=lambda r: (key(r), tuple((v is not None, v or "") for v in r)))[:cap]
    return sorted(kept, key=repr)


def run(spark, rows, cap):
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    result = balance.capped_per_group(table, cap, "speaker_id")
    assert result.columns == table.columns
    return sorted((tuple(r) for r in result.collect()), key=repr)


def test_hot_speaker_and_nulls(spark):
    rows = [(f"r{i}", "d", "train", "hot", f"t{i}") for i in range(3000)]
    rows += [(f"c{i}", "d", "train", f"s{i % 40}", "x") for i in range(400)]
    rows += [(f"n{i}", "d", "train", None, "y") for i in range(30)]
    rows += [(None, "d", "train", "s1", "no id")]
    got = run(spark, rows, 7)
    assert got == brute(rows, 7)
    assert sum(1 for r in got if r[3] == "hot") == 7 and sum(1 for r in got if r[3] is None) == 7


def test_equal_rows_are_cut_exactly(spark):
    rows = [("same", "d", "train", "a", f"text {i % 3}") for i in range(10)] + [("other", "d", "train", "a", "z")]
    got = run(spark, rows, 4)
    assert len(got) == 4 and got == brute(rows, 4)


def test_small_groups_keep_all_and_edges(spark):
    rows = [(f"r{i}", "d", "train", f"s{i}", "x") for i in range(20)]
    assert run(spark, rows, 3) == sorted(rows, key=repr)
    assert run(spark, rows, 0) == []
    assert run(spark, [], 5) == []
    with pytest.raises(ValueError):
        balance.capped_per_group(spark.createDataFrame(rows, SCHEMA), -1)


def test_wide_rows_are_not_shuffled_by_speaker(spark):
    rows = spark.createDataFrame([(f"r{i}", "d", "train", f"s{i % 5}", "x" * 100) for i in range(100)], SCHEMA)
    plan = plan_of(balance.capped_per_group(rows, 3))
    assert "BroadcastHashJoin" in plan
    # Only the few rows that share the last key are sorted whole; none is exchanged by speaker.
    assert "hashpartitioning(speaker_id" not in plan


def balanced_brute(rows):
    counts = {}
    for r in rows:
        counts[r[3]] = counts.get(r[3], 0) + 1
    return brute(rows, min(counts.values())) if rows else []


@pytest.mark.parametrize("finish", [1_000_000, 3])
def test_groups_are_cut_to_the_smallest(spark, monkeypatch, finish):
    monkeypatch.setattr(balance, "FINISH_ROWS", finish)
    rows = [(f"r{i}", "d", "train", "f" if i % 4 else "m", "x") for i in range(2000)]
    rows += [(None, "d", "train", "f", "no id"), (None, "d", "train", "f", "no id 2")]
    rows += [(f"u{i}", "d", "train", None, "x") for i in range(300)]
    rows += [("r1", "d", "train", "m", "repeat")] * 3
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = sorted((tuple(r) for r in balance.balanced_groups(table, "speaker_id").collect()), key=repr)
    assert got == balanced_brute(rows)
    assert sum(1 for r in got if r[3] == "f") == 300


def test_balance_of_nothing(spark):
    assert balance.balanced_groups(spark.createDataFrame([], SCHEMA), "speaker_id").collect() == []
