from tests.conftest import plan_of
from utterflow.operators import duplicates

SCHEMA = "record_id string, dataset_key string, source_split string, text string, audio binary"


def brute(rows):
    def norm(t):
        return " ".join((t or "").lower().split())

    groups, kept = {}, []
    for r in rows:
        n = norm(r[3])
        if not n:
            kept.append(r)
        else:
            groups.setdefault(n, []).append(r)
    for members in groups.values():
        kept.append(min(members, key=lambda r: tuple((v is not None, v or "") for v in r[:3])))
    return kept


def run(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    out = duplicates.first_transcripts(table)
    assert out.columns == table.columns
    return out.collect()


def test_first_of_each_text_stays(spark):
    rows = [(f"r{i:04d}", "d", "train", "Hot  TEXT here" if i % 3 else "hot text here", b"a") for i in range(900)]
    rows += [(f"u{i}", "d", "val", f"unique {i}", None) for i in range(50)]
    rows += [(None, "d", "train", "unique 3", None), ("z", None, "train", "x", None), ("z", "d", "train", "x", None)]
    rows += [("e1", "d", "train", None, None), ("e2", "d", "train", "   ", None), ("e3", "d", "train", None, None)]
    got = run(spark, rows)
    expected = brute(rows)
    assert sorted(map(tuple, got), key=repr) == sorted(expected, key=repr)


def test_rows_equal_in_the_key_leave_one(spark):
    rows = [("same", "d", "train", "words", bytes([i])) for i in range(5)]
    got = run(spark, rows)
    assert len(got) == 1 and got[0].audio == bytes([0])


def test_empty_and_plan(spark):
    assert run(spark, []) == []
    table = spark.createDataFrame([("a", "d", "t", "x", b"1")], SCHEMA)
    plan = plan_of(duplicates.first_transcripts(table))
    assert "BroadcastHashJoin" in plan
