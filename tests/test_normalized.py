import pyarrow as pa
import pytest

from tests.conftest import INTERVIEWS, PHRASES, plan_of, write
from utterflow.operators import normalized
from utterflow.operators.normalized import add_text_metrics, normalized_rows
from utterflow.schema import Source


@pytest.fixture(scope="module")
def phrases(tmp_path_factory):
    root = tmp_path_factory.mktemp("phrases")
    start = 0
    for i, n in enumerate((3, 0, 4, 1)):
        values = [f"t{j}" for j in range(start, start + n)]
        write(root / f"{i}.parquet", {"text": pa.array(values, pa.string())})
        start += n
    return Source(PHRASES, {"train": str(root), "test": str(root / "2.parquet")})


@pytest.mark.parametrize("limit", [normalized.BROADCAST_FILES, 0])
def test_index_runs_over_the_split(spark, phrases, monkeypatch, limit):
    monkeypatch.setattr(normalized, "BROADCAST_FILES", limit)
    rows = normalized_rows(spark, phrases).collect()
    train = {r.record_id: r.text for r in rows if r.source_split == "train"}
    assert train == {f"phrases:train:{i}": f"t{i}" for i in range(8)}
    test = {r.record_id: r.text for r in rows if r.source_split == "test"}
    assert test == {f"phrases:test:{i}": f"t{i + 3}" for i in range(4)}


def test_sample_has_the_same_ids(spark, phrases):
    rows = normalized_rows(spark, phrases, ["train"], sample_size=5).collect()
    assert {r.record_id for r in rows} == {f"phrases:train:{i}" for i in range(5)}


def test_rows_are_not_shuffled_for_their_index(spark, phrases):
    plan = plan_of(normalized_rows(spark, phrases, ["train"]))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_values(spark, tmp_path):
    path = write(
        tmp_path / "a.parquet",
        {
            "id": pa.array(["", " ", None, "x"], pa.string()),
            "language": pa.array(["", " ", None, "gaa"], pa.string()),
            "transcription": pa.array(["ﬁ  ①", None, " a\n b ", ""], pa.string()),
            "gender": pa.array([" f ", None, None, None], pa.string()),
        },
    )
    import dataclasses

    spec = dataclasses.replace(INTERVIEWS, default_language="zz")
    rows = normalized_rows(spark, Source(spec, {"train": path}), include_audio=True).collect()
    assert [r.record_id for r in rows] == [
        "interviews:train:0", " ", "interviews:train:2", "x"
    ]
    assert [r.language for r in rows] == ["zz", " ", "zz", "gaa"]
    assert [r.text for r in rows] == ["fi 1", "", "a b", ""]
    assert rows[0].gender == " f "  # untouched here
    assert rows[0].text_source_column == "transcription" and rows[0].audio is None
    assert len(rows[0]) == 12


def test_unknown_split(spark, phrases):
    none = normalized_rows(spark, phrases, ["absent"])
    assert none.count() == 0 and none.columns == normalized_rows(spark, phrases).columns


def test_text_metrics(spark):
    frame = spark.createDataFrame([("a  bé c",), ("",), (None,), ("𝔸",)], "text string")
    got = [tuple(r)[1:] for r in add_text_metrics(frame).collect()]
    assert got == [(7, 3, False), (0, 0, True), (0, 0, True), (1, 1, False)]
