import os
import sys

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from utterflow.schema import Source, SourceSpec  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(scratch / "shared"))
        .config("spark.sql.warehouse.dir", str(scratch / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


AUDIO = pa.struct([("bytes", pa.binary()), ("path", pa.string())])

# Interview source: explicit ids, speakers, four splits, audio as a struct.
INTERVIEWS = SourceSpec(
    key="interviews",
    dataset="corpus",
    subset="interviews",
    text_column="transcription",
    record_id_column="id",
    speaker_column="speaker_id",
    gender_column="gender",
    language_column="language",
    unexported_splits=("unlabeled",),
)
# News source: ids derived, durations as float32, train only.
NEWS = SourceSpec(
    key="news",
    dataset="corpus",
    subset="news",
    text_column="corrected_text",
    default_language="en-GH",
    duration_column="duration_ss",
)
PHRASES = SourceSpec(
    key="phrases", dataset="corpus", subset="phrases", text_column="text", default_language="twi"
)


def write(path, columns):
    path.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table(columns), str(path))
    return str(path)


def _interviews(path, ids, texts):
    n = len(ids)
    return write(
        path,
        {
            "id": pa.array(ids, pa.string()),
            "speaker_id": pa.array([f"voice{i[-1]}" for i in ids], pa.string()),
            "gender": pa.array(["f" if int(i[-1]) % 2 else "m" for i in ids], pa.string()),
            "language": pa.array(["gaa"] * n, pa.string()),
            "transcription": pa.array(texts, pa.string()),
            "audio": pa.array([{"bytes": b"x" * 10, "path": None}] * n, AUDIO),
        },
    )


@pytest.fixture(scope="session")
def corpus(tmp_path_factory):
    """The three sources of FIXTURES.md on disk, by key."""
    root = tmp_path_factory.mktemp("corpus")
    inter = {
        "train": _interviews(
            root / "interviews/train/0000.parquet", ["take-007-1", "take-007-2"], ["morning tide", "morning market"]
        ),
        "validation": _interviews(
            root / "interviews/validation/0000.parquet", ["take-007-3"], ["quiet evening"]
        ),
        "test": _interviews(root / "interviews/test/0000.parquet", ["take-007-4"], ["late bus"]),
        "unlabeled": _interviews(
            root / "interviews/unlabeled/0000.parquet", ["take-007-5"], ["set aside"]
        ),
    }
    news = write(
        root / "news/train/0000.parquet",
        {
            "corrected_text": pa.array(["harbour prices rose", "rain until noon"]),
            "duration_ss": pa.array([5.5, 2.5], pa.float32()),
            "audio": pa.array([{"bytes": b"y", "path": None}] * 2, AUDIO),
        },
    )
    phrases = write(
        root / "phrases/train/0000.parquet",
        {
            "text": pa.array(["first short phrase", "second short phrase"]),
            "audio": pa.array(["a.wav", None], pa.string()),
        },
    )
    base = str(root)
    return {
        "interviews": Source(INTERVIEWS, inter, root=base),
        "news": Source(NEWS, {"train": news}, root=base),
        "phrases": Source(PHRASES, {"train": phrases}, root=base),
    }


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def rows_of(frame):
    return [tuple(r) for r in frame.collect()]
