import hashlib
import math

import pytest
from pyspark.sql import functions as F

from utterflow.functions import hashing


def bucket(record_id):
    return int(hashlib.sha1(record_id.encode()).hexdigest()[:8], 16) / 0xFFFFFFFF


def expected(record_id, val, test):
    b = bucket(record_id)
    if test > 0 and b < test or 1.0 - test <= 0:
        return "test"
    return "validation" if (b - test) / (1.0 - test) < val else "train"


IDS = [f"record-{i}" for i in range(3000)] + ["take-007-1", "take-007-2", "ünï\u3000 çødé", " x "]


@pytest.fixture(scope="module")
def ids(spark):
    return spark.createDataFrame([(i,) for i in IDS], "record_id string").cache()


def test_bucket_is_bit_identical(ids):
    for r in ids.select("record_id", hashing.hash_bucket(F.col("record_id")).alias("b")).collect():
        assert r.b == bucket(r.record_id)


@pytest.mark.parametrize(
    "val,test", [(0.1, 0.0), (0.1, 0.1), (0.3, 0.3), (0.0, 0.0), (0.0, 0.2), (1.5, 0.0),
                 (0.1, 1.0), (0.1, 2.0), (1 / 3, 1 / 7)]
)
def test_split_labels(ids, val, test):
    label = hashing.hash_split(F.col("record_id"), val, test)
    for r in ids.select("record_id", label.alias("s")).collect():
        assert r.s == expected(r.record_id, val, test)


def test_known_labels(spark):
    rows = [("record-1", 0.936177077), ("record-2", 0.117688649), ("take-007-2", 0.034171007)]
    frame = spark.createDataFrame(rows, "record_id string, b double").select(
        "b",
        hashing.hash_bucket(F.col("record_id")).alias("got"),
        hashing.hash_split(F.col("record_id"), 0.1).alias("two"),
        hashing.hash_split(F.col("record_id"), 0.1, 0.1).alias("three"),
    )
    got = frame.collect()
    assert all(abs(r.got - r.b) < 1e-9 for r in got)
    assert [r.two for r in got] == ["train", "train", "validation"]
    assert [r.three for r in got] == ["train", "validation", "test"]


def test_policies(spark):
    frame = spark.createDataFrame([("take-007-2", "gold")], "record_id string, source_split string")

    def label(**strategy):
        return frame.select(hashing.target_split(**strategy)).first()[0]

    assert label(policy="preserve") == "gold"
    assert label() == "gold"
    assert label(policy="train-val", val_ratio=0.1, test_ratio=0.9) == "validation"
    assert label(policy="train-val-test", val_ratio=0.1, test_ratio=0.1) == "test"


@pytest.mark.parametrize("ratio", [-0.1, math.nan, math.inf])
def test_bad_arguments_fail_before_any_job(ratio):
    with pytest.raises(ValueError):
        hashing.check_ratio("val_ratio", ratio)
    with pytest.raises(ValueError):
        hashing.target_split("stratified")


def test_derived_id(spark):
    frame = spark.createDataFrame([("hf://d/0000.parquet", 3)], "p string, r long")
    got = frame.select(hashing.derived_id("news", F.col("p"), F.col("r"))).first()[0]
    digest = hashlib.sha1(b"news|hf://d/0000.parquet|3").hexdigest()[:16]
    assert got == f"derived:{digest}"
