"""SHA-1 based ids and split labels. All of it is whole-stage codegen."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

POLICIES = ("preserve", "train-val", "train-val-test")


def sha1_prefix(value: Column, digits: int) -> Column:
    return F.substring(F.sha1(value.cast("binary")), 1, digits)


def derived_id(key: str, path: Column, row: Column) -> Column:
    """``derived:`` plus 16 hex digits of SHA-1 over ``key|path|row``."""
    seed = F.concat_ws("|", F.lit(key), path, row.cast("string"))
    return F.concat(F.lit("derived:"), sha1_prefix(seed, 16))


def hash_bucket(record_id: Column) -> Column:
    """Position of an id in [0, 1], both ends included."""
    return F.conv(sha1_prefix(record_id, 8), 16, 10).cast("double") / F.lit(4294967295.0)


def check_ratio(name: str, ratio: float) -> float:
    ratio = float(ratio)
    if not math.isfinite(ratio) or ratio < 0:
        raise ValueError(f"{name} must be a finite number >= 0, got {ratio}")
    return ratio


def hash_split(record_id: Column, val_ratio: float = 0.1, test_ratio: float = 0.0) -> Column:
    """Split label that depends on the id alone.

    ``val_ratio`` is a share of what the test split leaves: 0.1/0.1 labels 9 %
    of all rows ``validation``. A test ratio of 1 or more labels all rows.
    """
    val_ratio = check_ratio("val_ratio", val_ratio)
    test_ratio = check_ratio("test_ratio", test_ratio)
    remainder = 1.0 - test_ratio
    if remainder <= 0:
        return F.lit("test")
    bucket = hash_bucket(record_id)
    validation = (bucket - F.lit(test_ratio)) / F.lit(remainder) < F.lit(val_ratio)
    label = F.when(validation, F.lit("validation")).otherwise(F.lit("train"))
    if test_ratio == 0:
        return label
    return F.when(bucket < F.lit(test_ratio), F.lit("test")).otherwise(label)


def target_split(
    policy: str = "preserve", val_ratio: float = 0.1, test_ratio: float = 0.1
) -> Column:
    """The split column of a canonical row under a policy.

    ``train-val`` hashes every row, whatever its source split, and takes no
    test share even when a test ratio is given.
    """
    if policy not in POLICIES:
        raise ValueError(f"unknown split policy {policy!r}, expected one of {', '.join(POLICIES)}")
    if policy == "preserve":
        return F.col("source_split")
    test_share = test_ratio if policy == "train-val-test" else 0.0
    return hash_split(F.col("record_id"), val_ratio, test_share)
