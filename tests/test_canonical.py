import dataclasses
import hashlib

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import INTERVIEWS, NEWS, PHRASES, plan_of, write
from utterflow.operators.canonical import canonical_rows, canonicalize, union_sources
from utterflow.schema import CANONICAL_SCHEMA, PATH, ROW, Source, SourceSpec
from utterflow.sources import parquet
from utterflow.sources.parquet import first_rows, list_files, read_rows, read_split, split_counts


def derived(seed):
    return "derived:" + hashlib.sha1(seed.encode()).hexdigest()[:16]


def test_mapped_columns(spark, corpus):
    rows = canonical_rows(spark, corpus["interviews"], ["train"]).orderBy("record_id").collect()
    assert [f.name for f in CANONICAL_SCHEMA] == list(rows[0].asDict())
    assert tuple(rows[0]) == (
        "corpus", "interviews", "train", "interviews", "take-007-1", "voice1", "f", "gaa",
        "morning tide", None,
    )


def test_derived_ids_defaults_and_float_durations(spark, corpus):
    rows = canonical_rows(spark, corpus["news"]).orderBy("duration_seconds").collect()
    assert [r.duration_seconds for r in rows] == [2.5, 5.5]
    assert {r.language for r in rows} == {"en-GH"}
    assert [r.record_id for r in rows] == [
        derived("news|news/train/0000.parquet|1"), derived("news|news/train/0000.parquet|0")
    ]


def test_path_expression_feeds_literal_paths(spark):
    tagged = spark.createDataFrame([("a", "ignored", 0)], f"text string, {PATH} string, {ROW} long")
    row = canonicalize(tagged, PHRASES, "train", path_expr=F.lit("hf://x/train/0000.parquet"))
    assert row.first().record_id == derived("phrases|hf://x/train/0000.parquet|0")


def test_sampled_and_full_scan_agree_on_ids(spark, corpus):
    full = {r.record_id for r in canonical_rows(spark, corpus["phrases"]).collect()}
    sample = {r.record_id for r in canonical_rows(spark, corpus["phrases"], sample_size=5).collect()}
    assert full == sample and len(full) == 2


def test_equal_file_names_in_different_folders_get_different_ids(spark, tmp_path):
    paths = {s: write(tmp_path / s / "0.parquet", {"text": ["x"]}) for s in ("train", "test")}
    for root in (None, str(tmp_path)):
        rows = canonical_rows(spark, Source(PHRASES, paths, root=root)).collect()
        assert len({r.record_id for r in rows}) == 2


def test_seed_path_is_decoded(spark, tmp_path):
    path = write(tmp_path / "with space+plus%é" / "0.parquet", {"text": ["x"]})
    row = canonical_rows(spark, Source(PHRASES, {"train": path}, root=str(tmp_path))).first()
    assert row.record_id == derived("phrases|with space+plus%é/0.parquet|0")


def test_ids_and_blank_values(spark, tmp_path):
    ids = ["  ", " x ", None, "\u3000"]
    path = write(
        tmp_path / "a.parquet",
        {
            "id": pa.array(ids, pa.string()),
            "transcription": pa.array([" \t\u3000", "\u00a0Hello\u2003World\u001c", None, "b"]),
            "gender": pa.array([" f ", "", None, "m"]),
        },
    )
    rows = canonical_rows(
        spark, Source(INTERVIEWS, {"train": path}, root=str(tmp_path)), provenance=True
    ).orderBy(ROW).collect()
    assert [r.record_id for r in rows] == [
        derived("interviews|a.parquet|0"), " x ", derived("interviews|a.parquet|2"),
        derived("interviews|a.parquet|3"),
    ]
    assert [r.text for r in rows] == [None, "Hello\u2003World", None, "b"]
    assert [r.gender for r in rows] == ["f", None, None, "m"]
    assert [r.speaker_id for r in rows] == [None] * 4  # column missing in the source
    assert [r.language for r in rows] == [None] * 4  # mapped but missing: no default


def test_mapped_language_does_not_fall_back(spark, tmp_path):
    spec = dataclasses.replace(INTERVIEWS, default_language="zz")
    path = write(tmp_path / "a.parquet", {"transcription": ["t"], "language": [" "]})
    assert canonical_rows(spark, Source(spec, {"train": path})).first().language is None


def test_integer_ids_become_text(spark, tmp_path):
    path = write(tmp_path / "a.parquet", {"id": [7], "transcription": ["t"]})
    assert canonical_rows(spark, Source(INTERVIEWS, {"train": path})).first().record_id == "7"


def test_bad_duration_raises(spark, tmp_path):
    path = write(tmp_path / "a.parquet", {"corrected_text": ["t"], "duration_ss": ["abc"]})
    with pytest.raises(PySparkException):
        canonical_rows(spark, Source(NEWS, {"train": path})).collect()


def test_audio_shapes(spark, corpus):
    inter = canonical_rows(spark, corpus["interviews"], ["train"], include_audio=True).collect()
    assert all(bytes(r.audio["bytes"]) == b"x" * 10 and r.audio["path"] is None for r in inter)
    phrases = canonical_rows(spark, corpus["phrases"], include_audio=True).orderBy("text").collect()
    assert phrases[0].audio.asDict() == {"bytes": None, "path": "a.wav"}
    assert phrases[1].audio is None


def test_audio_struct_without_path_and_source_without_audio(spark, tmp_path):
    clips = pa.array([{"bytes": b"q"}, None], pa.struct([("bytes", pa.binary())]))
    path = write(tmp_path / "a.parquet", {"text": ["1", "2"], "audio": clips})
    rows = canonical_rows(
        spark, Source(PHRASES, {"train": path}), include_audio=True
    ).orderBy("text").collect()
    assert bytes(rows[0].audio["bytes"]) == b"q" and rows[0].audio["path"] is None
    assert rows[1].audio is None
    bare = write(tmp_path / "b.parquet", {"text": ["1"]})
    row = canonical_rows(spark, Source(PHRASES, {"train": bare}), include_audio=True).first()
    assert row.audio is None


def test_audio_is_not_read_unless_asked(spark, corpus):
    for source in corpus.values():
        scans = [x for x in plan_of(canonical_rows(spark, source)).split("\n") if "ReadSchema" in x]
        assert scans and all("audio" not in x.split("ReadSchema")[1] for x in scans)
    with_audio = plan_of(canonical_rows(spark, corpus["news"], include_audio=True))
    assert "audio" in with_audio.split("ReadSchema")[1]


def test_scan_is_one_narrow_stage(spark, corpus):
    plan = plan_of(union_sources(spark, list(corpus.values())))
    assert "Exchange" not in plan and "Python" not in plan and "Sort" not in plan


def test_a_path_listed_twice_is_read_once(spark, corpus):
    once = corpus["news"]
    path = once.paths["train"]
    twice = Source(once.spec, {"train": [path, path]})
    assert canonical_rows(spark, twice).count() == 2
    assert read_rows(spark, [path, path], ["corrected_text"]).count() == 2


def test_unknown_split_and_empty_file_give_no_rows(spark, corpus, tmp_path):
    assert canonical_rows(spark, corpus["news"], ["test"]).schema == CANONICAL_SCHEMA
    assert canonical_rows(spark, corpus["news"], ["test"]).count() == 0
    empty = write(tmp_path / "e.parquet", {"text": pa.array([], pa.string())})
    source = Source(PHRASES, {"train": empty})
    assert canonical_rows(spark, source).count() == 0
    assert canonical_rows(spark, source, sample_size=10).count() == 0
    assert rows_by_split(split_counts(spark, source)) == {"train": 0}
    with pytest.raises(PySparkException):
        canonical_rows(spark, Source(PHRASES, {"train": str(tmp_path / "absent.parquet")})).count()


def rows_by_split(frame):
    return {r.source_split: r.rows for r in frame.collect()}


def test_split_counts_read_no_column(spark, corpus):
    counts = split_counts(spark, corpus["interviews"])
    assert rows_by_split(counts) == {"train": 2, "validation": 1, "test": 1, "unlabeled": 1}
    assert "ReadSchema: struct<>" in plan_of(counts)


@pytest.fixture(scope="module")
def shards(spark, tmp_path_factory):
    """23 rows in files of 5, 0, 1, 10 and 7, in folders with odd names."""
    root = tmp_path_factory.mktemp("my shards [1]")
    start = 0
    for i, n in enumerate((5, 0, 1, 10, 7)):
        values = [f"t{j:02d}" for j in range(start, start + n)]
        write(root / f"part {i}.parquet", {"text": pa.array(values, pa.string())})
        start += n
    return root


@pytest.mark.parametrize("limit", [0, 1, 4, 5, 6, 7, 16, 22, 23, 24, 10_000])
def test_first_rows_is_a_prefix_in_file_order(spark, shards, limit):
    rows = spark.read.parquet(str(shards).replace("[", "\\[").replace("]", "\\]"))
    picked = first_rows(rows, limit, ["text"])
    assert sorted(r.text for r in picked.collect()) == [f"t{j:02d}" for j in range(min(limit, 23))]
    plan = plan_of(picked)
    assert "Exchange" not in plan and "Sort" not in plan and "Limit" not in plan


def test_first_rows_reads_leading_files_only(spark, shards):
    rows = spark.read.parquet(str(shards).replace("[", "\\[").replace("]", "\\]"))
    assert len(list_files(rows)) == 5
    picked = first_rows(rows, 3, ["text"])
    assert picked.rdd.getNumPartitions() <= 1


def test_first_rows_when_the_listing_spells_paths_otherwise(spark, shards, monkeypatch):
    rows = spark.read.parquet(str(shards).replace("[", "\\[").replace("]", "\\]"))
    monkeypatch.setattr(parquet, "list_files", lambda frame: ["other:/a", "other:/b"])
    picked = first_rows(rows, 6, ["text"])
    assert sorted(r.text for r in picked.collect()) == [f"t{j:02d}" for j in range(6)]


def test_row_index_survives_small_input_partitions(spark, tmp_path):
    path = str(tmp_path / "big")
    spark.range(0, 20_000, 1, 1).select(F.col("id").cast("string").alias("text")).write.option(
        "parquet.block.size", 16 * 1024).parquet(path)
    source = Source(PHRASES, {"train": path}, root=str(tmp_path))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 8 * 1024)
    try:
        rows = canonical_rows(spark, source, provenance=True)
        assert rows.rdd.getNumPartitions() > 1
        assert rows.where(F.col("text") != F.col(ROW).cast("string")).count() == 0
        assert rows.select("record_id").distinct().count() == 20_000
        assert canonical_rows(spark, source, sample_size=777).agg(
            F.max(F.col("text").cast("int"))).first()[0] == 776
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_files_with_different_columns(spark, tmp_path):
    spec = SourceSpec("k", "d", "s", text_column="text", speaker_column="who")
    write(tmp_path / "1.parquet", {"text": ["a"]})
    write(tmp_path / "2.parquet", {"text": ["b"], "who": ["x"]})
    source = Source(spec, {"train": str(tmp_path / "*.parquet")})
    rows = canonical_rows(spark, source).orderBy("text").collect()
    assert [(r.text, r.speaker_id) for r in rows] == [("a", None), ("b", "x")]
    fixed = Source(spec, source.paths, schema=read_split(spark, source, "train", ["who"]).schema)
    assert {r.speaker_id for r in canonical_rows(spark, fixed).collect()} == {None, "x"}


def test_glob_and_limited_read(spark, tmp_path):
    for i in range(3):
        write(tmp_path / f"s-{i}.parquet", {"a": [i * 2, i * 2 + 1], "b": ["x", "y"]})
    got = read_rows(spark, str(tmp_path / "s-*.parquet"), ["a"], 3)
    assert got.columns == ["a"]
    assert sorted(r.a for r in got.collect()) == [0, 1, 2]
    assert read_rows(spark, str(tmp_path / "s-*.parquet"), ["a"]).count() == 6


def test_root_is_the_beginning_of_a_path(spark):
    from utterflow.operators.canonical import seed_path

    paths = ["file:///data/x/0.parquet", "file:/data/x/0.parquet", "file:///mnt/data/x/0.parquet",
             "s3://data/data/x/0.parquet", "/data/x/0.parquet"]
    rows = spark.createDataFrame([(p,) for p in paths], "p string")
    cut = [r.s for r in rows.select(seed_path("/data", F.col("p")).alias("s")).collect()]
    assert cut == ["x/0.parquet", "x/0.parquet", paths[2], "x/0.parquet", "x/0.parquet"]
    cut = [r.s for r in rows.select(seed_path("file:///data/", F.col("p")).alias("s")).collect()]
    assert cut == ["x/0.parquet", "x/0.parquet", *paths[2:]]
    cut = [r.s for r in rows.select(seed_path("s3://data", F.col("p")).alias("s")).collect()]
    assert cut == [*paths[:3], "data/x/0.parquet", paths[4]]


def test_overlapping_paths_are_read_once(spark, tmp_path):
    for i in range(3):
        write(tmp_path / f"f{i}.parquet", {"text": pa.array([f"t{i}"])})
    paths = [f"{tmp_path}/*.parquet", f"{tmp_path}/f1.parquet", f"{tmp_path}/f1.parquet"]
    source = Source(PHRASES, {"train": paths})
    assert sorted(r.text for r in canonical_rows(spark, source).collect()) == ["t0", "t1", "t2"]
    assert [r.rows for r in split_counts(spark, source).collect()] == [3]
    assert read_rows(spark, paths, ["text"]).count() == 3
