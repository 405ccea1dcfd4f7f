import json
import os

import pyarrow.ipc as ipc
import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.conftest import plan_of, rows_of
from utterflow.operators.canonical import canonical_rows
from utterflow.operators.filters import OverlapFilter
from utterflow.operators.splits import assign_split, split_summary, split_totals
from utterflow.plans import materialize as m
from utterflow.plans.storage import new_folder
from utterflow.schema import Source, SourceSpec
from utterflow.sources.vocabulary import read_top_tokens, write_top_tokens

RECIPE = {
    "selected_datasets": [
        {"dataset_key": "interviews", "selected_splits": ["train"]},
        {"dataset_key": "news", "selected_splits": ["train", "absent"]},
    ],
    "split_strategy": {"policy": "train-val", "val_ratio": 0.1, "test_ratio": 0.5},
    "filters": {
        "status": "configured",
        "pipeline": [
            {
                "type": "text_frequency_overlap",
                "dataset_key": "interviews",
                "top_tokens": ["morning", "tide"],
                "min_overlap_ratio": 0.5,
            }
        ],
    },
}


def files_under(folder, suffix):
    return sorted(
        os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(suffix)
    )


def by_split(frame):
    return {r.split: (r.rows, r.duration_seconds, r.duration_hours) for r in frame.collect()}


EXPECTED = {"train": (3, 8.0, 0.002222), "validation": (1, 0.0, 0.0)}


@pytest.mark.parametrize("output_format", ["parquet", "arrow", "both"])
def test_end_to_end(spark, corpus, tmp_path, output_format):
    out = str(tmp_path / "out")
    done = m.materialize(spark, RECIPE, corpus, out, output_format=output_format)
    assert by_split(done.splits) == EXPECTED
    total = done.totals.first()
    assert (total.rows, total.duration_seconds, total.duration_hours) == (4, 8.0, 0.002222)
    assert json.loads(total.recipe) == RECIPE and total.audio_enabled is False
    back = m.reload(spark, out)
    assert back.where("split = 'validation'").first().record_id == "take-007-2"
    assert back.count() == 4
    assert m.reload(spark, out, ["train"]).count() == 3
    listed = {r.file.split("://")[-1].removeprefix("file:") for r in done.files.collect()}
    written = files_under(out + "/parquet", ".parquet") + files_under(out + "/arrow", ".arrow")
    assert listed == set(written)
    kinds = {"parquet": {"parquet"}, "arrow": {"arrow"}, "both": {"parquet", "arrow"}}
    assert {r.format for r in done.files.collect()} == kinds[output_format]


def test_arrow_files_hold_the_same_rows(spark, corpus, tmp_path):
    out = str(tmp_path / "out")
    m.materialize(spark, RECIPE, corpus, out, output_format="both")
    names = files_under(out + "/arrow", ".arrow")
    tables = [ipc.open_file(n).read_all() for n in names]
    assert sorted(i for t in tables for i in t.column("record_id").to_pylist()) == sorted(
        r.record_id for r in m.reload(spark, out).collect()
    )
    assert not os.path.exists(out + "/arrow/_staging")


@pytest.mark.parametrize("output_format,suffix", [("parquet", ".parquet"), ("arrow", ".arrow")])
def test_files_roll_over(spark, tmp_path, output_format, suffix):
    rows = spark.range(0, 1000, 1, 2).select(
        F.col("id").cast("string").alias("record_id"),
        F.lit(1.5).alias("duration_seconds"),
        F.when(F.col("id") % 10 == 0, "b/ü =x").otherwise("2024").alias("split"),
    )
    out = str(tmp_path)
    m.write_splits(rows, out, output_format=output_format, max_rows_per_file=100)
    names = files_under(out, suffix)
    read = pq.read_metadata if suffix == ".parquet" else lambda n: ipc.open_file(n).read_all()
    assert all(read(n).num_rows <= 100 for n in names) and len(names) == 12
    back = m.reload(spark, out)
    assert dict(rows_of(back.groupBy("split").count())) == {"2024": 900, "b/ü =x": 100}
    assert back.select("record_id").distinct().count() == 1000


def test_existing_output_is_an_error_unless_overwritten(spark, corpus, tmp_path):
    for kind in ("parquet", "arrow"):
        out = str(tmp_path / kind)
        m.materialize(spark, RECIPE, corpus, out, output_format=kind)
        with pytest.raises((PySparkException, FileExistsError)):
            m.materialize(spark, RECIPE, corpus, out, output_format=kind)
        done = m.materialize(spark, RECIPE, corpus, out, output_format=kind, mode="overwrite")
        assert by_split(done.splits) == EXPECTED and m.reload(spark, out).count() == 4


def test_audio_goes_along_only_when_asked(spark, corpus, tmp_path):
    for kind in ("parquet", "arrow"):
        out = str(tmp_path / kind)
        m.materialize(spark, RECIPE, corpus, out, include_audio=True, output_format=kind)
        back = m.reload(spark, out)
        sounds = {r.record_id: bytes(r.audio["bytes"]) for r in back.collect()}
        assert sounds["take-007-1"] == b"x" * 10 and set(sounds.values()) == {b"x" * 10, b"y"}
    assert "audio" not in m.select_rows(spark, RECIPE, corpus).columns


def test_selection_is_one_stage_and_needs_no_sort(spark, corpus):
    rows = m.select_rows(spark, RECIPE, corpus, include_audio=True)
    plan = plan_of(rows)
    assert "Exchange" not in plan and "Sort" not in plan and "Python" not in plan
    before = spark.conf.get(m.CONCURRENT_WRITERS)
    with m._without_sort(spark):
        assert int(spark.conf.get(m.CONCURRENT_WRITERS)) >= 3
    assert spark.conf.get(m.CONCURRENT_WRITERS) == before


def test_rebalance_keeps_all_rows(spark, corpus, tmp_path):
    out = str(tmp_path)
    done = m.materialize(spark, RECIPE, corpus, out, rebalance=True)
    assert by_split(done.splits) == EXPECTED


def test_vocabulary_tables_override_the_recipe(spark, corpus, tmp_path):
    words = spark.createDataFrame([("market",)], "token string")
    rows = m.select_rows(
        spark, RECIPE, corpus,
        filters={
            "interviews": m.VocabularyFilter(words, 0.5), "news": OverlapFilter(min_tokens=4)
        },
    )
    assert [r.record_id for r in rows.collect()] == ["take-007-2"]
    assert rows.columns[-1] == "split" and "_path" not in rows.columns


def test_manifest_records_added_filters(spark, corpus, tmp_path):
    filters = {"news": OverlapFilter(("text",), 0.1, 4)}
    done = m.materialize(spark, RECIPE, corpus, str(tmp_path), filters=filters)
    section = json.loads(done.totals.first().recipe)["filters"]
    assert section["status"] == "configured" and len(section["pipeline"]) == 2
    assert section["pipeline"][1] == {
        "type": "text_frequency_overlap", "dataset_key": "news", "top_tokens": ["text"],
        "min_overlap_ratio": 0.1, "min_text_tokens": 4, "max_text_tokens": None,
    }
    assert len(RECIPE["filters"]["pipeline"]) == 1
    again = m.select_rows(spark, {**RECIPE, "filters": section}, corpus)
    assert again.count() == done.totals.first().rows == 2


def test_intermediate_tables_go_to_the_shared_folder(spark):
    assert new_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_bad_recipes_fail_before_any_job(spark, corpus):
    with pytest.raises(ValueError):
        m.select_rows(spark, {**RECIPE, "split_strategy": {"policy": "other"}}, corpus)
    with pytest.raises(KeyError):
        m.select_rows(spark, RECIPE, {})
    with pytest.raises(ValueError):
        m.write_splits(spark.range(1), "/nowhere", output_format="csv")
    with pytest.raises(ValueError):
        m.write_splits(spark.range(1), "/nowhere", max_rows_per_file=0)


def test_policy_defaults_to_preserve(spark, corpus):
    recipe = {"selected_datasets": [{"dataset_key": "interviews", "selected_splits": ["test"]}]}
    assert m.select_rows(spark, recipe, corpus).first().split == "test"


def test_nothing_selected(spark, corpus, tmp_path):
    done = m.materialize(spark, {"selected_datasets": []}, corpus, str(tmp_path))
    assert done.splits.count() == 0
    total = done.totals.first()
    assert (total.rows, total.duration_seconds, total.duration_hours) == (0, 0.0, 0.0)


def test_reload_of_nothing(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        m.reload(spark, str(tmp_path))


def test_summary_and_totals(spark, corpus):
    rows = assign_split(canonical_rows(spark, corpus["news"]), "preserve")
    assert by_split(split_summary(rows)) == {"train": (2, 8.0, 0.002222)}
    assert rows_of(split_totals(rows)) == [(2, 8.0, 0.002222)]
    assert rows_of(split_totals(rows.where("false"))) == [(0, 0.0, 0.0)]


def test_top_token_report(spark, tmp_path):
    path = tmp_path / "report.json"
    path.write_text(json.dumps({"result": {"top_tokens": [["river", 7], ["stone", 4]]}}, indent=1))
    assert rows_of(read_top_tokens(spark, str(path), 1)) == [(0, "river")]
    assert rows_of(read_top_tokens(spark, str(path))) == [(0, "river"), (1, "stone")]
    path.write_text("{}")
    assert rows_of(read_top_tokens(spark, str(path))) == []
    counts = spark.createDataFrame([("b", 2), ("a", 2), ("c", 10)], "token string, cnt long")
    write_top_tokens(counts, str(tmp_path / "out"))
    assert [r.token for r in read_top_tokens(spark, str(tmp_path / "out")).collect()] == [
        "c", "a", "b"
    ]


@pytest.mark.parametrize("output_format", ["parquet", "arrow", "both"])
def test_modes(spark, tmp_path, output_format):
    rows = spark.createDataFrame([(f"r{i}", "train", 1.0) for i in range(10)],
                                 "record_id string, split string, duration_seconds double")
    out = str(tmp_path / "out")
    write = lambda mode, n=10: m.write_splits(
        rows.limit(n), out, output_format=output_format, mode=mode
    )

    def held():
        wanted = ("parquet", "arrow") if output_format == "both" else (output_format,)
        found = {"parquet": m._parquet_or_none(spark, out), "arrow": m._arrow_or_none(spark, out)}
        assert {k for k, v in found.items() if v is not None} == set(wanted)
        return {found[k].count() for k in wanted}

    write("errorifexists")
    with pytest.raises(FileExistsError):
        write("errorifexists")
    assert held() == {10}
    write("append")
    assert held() == {20}
    write("ignore", 3)
    assert held() == {20}
    write("overwrite", 3)
    assert held() == {3}
    with pytest.raises(ValueError):
        write("other")


@pytest.mark.parametrize("first,second", [("parquet", "arrow"), ("arrow", "parquet"), ("both", "arrow")])
def test_format_changes(spark, corpus, tmp_path, first, second):
    out = str(tmp_path / "out")
    m.materialize(spark, RECIPE, corpus, out, output_format=first)
    for mode, error in (("errorifexists", FileExistsError), ("append", ValueError)):
        with pytest.raises(error):
            m.materialize(spark, RECIPE, corpus, out, output_format=second, mode=mode)
    fewer = {**RECIPE, "selected_datasets": RECIPE["selected_datasets"][:1]}
    m.materialize(spark, fewer, corpus, out, output_format=second, mode="overwrite")
    assert m.reload(spark, out).count() == 2
    assert {r.format for r in m.read_manifest(spark, out).files.collect()} == {second}


@pytest.mark.parametrize("output_format", ["parquet", "arrow"])
def test_reload_reads_the_named_splits_and_columns(spark, corpus, tmp_path, output_format):
    out = str(tmp_path / "out")
    m.materialize(spark, RECIPE, corpus, out, output_format=output_format)
    if output_format == "arrow":
        for path in files_under(f"{out}/arrow/split=train", ".arrow"):
            os.truncate(path, 0)  # a reader that opens these files fails
    kept = m.reload(spark, out, ["validation"], ["record_id"])
    assert rows_of(kept) == [("take-007-2",)]
    if output_format == "parquet":
        plan = plan_of(kept)
        assert "split" in plan.split("PartitionFilters: [")[1].split("]")[0]
        assert "ReadSchema: struct<record_id:string>" in plan


def test_manifest_replays_a_vocabulary_table(spark, corpus, tmp_path):
    words = spark.createDataFrame([("morning", 0), ("zzz", 1), ("market", 2)], "token string, rank int")
    plain = {**RECIPE, "filters": {"status": "not_started", "pipeline": []}}
    config = m.VocabularyFilter(words, 1.0, top_k=2)
    out = str(tmp_path / "first")
    m.materialize(spark, plain, corpus, out, filters={"interviews": config})
    recipe = json.loads(m.read_manifest(spark, out).totals.first().recipe)
    again = m.materialize(spark, recipe, corpus, str(tmp_path / "again"))
    ids = lambda folder: sorted(r.record_id for r in m.reload(spark, folder).collect())
    assert ids(again.out_dir) == ids(out)
    assert not {"take-007-1", "take-007-2"} & set(ids(out))  # of "morning market" the first two ranks are a half


def test_overlap_without_a_vocabulary_is_an_error(spark, corpus):
    entry = {"type": "text_frequency_overlap", "dataset_key": "news", "min_overlap_ratio": 0.5}
    recipe = {**RECIPE, "filters": {"status": "configured", "pipeline": [entry]}}
    with pytest.raises(ValueError, match="no vocabulary"):
        m.select_rows(spark, recipe, corpus)


def test_small_inputs_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "many.parquet")
    spark.range(200_000).selectExpr("concat('word ', id, ' ', id * 7) AS text").write.parquet(path)
    source = Source(SourceSpec(key="k", dataset="d", subset="s", text_column="text"), {"train": path})
    recipe = {"selected_datasets": [{"dataset_key": "k", "selected_splits": ["train"]}],
              "filters": {"pipeline": [{"type": "text_frequency_overlap", "dataset_key": "k",
                                        "min_text_tokens": 2}]}}
    assert "Exchange" not in plan_of(m.select_rows(spark, recipe, {"k": source}))



def test_reload_reads_only_what_the_manifest_lists(spark, corpus, tmp_path):
    out = str(tmp_path / "out")
    done = m.materialize(spark, RECIPE, corpus, out)
    listed = done.totals.first().rows
    # An append that breaks off after its files, before its manifest.
    rows = m.select_rows(spark, RECIPE, corpus)
    assert m.write_files(rows, out, {"parquet"}, 100, False)
    assert m.versions(spark, out) == [1]
    assert m.reload(spark, out).count() == listed
    assert m._reload_folder(spark, out, None, None).count() == 2 * listed


@pytest.mark.parametrize("output_format", ["parquet", "arrow"])
def test_versions_append_and_overwrite(spark, corpus, tmp_path, output_format):
    out = str(tmp_path / "out")
    fewer = {**RECIPE, "selected_datasets": RECIPE["selected_datasets"][:1]}
    first = m.materialize(spark, RECIPE, corpus, out, output_format=output_format).totals.first().rows
    m.materialize(spark, RECIPE, corpus, out, output_format=output_format, mode="append")
    assert m.reload(spark, out).count() == 2 * first
    m.materialize(spark, fewer, corpus, out, output_format=output_format, mode="overwrite")
    small = m.reload(spark, out).count()
    assert 0 < small < first
    assert m.versions(spark, out) == [1, 2, 3]
    assert m.read_manifest(spark, out, 2).totals.first().rows == 2 * first
    assert m.read_manifest(spark, out).totals.first().rows == small
    assert m.reload(spark, out, ["train"]).count() <= small


def test_replay_in_place_twice(spark, corpus, tmp_path):
    words = spark.createDataFrame([("morning", 0), ("zzz", 1), ("market", 2)], "token string, rank int")
    plain = {**RECIPE, "filters": {"status": "not_started", "pipeline": []}}
    out = str(tmp_path / "out")
    m.materialize(spark, plain, corpus, out, filters={"interviews": m.VocabularyFilter(words, 1.0, top_k=2)})
    ids = lambda: sorted(r.record_id for r in m.reload(spark, out).collect())
    first = ids()
    for version in (2, 3):
        recipe = json.loads(m.read_manifest(spark, out).totals.first().recipe)
        m.materialize(spark, recipe, corpus, out, mode="overwrite")
        assert ids() == first
        again = json.loads(m.read_manifest(spark, out).totals.first().recipe)
        paths = [e["vocabulary_path"] for e in again["filters"]["pipeline"] if e.get("vocabulary_path")]
        assert len(paths) == 1 and f"/_manifest/v={version}/" in paths[0]


def test_a_version_is_committed_once(spark, tmp_path):
    out = str(tmp_path / "out")
    spark.range(1).write.parquet(f"{out}/_manifest/v=1/files")
    spark.range(1).write.parquet(f"{out}/_manifest/_pending-x/files")
    with pytest.raises(RuntimeError, match="committed by another run"):
        m._commit(spark, f"{out}/_manifest/_pending-x", out, 1)


def test_manifests_keep_speaker_sketches(spark, corpus, tmp_path):
    out = str(tmp_path / "out")
    m.materialize(spark, RECIPE, corpus, out)
    exact = {
        r.split: r.n for r in m.reload(spark, out).groupBy("split").agg(F.countDistinct("speaker_id").alias("n")).collect()
    }
    every = m.reload(spark, out).select(F.countDistinct("speaker_id")).first()[0]
    counted = {r.split: r.speakers for r in m.speaker_counts(spark, out).collect()}
    assert counted == {**exact, None: every}
    m.materialize(spark, RECIPE, corpus, out, mode="append")
    assert {r.split: r.speakers for r in m.speaker_counts(spark, out).collect()} == counted
    assert {r.split: r.speakers for r in m.speaker_counts(spark, out, 1).collect()} == counted


def test_speaker_sketches_are_within_two_percent(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = spark.range(60_000).selectExpr(
        "concat('r', id) AS record_id", "IF(id % 2 = 0, 'train', 'test') AS split",
        "concat('s', id % 40000) AS speaker_id",
    )
    new = m.write_files(rows, out, {"parquet"}, 100_000, False)
    sketches = m._speaker_sketches(spark, out, new)
    merged = sketches.agg(F.hll_sketch_estimate(F.hll_union_agg("speakers"))).first()[0]
    assert abs(merged - 40_000) <= 800
    for r in sketches.select("split", F.hll_sketch_estimate("speakers").alias("n")).collect():
        assert abs(r.n - 20_000) <= 400
