import pytest

from tests.conftest import rows_of
from utterflow.operators.canonical import canonical_rows
from utterflow.plans import catalog
from utterflow.plans.materialize import materialize


def test_catalog(spark, corpus):
    found = {
        (r.dataset_key, r.source_split): (r.rows, r.exported, r.train_only)
        for r in catalog.source_catalog(spark, list(corpus.values())).collect()
    }
    assert found == {
        ("interviews", "train"): (2, True, False),
        ("interviews", "validation"): (1, True, False),
        ("interviews", "test"): (1, True, False),
        ("interviews", "unlabeled"): (1, False, False),
        ("news", "train"): (2, True, True),
        ("phrases", "train"): (2, True, True),
    }
    everything = catalog.source_catalog(spark, [corpus["interviews"]], include_unexported=True)
    assert all(r.exported for r in everything.collect())
    mapping = catalog.source_catalog(spark, [corpus["news"]]).first().column_mapping
    assert mapping["text"] == "corrected_text" and mapping["record_id"] == "<derived>"
    assert mapping["language"] == "<default:en-GH>" and mapping["gender"] is None


def test_exported_rows(spark, corpus):
    sources = list(corpus.values())
    rows = canonical_rows(spark, corpus["interviews"])
    assert catalog.exported_rows(rows, sources).count() == 4
    assert catalog.exported_rows(rows, sources, include_unexported=True).count() == 5
    assert catalog.exported_rows(canonical_rows(spark, corpus["news"]), sources).count() == 2


def test_draft_recipe(spark, corpus, tmp_path):
    recipe = catalog.draft_recipe(spark, list(corpus.values()), analyses=("schema",))
    inter = recipe["selected_datasets"][0]
    assert inter["selected_splits"] == ["test", "train", "validation"]
    assert inter["upstream_split_counts"] == {
        "train": 2, "validation": 1, "test": 1, "unlabeled": 1
    }
    assert recipe["split_strategy"]["policy"] == "train-val"
    assert materialize(spark, recipe, corpus, str(tmp_path)).totals.first().rows == 8
    own = catalog.draft_recipe(spark, [corpus["interviews"]])
    assert own["split_strategy"]["policy"] == "preserve"
    with pytest.raises(KeyError):
        catalog.draft_recipe(spark, [], analyses=("noise",))
    with pytest.raises(ValueError):
        catalog.draft_recipe(spark, [], val_ratio=-1)


def test_preview_and_inspect(spark, corpus):
    head = catalog.preview(spark, corpus["interviews"], "train", 1)
    assert [r.record_id for r in head.collect()] == ["take-007-1"]
    found = catalog.inspect_sources(spark, corpus, sample_size=1)
    assert [(r.dataset_key, r.source_split, r.rows_sampled) for r in found.collect()] == [
        ("interviews", "test", 1), ("interviews", "train", 1), ("interviews", "unlabeled", 1),
        ("interviews", "validation", 1), ("news", "train", 1), ("phrases", "train", 1),
    ]
    one = catalog.inspect_sources(spark, [corpus["news"]], split="absent")
    assert rows_of(one.select("rows_sampled", "available_splits")) == [(0, "train")]
    assert catalog.inspect_sources(spark, []).count() == 0


def test_inspect_report_has_mapping_and_preview(spark, corpus):
    found = catalog.inspect_report(spark, corpus, sample_size=2, preview_rows=1).collect()
    news = next(r for r in found if r.dataset_key == "news")
    assert (news.rows_sampled, news.available_splits) == (2, "train")
    assert news.column_mapping["text"] == "corrected_text"
    assert [p.text for p in news.preview] == ["harbour prices rose"]
    assert catalog.inspect_report(spark, []).count() == 0


def test_analysis_takes_the_default_split(spark, corpus):
    import dataclasses

    source = corpus["interviews"]
    spec = dataclasses.replace(source.spec, default_splits=("absent", "validation"))
    named = dataclasses.replace(source, spec=spec)
    assert catalog.analyze(spark, named, "text-length").first().rows == 1
    assert catalog.analyze(spark, named, "text-length", "train").first().rows == 2


def test_train_only_can_be_declared(corpus):
    import dataclasses

    source = corpus["news"]
    assert catalog.default_policy([source]) == "train-val"
    spec = dataclasses.replace(source.spec, train_only=False)
    assert catalog.default_policy([dataclasses.replace(source, spec=spec)]) == "preserve"
