import corpus_pipeline
from utterflow.llm import queries


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "near duplicates", "benchmark decontamination", "secret scans", "mixture",
    ]


def test_each_stage_works_on_what_is_left(spark, sample):
    folder = "/root/testdata/sf0.001"
    docs = sample("documents")
    names = docs.columns
    ids = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, docs, folder)
        assert result.columns == names, name
        left = {r.doc_id for r in result.select("doc_id").collect()}
        assert left and left <= ids
        assert (left == ids) == (name == "secret scans"), name
        ids = left
        docs = spark.createDataFrame(result.collect(), result.schema)
    final = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert final and {r.doc_id for r in final} <= ids
    assert all(0 < r.taken <= 3 * r.size for r in final)
    assert {tuple(r) for r in corpus_pipeline.run(spark, folder).collect()} == {tuple(r) for r in final}


def test_stages_take_empty_tables_and_nulls(spark, sample):
    folder = "/root/testdata/sf0.001"
    schema = sample("documents").schema
    empty = spark.createDataFrame([], schema)
    nulls = spark.createDataFrame([(None,) * len(schema)] * 2, schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder).count() == 0, name
        assert stage(spark, nulls, folder).count() <= 2, name


def test_every_operator_has_a_query():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 14))
    assert set(queries.ORACLE) <= set(queries.QUERIES)
