import pyarrow as pa

from tests.conftest import PHRASES, write
from utterflow.operators.canonical import canonical_rows
from utterflow.operators.filters import OverlapFilter
from utterflow.operators.splits import assign_split
from utterflow.plans.materialize import reload
from utterflow.schema import Source
from utterflow.streaming.incremental import materialize_new_files, stream_rows, stream_table


def test_new_files_are_added_once_and_match_the_batch(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")

    def run():
        schema = spark.read.parquet(str(folder)).schema
        rows = stream_rows(spark, PHRASES, str(folder), schema, root=str(tmp_path))
        query = materialize_new_files(
            rows, out, str(tmp_path / "ckpt"), config=OverlapFilter(min_tokens=2), val_ratio=0.3
        )
        query.awaitTermination()

    def found():
        return sorted((r.record_id, r.split) for r in reload(spark, out).collect())

    def expected():
        rows = canonical_rows(
            spark, Source(PHRASES, {"train": str(folder)}, root=str(tmp_path))
        ).where("text like '% %'")
        assigned = assign_split(rows, "train-val", 0.3).collect()
        return sorted((r.record_id, r.split) for r in assigned)

    texts = [f"a {i}" if i % 3 else "a" for i in range(50)]
    write(folder / "1.parquet", {"text": pa.array(texts)})
    run()
    assert found() == expected() and {s for _, s in found()} == {"train", "validation"}
    run()
    assert found() == expected()
    write(folder / "2.parquet", {"text": pa.array(texts)})
    run()
    assert found() == expected() and len(found()) == 66


def test_duplicates_are_dropped_across_runs(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")

    def run():
        schema = spark.read.parquet(str(folder)).schema
        rows = stream_rows(spark, PHRASES, str(folder), schema, root=str(tmp_path))
        materialize_new_files(rows, out, str(tmp_path / "ckpt"), drop_duplicates=True).awaitTermination()

    def texts():
        return sorted(" ".join((r.text or "").lower().split()) for r in reload(spark, out).collect())

    write(folder / "1.parquet", {"text": pa.array(["a b", "A  b", "c", None, "   ", "c"])})
    run()
    first = texts()
    assert first == sorted(["a b", "c", "", ""])
    write(folder / "2.parquet", {"text": pa.array(["a b", "new words", "C", None])})
    run()
    assert texts() == sorted(first + ["new words", ""])
    run()
    assert texts() == sorted(first + ["new words", ""])


def test_a_table_may_be_one_file_or_a_folder_of_parts(spark, tmp_path):
    words = pa.array([f"some words {i % 7}" for i in range(30)])
    write(tmp_path / "one.parquet", {"text": words})
    for k in range(3):
        write(tmp_path / f"parts.parquet/part-{k}.parquet", {"text": words[k * 10 : k * 10 + 10]})
    write(tmp_path / "other.parquet", {"text": pa.array(["not asked for"])})
    for name in ("one.parquet", "parts.parquet"):
        out = str(tmp_path / "out" / name)
        schema = spark.read.parquet(str(tmp_path / name)).schema
        rows = stream_table(spark, PHRASES, str(tmp_path), name, schema, root=str(tmp_path))
        materialize_new_files(rows, out, f"{out}/_checkpoint").awaitTermination()
        batch = canonical_rows(spark, Source(PHRASES, {"train": str(tmp_path / name)}, root=str(tmp_path)))
        found, expected = ([(r.record_id, r.text) for r in t.collect()] for t in (reload(spark, out), batch))
        assert len(found) == 30 and sorted(found) == sorted(expected)


def test_stream_queries_read_a_table_of_parts(spark, tmp_path):
    import __spark_entry__ as entry

    texts = [" ".join(["word"] * (25 + i % 4)) for i in range(12)]
    for k in range(2):
        own = slice(6 * k, 6 * k + 6)
        columns = {
            "doc_id": pa.array(range(12))[own], "text": pa.array(texts)[own],
            "lang": pa.array(["en"] * 12)[own], "source": pa.array(["s"] * 12)[own], "n_chars": pa.array([0] * 12)[own],
        }
        write(tmp_path / f"documents.parquet/part-{k}.parquet", columns)
    assert entry.stream_documents(spark, str(tmp_path)).count() == 12
    assert entry.stream_first_transcripts(spark, str(tmp_path)).count() == 4
