import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table of ``(doc_id, text)`` rows or whole rows, over several tasks."""

    def make(rows, schema=SCHEMA):
        if schema == SCHEMA:
            full = [
                r if len(r) == 5 else (*r, "en", f"s{i % 3}", None if r[1] is None else len(r[1]))
                for i, r in enumerate(rows)
            ]
        else:
            full = rows
        return spark.createDataFrame(full, schema).repartition(3)

    return make


SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sample(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")


@pytest.fixture(scope="session")
def texts(sample):
    """Texts of the smallest tables by id."""
    return {r.doc_id: r.text for r in sample("documents").select("doc_id", "text").collect()}
