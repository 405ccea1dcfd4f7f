import duckdb
import pytest

from utterflow.operators import scripts

ROWS = [
    (1, "plain English words"),
    (2, "Ελληνικά γράμματα εδώ"),
    (3, "Русский текст и English"),
    (4, "mixed Ελλάδα and more Latin letters here"),
    (5, None),
    (6, ""),
    (7, "1234 !!! ..."),
    (8, "Äpfel, Öl und Straße"),
    (9, "漢字とひらがな"),
]


def oracle(min_share):
    values = ", ".join(f"({i}, {'NULL' if t is None else chr(39) + t + chr(39)})" for i, t in ROWS)
    sql = f"""SELECT id, len(regexp_extract_all(coalesce(text, ''), '\\p{{L}}')) AS n_letters,
      len(regexp_extract_all(coalesce(text, ''), '\\p{{Latin}}')) AS n_script
      FROM (VALUES {values}) AS v(id, text)"""
    rows = duckdb.sql(sql).fetchall()
    return sorted(r for r in rows if r[1] > 0 and r[2] >= min_share * r[1])


@pytest.mark.parametrize("share", [0.0, 0.5, 0.9, 1.0])
def test_latin_share_equals_sql(spark, share):
    table = spark.createDataFrame(ROWS, "id long, text string")
    got = sorted(tuple(r) for r in scripts.by_script(table, "Latin", share).select("id", "n_letters", "n_script").collect())
    assert got == oracle(share)


def test_greek_and_errors(spark):
    table = spark.createDataFrame(ROWS, "id long, text string")
    assert {r.id for r in scripts.by_script(table, "Greek", 0.5).collect()} == {2}
    with pytest.raises(ValueError):
        scripts.by_script(table, "Klingon")
    with pytest.raises(ValueError):
        scripts.by_script(table, "Latin", 1.5)
