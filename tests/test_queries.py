import pytest

import __spark_entry__ as entry
from tests.check_oracles import compare, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_entry(spark):
    report = entry.entry(spark)
    assert {"direction", "halted_by", "messages"} <= set(report.columns) and report.count() > 0


def test_every_query_has_sql():
    assert set(entry.ORACLES) == set(entry.QUERIES)


@pytest.mark.parametrize("name", list(entry.QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, FOLDER, name) is None


def test_stream_restore_with_null_and_repeated_ids(spark, tmp_path):
    rows = [(None, "write to ann@example.com now", "en", "s", 1), (None, "nothing here", "en", "s", 1),
            (3, "first ann@example.com", "en", "s", 1), (3, "second bob@example.com", "en", "s", 1)]
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").schema
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "documents.parquet"))
    assert compare(spark, duck_documents(tmp_path), str(tmp_path), "stream_pii_restore") is None


def duck_documents(folder):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    return con
