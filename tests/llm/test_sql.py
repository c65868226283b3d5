"""Registered queries against their SQL on a small corpus with nulls, copies and enough labels for cutoffs."""

import duckdb
import pytest

from gatewright.llm.queries import ORACLES, QUERIES
from tests.check_oracles import compare


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    import random

    rng = random.Random(2)
    folder = tmp_path_factory.mktemp("corpus")
    words = [f"w{i}" for i in range(900)] + ["Añb", "X1,y2"]
    docs, labels = [], []
    for i in range(5000):
        good = i % 5 != 0
        text = rng.choices(words, k=rng.randint(50, 70))
        if not good:
            text[::2] = ["|"] * len(text[::2])
        docs.append((i, " ".join(text), "en" if i % 50 else None))
        labels.append((i, int(good)))
    item = "the quick brown fox jumps over it and then runs far away"
    docs += [(6000, None, "en"), (6001, "", "de"), (6002, "a b a b a b a b\na b\na b\n\n", "de"),
             (6003, f"so: {item.upper()}! lone wolf", "de"), (6004, "Lone lone-wolf", None), (6005, " \t\x0b", "x")]
    spark.createDataFrame(docs, "doc_id long, text string, lang string").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").coalesce(1).write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, "lone wolf"), (3, None), (4, "...")], "item_id long, text string"
                          ).coalesce(1).write.parquet(f"{folder}/benchmark.parquet")
    pages = [(1, "http://a.org/", "x" * 1200), (2, "http://b.net/fr/1", "x" * 1200), (3, None, None), (4, "q", "é" * 600)]
    spark.createDataFrame(pages, "page_id long, url string, html string").coalesce(1).write.parquet(f"{folder}/pages.parquet")
    con = duckdb.connect()
    for name in ("documents", "labels", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    return str(folder), con


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, corpus, name, monkeypatch):
    import __spark_entry__ as entry

    folder, con = corpus
    monkeypatch.setattr(entry, "queries", lambda: dict(QUERIES))
    monkeypatch.setattr(entry, "oracle_sql", lambda: dict(ORACLES))
    assert compare(spark, con, folder, name) is None


def test_rules_reject_beyond_the_base_filter(spark, corpus):
    got = QUERIES["op10_quality_rules"](spark, corpus[0])
    assert got.where("not kept and not base_failed").count() >= 900
    assert got.where("not kept and doc_id < 5000 and doc_id % 5 != 0").count() < 100
