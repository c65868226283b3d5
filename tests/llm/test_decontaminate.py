import hashlib
import re

import pytest
from pyspark.sql import functions as F

from gatewright.llm import decontaminate as dc

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, n):
    w = words(text)
    hit, found = set(), set()
    for item, body in items:
        b = words(body)
        grams = {tuple(b[i:i + n]) for i in range(max(1, len(b) - n + 1))} if b else set()
        for gram in grams:
            for i in range(len(w) - len(gram) + 1):
                if tuple(w[i:i + len(gram)]) == gram:
                    hit |= set(range(i, i + len(gram)))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


ITEMS = [(7, "The quick, brown FOX jumps over it."), (11, "Añb É x1"), (10, "lone"), (3, None), (4, "..."),
         (12, "quick brown fox jumps over it now and then"), (7, "The quick brown fox jumps")]


@pytest.fixture()
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


@pytest.fixture()
def corpus(texts):
    return [*texts, "see: the QUICK brown fox-jumps over it now, and then", "Lone wolf", "añb É x1 añb é X1",
            "the quick brown fox jumps " * 50, "lone " * 30]


@pytest.mark.parametrize("n", [3, 5, 10])
def test_hits_equal_brute_force(documents, corpus, items, n):
    got = dc.contamination(documents(corpus), items, n).orderBy("doc_id").collect()
    assert len(got) == len(corpus)
    for r, text in zip(got, corpus):
        assert (r.n_words, r.n_hit, list(r["items"])) == brute(text, ITEMS, n)
        assert r.contaminated == (r.n_hit > 0)


def test_query_columns(spark):
    r = dc.op3_decontaminate(spark, "/root/testdata/sf0.001").where("n_items = 0").first()
    assert r.items_sha256 == hashlib.sha256().hexdigest() and not r.contaminated


def test_removal_leaves_nothing_and_touches_nothing_else(documents, corpus, items):
    docs = documents(corpus)
    cleaned = dc.remove(docs, items, 4)
    assert cleaned.columns == docs.columns and cleaned.count() == len(corpus)
    hits = {r.doc_id for r in dc.contamination(docs, items, 4).where("contaminated").collect()}
    assert dc.contamination(cleaned, items, 4).where("contaminated").count() == 0
    for r in cleaned.collect():
        if r.doc_id in hits:
            assert len(words(r.text)) == brute(corpus[r.doc_id], ITEMS, 4)[0] - brute(corpus[r.doc_id], ITEMS, 4)[1]
            assert r.n_chars == len(r.text)
        else:
            assert r.text == corpus[r.doc_id]
    kept = {r.doc_id for r in dc.remove(docs, items, 4, whole=True).collect()}
    assert kept == set(range(len(corpus))) - hits
    text = "Say: the quick  BROWN fox-jumps over it now, x1!"
    out = dc.remove(documents([text]), items, 4).first().text
    assert out == "Say: \nx1!"


def test_empty_tables_and_repeated_rows(spark, documents, items):
    docs = documents(["lone", "lone", "x", "lone"], ids=[1, 1, 1, None])
    got = dc.contamination(docs, items)
    assert sorted((r.doc_id or 0, r.n_hit) for r in got.collect()) == [(0, 1), (1, 0), (1, 1), (1, 1)]
    assert dc.contamination(docs, items.where("false")).where("contaminated").count() == 0
    assert dc.contamination(docs.where("false"), items).count() == 0
    assert dc.remove(docs, items).count() == 4


def test_a_full_bitmap_loses_nothing(documents, corpus, items, monkeypatch):
    monkeypatch.setattr(dc, "SLOT_BYTES", 1)
    got = dc.contamination(documents(corpus), items, 3).orderBy("doc_id").collect()
    assert [r.n_hit for r in got] == [brute(t, ITEMS, 3)[1] for t in corpus]


def test_no_python_in_the_plan(spark):
    plan = dc.op3_decontaminate(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_windows_are_compiled(spark, documents, corpus, items):
    """Every word is looked at: no function that Spark interprets for each element."""
    scanned = dc.scan(documents(corpus), dc.item_ngrams(items, 3), 3)
    assert "lambda" not in scanned._jdf.queryExecution().executedPlan().toString()
    rows = scanned.collect()
    assert sorted(r.doc_id for r in rows if r.pos is None) == list(range(len(corpus)))
    assert all(words(corpus[r.doc_id])[r.pos:r.pos + len(r.ngram)] == r.ngram for r in rows if r.pos is not None)
    odd = "".join(map(chr, range(300))) + "\U0001f600a B\x85c"
    assert documents([odd]).select(dc.words_of(F.col("text"))).first()[0] == words(odd)
