import re
from collections import Counter
from math import comb

import pytest
from pyspark.sql import functions as F

from gatewright.llm import quality_rules as qr

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), repeated, len(covered))


def test_measures_equal_brute_force(documents, texts):
    got = qr.features(documents(texts)).orderBy("doc_id").collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert [tuple(r[n] for n in names) for r in got] == [brute(t) for t in texts]
    for r, t in zip(got, texts):
        n, repeat = brute(t)[0], brute(t)[4]
        assert r.base_failed == (n < 50 or 100 * repeat > 50 * n)


@pytest.mark.parametrize("k,n,p", [(0, 10, 0.1), (3, 40, 0.05), (7, 200, 0.02), (0, 3000, 0.005), (20, 5000, 0.004)])
def test_binomial_tail_is_exact(spark, k, n, p):
    got = spark.range(1).select(qr.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).first()[0]
    assert got == pytest.approx(sum(comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1)), rel=1e-9)


def _measures(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, stratum string, base_failed boolean, symbol_share double, "
                                       "dup_line_share double, repeat_share double, shout_share double")


def test_cutoffs_reject_bad_and_keep_the_promise(spark, rng):
    rows, labels = [], []
    for i in range(6000):
        good = i % 4 != 0
        share = rng.random() * (0.1 if good else 1.0)
        rows.append((i, "a" if i < 5000 else "b", False, share, 0.0, 0.0, 0.0))
        labels.append((i, int(good)))
    df, labels = _measures(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int")
    cut = {r.stratum: r for r in qr.certified_cutoffs(df, labels).collect()}
    assert 0.09 < cut["a"].max_symbol_share < 0.2 and cut["a"].max_repeat_share is None
    assert "b" not in cut  # too few labels for the promise
    none = qr.certified_cutoffs(df, labels.where("false"))
    assert none.count() == 0


def test_too_many_good_documents_over_a_cutoff_end_the_search(spark):
    rows = [(i, "a", False, 0.5 if i % 10 == 0 else 0.0, 0.0, 0.0, 0.0) for i in range(8000)]
    labels = spark.createDataFrame([(i, 0 if i % 10 == 0 and i % 3 == 0 else 1) for i in range(8000)],
                                   "doc_id long, quality int")
    assert qr.certified_cutoffs(_measures(spark, rows), labels).count() == 0


def test_repeated_rows_are_one_trial(spark):
    """Too few labelled ids for the promise stay too few, however often their rows come."""
    rows = [(i, "a", False, 0.9 if i % 4 == 0 else 0.0, 0.0, 0.0, 0.0) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(400)], "doc_id long, quality int")
    assert qr.certified_cutoffs(_measures(spark, rows), labels).count() == 0
    assert qr.certified_cutoffs(_measures(spark, rows * 10), labels).count() == 0
    more = [(i, "a", False, 0.9 if i % 4 == 0 else 0.0, 0.0, 0.0, 0.0) for i in range(4000)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(4000)], "doc_id long, quality int")
    assert qr.certified_cutoffs(_measures(spark, more), labels).count() == 1


def test_filter_keeps_rows_and_columns(spark, documents):
    fine = " ".join(f"w{i}" for i in range(60))
    docs = documents([fine, "short", None, fine, "a a a " * 30], ids=[1, 2, 3, 1, None])
    labels = spark.createDataFrame([(1, 1), (2, None)], "doc_id long, quality int")
    kept = qr.filter_documents(docs, labels)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1, 1]
    assert qr.filter_documents(docs.where("false"), labels).count() == 0
    assert qr.judge(docs, labels.where("false")).count() == 5


def test_no_python_in_the_plan(spark):
    query = qr.op10_quality_rules(spark, "/root/testdata/sf0.001")
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
