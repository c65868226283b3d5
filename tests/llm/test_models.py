import numpy as np
import pytest
from pyspark.sql import functions as F

from gatewright.llm import quality_model as qm
from gatewright.llm import sampling
from gatewright.llm import toxicity as tx

import zlib


@pytest.fixture()
def marked(spark, rng):
    """Texts of which a tenth hold one of three bad words."""
    words = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(1500):
        text = rng.choices(words, k=rng.randint(5, 60))
        toxic = i % 10 == 0
        if toxic:
            text[rng.randrange(len(text))] = rng.choice(["vilest", "Foulest!", "grubbing", "grubbed"])
        rows.append((i, " ".join(text), 0.5))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxic_words_are_found_in_the_held_out_fold(marked):
    docs, labels = marked
    got = tx.judge(docs, labels).join(labels, "doc_id").collect()
    assert len(got) == 1500
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.7)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == r.toxic for r in held) >= 0.99 * len(held)


def test_labels_of_the_held_out_fold_are_not_used(marked):
    docs, labels = marked
    flipped = labels.withColumn("toxic", F.when(
        F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert tx.fit(docs, labels) == tx.fit(docs, flipped)


def test_toxicity_of_odd_tables(spark, marked):
    docs, labels = marked
    odd = spark.createDataFrame([(1, None), (1, None), (None, ""), (3, "x " * 50_000), (4, "vilest " * 3)],
                                "doc_id long, text string")
    got = tx.score(odd, tx.fit(docs, labels)).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert [r.score for r in got if r.doc_id == 4][0] > 0.7
    assert tx.judge(odd, labels.where("false")).where("predicted = 1").count() == 0
    assert tx.judge(odd.where("false"), labels).count() == 0


def test_the_risk_of_negatives_never_pays_off_below_zero():
    """All text is positive: without the correction every text would come out negative."""
    rows = [np.array([5, 9], np.int32)] * 50
    weights, bias = tx.train(rows, rows, 0.9)
    assert tx._sigmoid(bias + sum(weights.values())) > 0.6


def test_trees_separate_a_corner(rng):
    rand = np.random.default_rng(4)
    x = rand.random((4000, len(qm.STATISTICS)))
    y = ((x[:, 2] > 0.5) & (x[:, 7] < 0.3)).astype(float)
    trees = qm.grow(x[:3000], y[:3000])
    got = trees.score(x[3000:]) > 0.5
    assert (got == (y[3000:] > 0.5)).mean() > 0.98


def test_flat_trees_equal_a_walk(rng):
    rand = np.random.default_rng(5)
    x = rand.random((500, len(qm.STATISTICS)))
    trees = qm.grow(x, (x[:, 0] + x[:, 1] > 1).astype(float), trees=7)
    for row, score in zip(x, trees.score(x)):
        z = trees.base
        for t in range(7):
            node = 0
            while node < trees.feature.shape[1]:
                node = 2 * node + 1 + int(row[trees.feature[t, node]] > trees.threshold[t, node])
            z += trees.leaf[t, node - trees.feature.shape[1]]
        assert score == pytest.approx(1 / (1 + np.exp(-z)))


def test_quality_in_the_held_out_fold(spark, rng):
    rows, labels = [], []
    for i in range(900):
        good = i % 4 != 0
        words = [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(20, 80))] if good else ["same"] * 40
        rows.append((i, " ".join(words), "x"))
        labels.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, x string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    got = qm.judge(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(r.predicted == int(r.score >= 0.3) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.predicted == r.quality for r in held) >= 0.98 * len(held)
    none = qm.judge(docs, labels.where("false")).select("score").distinct().collect()
    assert [r.score for r in none] == [0.5]
    odd = spark.createDataFrame([(1, None), (1, ""), (None, "|" * 30_000), (2, "a\n" * 9)], "doc_id long, text string")
    assert qm.judge(odd, labels).where("score between 0 and 1").count() == 4
    assert qm.judge(docs.where("false"), labels).count() == 0


def test_statistics_of_a_text():
    x = dict(zip(qm.STATISTICS, qm.statistics("A b! b\nb |\nb |")))
    assert x["n_words"] == 7 and x["bars"] == 2 / 7 and x["exclaims"] == 1 / 7 and x["dup_lines"] == pytest.approx(1 / 3)
    assert qm.statistics(None) == [0.0] * len(qm.STATISTICS)


def test_samples_are_bounded_and_stable(spark):
    ids = spark.range(500).selectExpr("id AS doc_id")
    first = {r.doc_id for r in sampling.sampled(ids, 40).collect()}
    assert len(first) == 40 and first == {r.doc_id for r in sampling.sampled(ids.repartition(7), 40).collect()}
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "doc_id long, text string")
    assert sampling.texts_of(docs, ids.where("doc_id < 3")).count() == 2


def test_prior_counts_every_label(marked, monkeypatch):
    docs, labels = marked
    seen = []
    monkeypatch.setattr(tx, "MOST_FOR_PRIOR", 10, raising=False)
    monkeypatch.setattr(tx, "train", lambda positive, unlabelled, prior: seen.append(prior) or ({}, 0.0))
    tx.fit(docs, labels)
    known = [int(r.toxic) for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % tx.FOLDS != tx.HELD_OUT]
    assert seen == [pytest.approx(sum(known) / len(known))]
