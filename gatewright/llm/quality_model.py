"""Quality scores by gradient-boosted trees over document statistics.

Statistics are cut into bins at their quantiles; trees are grown level by level
from histograms of gradients, and flattened into arrays in which a row's way
down is a few vectorised look-ups.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewright.llm.common import ship
from gatewright.llm.sampling import fold, sampled, texts_of

ship(__name__)

FOLDS, HELD_OUT = 5, 0
# Bound of the training sample.
MOST_ROWS = 20_000
CUTOFF = 0.3
BINS = 64
DEPTH = 4
TREES = 80
RATE = 0.12
LEAST_ROWS = 20
SHRINK = 1.0

STATISTICS = ("n_chars", "n_words", "mean_word", "long_words", "symbols", "exclaims", "bars", "upper", "digits",
              "stops", "other_script", "lines", "mean_line", "dup_lines", "distinct_words", "top_word",
              "stutters", "repeat_pairs")


def statistics(text: str | None) -> list[float]:
    """The statistics of a whole text; one without words has zeros."""
    text = text or ""
    words = text.split()
    n, chars = len(words), len(text)
    if not n:
        return [float(chars), *[0.0] * (len(STATISTICS) - 1)]
    count = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    sizes = np.fromiter(map(len, words), np.int64, n)
    letters = max(1, chars - n)
    upper = len(re.findall(r"[A-ZÀ-ÖØ-Þ]", text))
    pairs = Counter(zip(words, words[1:]))
    return [
        float(chars), float(n), float(sizes.mean()), float((sizes > 12).mean()),
        len(re.findall(r"[#*$%&<>@{}\\^~=_+]", text)) / letters, text.count("!") / n, text.count("|") / n,
        upper / letters, len(re.findall(r"[0-9]", text)) / letters, (text.count(".") + text.count(",")) / n,
        len(re.findall(r"[^\x00-\x7f]", text)) / letters, len(lines) / n, n / len(lines),
        1 - len(set(lines)) / len(lines), len(count) / n, max(count.values()) / n,
        sum(map(str.__eq__, words, words[1:])) / n, 1 - len(pairs) / max(1, n - 1),
    ]


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics ``x`` of every row."""
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def each(batches):
        for batch in batches:
            x = [statistics(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(x, pa.list_(pa.float64()))],
                                             ["doc_id", "x"])

    return rows.mapInArrow(each, f"doc_id {kind}, x array<double>")


class Trees:
    """Full trees of one depth: node i has the children 2i+1 and 2i+2; leaves follow."""

    def __init__(self, feature: np.ndarray, threshold: np.ndarray, leaf: np.ndarray, base: float):
        self.feature, self.threshold, self.leaf, self.base = feature, threshold, leaf, base

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of the rows of ``x``: all trees go down one level at a time."""
        count, inner = self.feature.shape
        if not count or not len(x):
            return np.full(len(x), 1 / (1 + np.exp(-self.base)))
        tree = np.arange(count)[None, :]
        row = np.arange(len(x))[:, None]
        node = np.zeros((len(x), count), np.int64)
        for _ in range(int(np.log2(inner + 1))):
            right = x[row, self.feature[tree, node]] > self.threshold[tree, node]
            node = 2 * node + 1 + right
        z = self.base + self.leaf[tree, node - inner].sum(1)
        return 1 / (1 + np.exp(-z))


def grow(x: np.ndarray, y: np.ndarray, *, trees: int = TREES, depth: int = DEPTH, bins: int = BINS,
         rate: float = RATE) -> Trees:
    """Boosted trees for the labels 0 and 1; one class alone gives its smoothed share."""
    n = len(y)
    share = (y.sum() + 1) / (n + 2) if n else 0.5
    base = float(np.log(share / (1 - share)))
    inner = 2 ** depth - 1
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, inner + 1))
    if not n or y.min() == y.max():
        return Trees(feature[:0], threshold[:0], leaf[:0], base)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], 1)
    z = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-z))
        grad, hess = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            best = np.full(width, 1e-6)
            for f, e in enumerate(edges):
                cell = (node - first) * bins + binned[:, f]
                g, h, c = (np.bincount(cell, weights=v, minlength=width * bins).reshape(width, bins).cumsum(1)
                           for v in (grad, hess, np.ones(n)))
                gl, hl, cl = g[:, :-1], h[:, :-1], c[:, :-1]
                gr, hr, cr = g[:, -1:] - gl, h[:, -1:] - hl, c[:, -1:] - cl
                gain = (gl ** 2 / (hl + SHRINK) + gr ** 2 / (hr + SHRINK)
                        - g[:, -1:] ** 2 / (h[:, -1:] + SHRINK))
                gain[(cl < LEAST_ROWS) | (cr < LEAST_ROWS)] = 0
                gain[:, len(e):] = 0
                at = gain.argmax(1)
                found = gain[np.arange(width), at]
                for k in np.flatnonzero(found > best):
                    best[k] = found[k]
                    feature[t, first + k], threshold[t, first + k] = f, e[at[k]]
            right = x[np.arange(n), feature[t, node]] > threshold[t, node]
            node = 2 * node + 1 + right
        g = np.bincount(node - inner, weights=grad, minlength=inner + 1)
        h = np.bincount(node - inner, weights=hess, minlength=inner + 1)
        leaf[t] = -rate * g / (h + SHRINK)
        z += leaf[t, node - inner]
    return Trees(feature, threshold, leaf, base)


def fit(docs: DataFrame, labels: DataFrame, *, most_rows: int = MOST_ROWS) -> Trees:
    """Trees from at most ``most_rows`` labelled ids outside the held-out fold.
    Null labels are left out; of contradicting labels the better counts."""
    known = labels.where((fold(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("quality").isNotNull()).groupBy(
        "doc_id").agg(F.max("quality").alias("quality"))
    ids = sampled(known, most_rows)
    rows = measured(texts_of(docs, ids)).join(F.broadcast(ids), "doc_id").orderBy("doc_id").select(
        "x", "quality").toArrow()
    x = np.array(rows.column("x").to_pylist(), np.float64).reshape(-1, len(STATISTICS))
    return grow(x, (np.array(rows.column("quality").to_pylist(), np.int64) == 1).astype(np.float64))


def judge(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``, repeated
    rows and empty texts too. Without labels every score is one half."""
    model = fit(docs, labels, **options)

    def each(batches):
        for batch in batches:
            x = np.array(batch.column("x").to_pylist(), np.float64).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x), pa.float64())],
                                             ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return measured(docs).mapInArrow(each, f"doc_id {kind}, score double").select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= CUTOFF).cast("int").alias("predicted"))


def op9_quality_model(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
