"""Toxicity from confirmed examples and unlabelled text.

Only toxic documents are confirmed; any other document may or may not be toxic.
A linear model over words and word beginnings is trained on the non-negative
estimate of the classification risk from positive and unlabelled examples: with
the class prior p, the risk of negatives is that of all text less p times that
of the positives. An estimate below zero can only come from overfitting; the
step then goes the other way for that part.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewright.llm.common import ship
from gatewright.llm.sampling import fold, sampled, texts_of

ship(__name__)

# The fold that is held out, and bounds of the training samples.
FOLDS, HELD_OUT = 3, 1
MOST_POSITIVE = 4_000
MOST_UNLABELLED = 8_000
CUTOFF = 0.7
SLOTS = 1 << 20
BEGINNINGS = (4, 5, 6)
# A feature has to be in so many positives; so large a share of the texts that
# have it has to be toxic by the estimate; and it has to be in so many standard
# deviations more positives than chance would put it.
LEAST_POSITIVE = 3
LEAST_SHARE = 0.4
LEAST_SURPRISE = 6.0

_words = re.compile(r"\w+").findall


def word_slots(word: str) -> list[int]:
    """Slots of the word and of its beginnings."""
    out = [zlib.crc32(word.encode("utf-8", "surrogatepass")) % SLOTS]
    for n in BEGINNINGS:
        if len(word) >= n:
            out.append(zlib.crc32(b"^" + word[:n].encode("utf-8", "surrogatepass"), n) % SLOTS)
    return out


def text_slots(text: str | None) -> np.ndarray:
    """Slots of the distinct words of a text; a slot comes once for each word that has it."""
    slots: list[int] = []
    for word in set(_words((text or "").lower())):
        slots.extend(word_slots(word))
    return np.array(sorted(slots), np.int32)


def slot_rows(texts: DataFrame) -> DataFrame:
    def each(batches):
        for batch in batches:
            slots = [text_slots(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("positive"), pa.array(slots, pa.list_(pa.int32()))], ["positive", "slots"])

    return texts.select("text", "positive").mapInArrow(each, "positive boolean, slots array<int>")


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, *, steps: int = 400,
          rate: float = 0.1, sparsity: float = 1e-4) -> tuple[dict[int, float], float]:
    """``(weights, bias)`` of the linear model; no positives give no weights.

    Features are those that are far more common in positives than in all text;
    their weights are not negative and drawn towards zero, so that a long text
    doesn't add up the noise of its many words. Steps are Adam's, on all rows.
    """
    if not positive or not unlabelled:
        return {}, -20.0
    prior = min(max(prior, 1e-4), 0.9)
    n_p, n_u = len(positive), len(unlabelled)

    def spread(rows):
        return np.bincount(np.concatenate([*map(np.unique, rows), []]).astype(np.int64), minlength=SLOTS)

    in_p, in_u = spread(positive), spread(unlabelled)
    share = prior * (in_p / n_p) / ((in_u + 1) / (n_u + 1))
    expected = in_u * (n_p / n_u)
    surprise = (in_p - expected) / np.sqrt(expected + 1)
    chosen = np.flatnonzero((in_p >= LEAST_POSITIVE) & (share >= LEAST_SHARE) & (surprise >= LEAST_SURPRISE))
    number = np.full(SLOTS, -1)
    number[chosen] = np.arange(len(chosen))

    def matrix(rows):
        """Row and feature of every chosen slot."""
        flat = number[np.concatenate([*rows, []]).astype(np.int64)]
        row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        return row[flat >= 0], flat[flat >= 0]

    (row_p, at_p), (row_u, at_u) = matrix(positive), matrix(unlabelled)
    w, bias = np.zeros(len(chosen)), float(np.log(prior / (1 - prior)))
    mean, square = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for step in range(1, steps + 1):
        z_p = np.bincount(row_p, weights=w[at_p], minlength=n_p) + bias
        z_u = np.bincount(row_u, weights=w[at_u], minlength=n_u) + bias
        pull_p, pull_u = prior * _sigmoid(z_p) / n_p, _sigmoid(z_u) / n_u
        negatives = np.logaddexp(0, z_u).mean() - prior * np.logaddexp(0, z_p).mean()
        if negatives >= 0:  # positives as such, all text as negatives, less the positives in it
            g_p, g_u = prior * (_sigmoid(z_p) - 1) / n_p - pull_p, pull_u
        else:
            g_p, g_u = pull_p, -pull_u
        grad = np.append(np.bincount(at_p, weights=g_p[row_p], minlength=len(w))
                         + np.bincount(at_u, weights=g_u[row_u], minlength=len(w)), g_p.sum() + g_u.sum())
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad ** 2
        move = rate * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.999 ** step)) + 1e-6)
        w = np.maximum(w - move[:-1] - rate * sparsity, 0)
        bias -= move[-1]
    return {int(s): float(x) for s, x in zip(chosen, w) if x}, float(bias)


def fit(docs: DataFrame, labels: DataFrame, *, most_positive: int = MOST_POSITIVE,
        most_unlabelled: int = MOST_UNLABELLED) -> tuple[dict[int, float], float]:
    """The model from the rows outside the held-out fold. Null labels are left
    out, an id is toxic if any of its labels is. The prior is the toxic share of
    all labelled ids."""
    known = labels.where((fold(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("toxic").isNotNull()).groupBy(
        "doc_id").agg(F.max("toxic").alias("toxic"))
    prior = known.agg(F.avg((F.col("toxic") == 1).cast("double")).alias("p")).first()["p"]
    positive = sampled(known.where("toxic = 1").select("doc_id"), most_positive).withColumn("positive", F.lit(True))
    others = docs.where(F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT)).select("doc_id")
    unlabelled = sampled(others, most_unlabelled).withColumn("positive", F.lit(False))
    # an id may be in both samples: all text includes the positives
    rows = []
    for ids in (positive, unlabelled):
        slots = slot_rows(texts_of(docs, ids)).toArrow().column("slots").combine_chunks()
        ends = slots.offsets.to_numpy()[1:-1]
        rows.append(np.split(slots.values.to_numpy(), ends) if len(slots) else [])
    return train(*rows, prior or 0.0)


def score(docs: DataFrame, model: tuple[dict[int, float], float]) -> DataFrame:
    """``doc_id, score`` of every row, from its whole text. Texts without words,
    null ones too, have the model's bias alone."""
    weights, bias = model
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def each(batches):
        known: dict[str, float] = {}

        def of(word):
            if word not in known:
                if len(known) > 500_000:
                    known.clear()
                known[word] = sum(weights.get(s, 0.0) for s in word_slots(word))
            return known[word]

        for batch in batches:
            z = np.array([bias + sum(map(of, set(_words((t or "").lower()))))
                          for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_sigmoid(z), pa.float64())],
                                             ["doc_id", "score"])

    return rows.mapInArrow(each, f"doc_id {kind}, score double")


def judge(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``, repeated
    rows too. Without toxic labels every score is near 0."""
    return score(docs, fit(docs, labels, **options)).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= CUTOFF).cast("int").alias("predicted"))


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
