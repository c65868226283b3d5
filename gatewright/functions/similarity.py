"""Vector similarity between message embeddings and a set of rules."""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def l2_norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x))


def cosine(left: Column, right: Column) -> Column:
    """Cosine similarity; 0.0 when either norm is zero."""
    left, right = left.cast("array<double>"), right.cast("array<double>")
    norms = l2_norm(left) * l2_norm(right)
    return F.when(norms == 0.0, F.lit(0.0)).otherwise(dot(left, right) / norms)


# The functions below travel to the workers by value, so that no package has to
# be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Most numbers that rules may have in all: 128 MiB that travel with the function.
MOST_RULE_NUMBERS = 1 << 24

# Scores this close to a threshold are computed again, term by term.
NEAR = 1e-6


def _unit_rows(matrix: np.ndarray) -> np.ndarray:
    norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))
    return np.divide(matrix, norms[:, None], out=np.zeros_like(matrix), where=norms[:, None] != 0)


def _in_order(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Row-wise dot products, summed from the first term to the last."""
    return np.add.accumulate(left * right, axis=1)[:, -1]


def _exact_cosine(vectors: np.ndarray, rules: np.ndarray) -> np.ndarray:
    norms = np.sqrt(_in_order(vectors, vectors)) * np.sqrt(_in_order(rules, rules))
    found = np.zeros(len(vectors))
    return np.divide(_in_order(rules, vectors), norms, out=found, where=norms != 0.0)


def _whole(batch: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of this length without gaps, and which rows they are."""
    lengths = batch.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    whole = lengths == width
    picked = batch if whole.all() else batch.filter(pa.array(whole))
    flat = picked.flatten()
    if flat.null_count:
        gap = flat.is_null().to_numpy(zero_copy_only=False).reshape(-1, width).any(axis=1)
        whole[np.flatnonzero(whole)[gap]] = False
        flat = flat.filter(pa.array(np.repeat(~gap, width)))
    vectors = flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return vectors.reshape(-1, width), np.flatnonzero(whole)


# Rules and messages of one matrix product.
_RULES, _MESSAGES = 4096, 256


def _first_rules(vectors: np.ndarray, rules: np.ndarray, threshold: float) -> np.ndarray:
    """For each vector the place of the first rule whose score reaches ``threshold``
    (in percent), -1 if none does.

    Products are taken in blocks of rules and messages; a message that has its
    rule takes no part in later ones. Scores next to the threshold come out as
    those of a simple loop.
    """
    unit = _unit_rows(vectors)
    hit = np.full(len(vectors), -1)
    for at in range(0, len(rules), _RULES):
        part = rules[at:at + _RULES]
        unit_part = _unit_rows(part).T
        pending = np.flatnonzero(hit < 0)
        for some in np.split(pending, range(_MESSAGES, len(pending), _MESSAGES)):
            found = unit[some] @ unit_part
            row, rule = np.nonzero(np.abs(found * 100 - threshold) < NEAR)
            found[row, rule] = _exact_cosine(vectors[some[row]], part[rule])
            reached = found * 100 >= threshold
            any_reached = reached.any(axis=1)
            hit[some[any_reached]] = at + reached.argmax(axis=1)[any_reached]
    return hit


def first_reached(vector: Column, numbers: np.ndarray, rules: np.ndarray, threshold: float) -> Column:
    """Number of the first rule whose score reaches ``threshold`` (in percent);
    NULL if none does, or the vector is missing or of another length."""
    rules = np.ascontiguousarray(rules, dtype=np.float64)

    @F.arrow_udf("long")
    def first(batch: pa.Array) -> pa.Array:
        vectors, rows = _whole(batch, rules.shape[1])
        hit = np.full(len(batch), -1)
        hit[rows] = _first_rules(vectors, rules, threshold)
        out = np.append(numbers, 0)[hit]
        return pa.array(out, pa.int64(), mask=hit < 0)

    return first(vector)


# Numbers in a block of vectors that meets other blocks: 64 KiB.
_NUMBERS = 1 << 13


def vector_blocks(rows: DataFrame, key: str, vector: str, width: int) -> DataFrame:
    """``first, keys, vectors``: the whole vectors of this length in blocks, in the
    order of their rows; the first key of each, and keys and numbers as bytes."""
    most = max(1, _NUMBERS // width)

    def each(batches):
        for batch in batches:
            vectors, at = _whole(batch.column(1), width)
            keys = batch.column(0).to_numpy(zero_copy_only=False)[at]
            cuts = range(0, len(keys), most)
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(keys[a]) for a in cuts], pa.int64()),
                 pa.array([keys[a:a + most].tobytes() for a in cuts], pa.binary()),
                 pa.array([vectors[a:a + most].tobytes() for a in cuts], pa.binary())], ["first", "keys", "vectors"])

    return rows.select(F.col(key).cast("long"), vector).mapInArrow(each, "first long, keys binary, vectors binary")


def first_in_blocks(messages: DataFrame, rules: DataFrame, width: int, threshold: float) -> DataFrame:
    """``key, rule`` of the messages that reach a rule: the smallest such rule's key.

    Both sides are ``vector_blocks``; every block of one meets every block of
    the other in some task, and only keys go on.
    """
    def each(batches):
        for batch in batches:
            found, hits = [], []
            for keys, vectors, numbers, table in zip(*(batch.column(i).to_pylist() for i in range(4))):
                hit = _first_rules(np.frombuffer(vectors).reshape(-1, width),
                                   np.frombuffer(table).reshape(-1, width), threshold)
                found.append(np.frombuffer(keys, np.int64)[hit >= 0])
                hits.append(np.frombuffer(numbers, np.int64)[hit[hit >= 0]])
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found)), pa.array(np.concatenate(hits))],
                                                 ["key", "rule"])

    pairs = messages.select("keys", "vectors").crossJoin(
        rules.select(F.col("keys").alias("numbers"), F.col("vectors").alias("rules")))
    return pairs.mapInArrow(each, "key long, rule long").groupBy("key").agg(F.min("rule").alias("rule"))


def cosine_to_rules(
    vector: Column, rules: Sequence[Sequence[float]], threshold: float | None = None
) -> Column:
    """Scores of one embedding against every rule, in rule order.

    One matrix product per Arrow batch over the flat value buffer. A matrix
    product adds in its own order, so scores next to ``threshold`` (in percent)
    are computed again in plain order: the comparison then comes out as that of
    a simple loop. NULL for a missing vector or one of another length.
    """
    table = np.asarray(rules, dtype=np.float64)
    if table.ndim != 2 or table.shape[0] == 0:
        raise ValueError("rules must be a non-empty list of equally long vectors")
    count, width = table.shape
    if table.size > MOST_RULE_NUMBERS:
        raise ValueError(
            f"{count} rules of {width} numbers are more than travel with a function "
            f"({MOST_RULE_NUMBERS} numbers): give the rules as a table"
        )
    unit_rules = _unit_rows(table)

    @F.arrow_udf("array<double>")
    def scores(batch: pa.Array) -> pa.Array:
        vectors, rows = _whole(batch, width)
        found = _unit_rows(vectors) @ unit_rules.T
        if threshold is not None:
            row, rule = np.nonzero(np.abs(found * 100 - threshold) < NEAR)
            found[row, rule] = _exact_cosine(vectors[row], table[rule])
        valid = np.zeros(len(batch), dtype=bool)
        valid[rows] = True
        offsets = np.concatenate(([0], np.cumsum(np.where(valid, count, 0)))).astype(np.int32)
        return pa.ListArray.from_arrays(
            pa.array(offsets), pa.array(found.reshape(-1)), mask=pa.array(~valid)
        )

    return scores(vector)
