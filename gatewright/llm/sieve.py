"""A bounded set of keys that rules rows out before they move.

Where a few keys meet a large table, a shuffle moves the whole table to find
that most of it meets nothing. A bitmap of the keys, at most ``MOST_BITS``, goes
to the tasks instead and rules out most of the other rows where they are read.
It never rules out a row whose key is there, and lets some others by; the join
behind it stays exact.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewright.llm.common import ship
from gatewright.session import work_settings

ship(__name__)

# Bits for each key, a power of two in all; fuller ones let more rows by and lose nothing.
KEY_BITS, LEAST_BITS, MOST_BITS = 16, 1 << 10, 1 << 25


def sieve(keys: DataFrame, key: Column) -> np.ndarray:
    """The bitmap of ``key``, a long with well mixed lower bits, over the rows of
    ``keys``: at most ``MOST_BITS`` come to the driver, however many keys there are."""
    total, bits = keys.count(), LEAST_BITS
    while bits < MOST_BITS and bits < KEY_BITS * total:
        bits *= 2
    slots = keys.select(key.bitwiseAND(F.lit(bits - 1)).alias("slot"))
    slots = slots.groupBy(F.expr("slot div 64").alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(slot % 64 as int))")).alias("word"))
    with work_settings(keys.sparkSession):
        rows = slots.toArrow()
    words = np.zeros(bits // 64, np.int64)
    words[rows.column("at").to_numpy()] = rows.column("word").to_numpy()
    return words


def may_hold(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """False only for keys that are not there."""
    slots = keys & (64 * len(words) - 1)
    return (words[slots >> 6] >> (slots & 63)) & 1 == 1


def sieved(rows: DataFrame, words: np.ndarray, key: Column, out: bool = False) -> DataFrame:
    """``rows`` without those that the bitmap rules out; with ``out`` only these."""

    @F.pandas_udf("boolean")
    def by(keys: pd.Series) -> pd.Series:
        return pd.Series(may_hold(words, keys.to_numpy()) != out)

    return rows.where(by(key))
