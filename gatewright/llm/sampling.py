"""Bounded samples of rows by id, for fitting models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as an empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(folds))


def sampled(ids: DataFrame, most: int) -> DataFrame:
    """At most ``most`` distinct rows of ``ids(doc_id, ...)``: those whose ids
    have the smallest hashes, so that the choice doesn't depend on partitions."""
    return ids.distinct().orderBy(F.xxhash64(F.col("doc_id"), F.lit(7)), "doc_id").limit(most)


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``ids`` with the texts of ``docs``. The ids come from ``sampled``, which
    bounds them, so they are broadcast and no text is shuffled."""
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    return rows.join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"])
