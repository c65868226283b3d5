"""From raw documents to packed training sequences, in five stages.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one
before it kept; what it returns is written as Parquet and read again.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gatewright.llm import decontaminate, near_copies, packing, quality_rules, suffix_array
from gatewright.llm.common import table
from gatewright.session import release, stored, work_scope

PASSAGE_WORDS = 50

# Work folders of the stage that ran last.
_left: list[str] = []


def freeing(stage: Callable) -> Callable:
    """A stage that frees what the one before it left.

    A stage's rows are written and read again before the next one starts, so
    that nothing needs its intermediate tables any more by then.
    """

    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _left)
        with work_scope() as made:
            out = stage(spark, docs, sf_dir)
        _left[:] = made
        return out

    return run_stage


@freeing
def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; null and empty texts have no words and are among them.

    Repeated rows stay or go together; without labels the base filter judges alone.
    """
    return quality_rules.filter_documents(docs, table(spark, sf_dir, "labels"))


@freeing
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with similar five-word shingles stays: a row
    with an id before those without, then the smallest id. Of repeated rows one stays.

    SimHash finds texts a few bits apart, which are verified; prefixes find the others."""
    return near_copies.keep_one(docs)


@freeing
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words, and strings of 400 bytes, that repeat anywhere in the corpus are cut out.

    All rows stay; null texts stay null, and texts that are cut whole are empty.
    """
    return suffix_array.remove(docs, words=PASSAGE_WORDS)


@freeing
def decontaminate_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items are cut out. All rows stay; null texts stay
    null, repeated rows are cut alike, and without items nothing changes."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


@freeing
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document gets its place in the training sequences.

    Texts that earlier stages emptied hold nothing to train on, only an end
    mark, and get none; null texts neither.
    """
    return packing.pack(docs.where("text <> ''"))


STAGES = [
    ("quality rules", reject_low_quality),
    ("near-duplicates", drop_near_duplicates),
    ("repeated strings", cut_repeats),
    ("benchmark passages", decontaminate_benchmarks),
    ("packing", pack_sequences),
]

# Hashes, suffix orders and the tokenizer have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``; further columns come along, an empty table gives no rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
