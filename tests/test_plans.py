"""Shapes of the physical plans that matter at scale."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import gatewright as g
from gatewright.plans.queries import CHAIN
from gatewright.sources.messages import conversation_messages

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in entry.QUERIES if not n.startswith("stream_")])
def test_no_pairs_and_no_row_functions(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert node not in text


def test_a_chain_is_one_narrow_pass(spark):
    messages = conversation_messages(spark.read.parquet(f"{FOLDER}/conversations.parquet"))
    text = plan(g.run_chain(messages, CHAIN))
    assert "Exchange" not in text and "Sort" not in text
    # One parse for each version of the payload: before and after the decoration.
    assert text.count("from_json(VariantType") == 2


def test_only_needed_columns_are_read(spark):
    text = plan(entry.queries()["word_count"](spark, FOLDER))
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_filters_on_given_columns_reach_the_scan(spark):
    messages = conversation_messages(spark.read.parquet(f"{FOLDER}/conversations.parquet"))
    text = plan(g.run_chain(messages, CHAIN).where((F.col("conv_id") == 3) & ~F.col("outcome.passed")))
    assert "PushedFilters: [IsNotNull(conv_id), EqualTo(conv_id,3)]" in text


def test_reports_combine_before_the_shuffle(spark):
    text = plan(entry.queries()["policy_report"](spark, FOLDER))
    assert "partial_count" in text and text.count("Exchange hashpartitioning") == 1


def test_joins_without_a_size_bound_are_sorted_and_merged(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for name in ("moderation_verdict", "bedrock_mask", "pii_restore"):
            text = plan(entry.queries()[name](spark, FOLDER))
            assert "SortMergeJoin" in text and "Broadcast" not in text
            # Texts are extracted after the join: only payloads travel.
            assert text.index("from_json") < text.index("SortMergeJoin")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


NARROW = ("word_count", "sentence_count", "content_length", "regex_find", "pii_mask", "pii_redact", "guard_word_count",
          "guard_regex", "policy_chain", "payload_build", "json_candidates", "prompt_decorate_string")


@pytest.mark.parametrize("name", NARROW)
def test_narrow_queries_move_no_rows(spark, name):
    text = plan(entry.QUERIES[name](spark, "/root/testdata/sf0.1"))
    assert "Exchange" not in text and "n_chars" not in text
