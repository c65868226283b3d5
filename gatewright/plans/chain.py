"""Several policies in the order given, and reports over their outcomes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewright import outcome as oc
from gatewright.config import Policy
from gatewright.operators.apply import attach, evaluate
from gatewright.operators.stage import Inputs, Stage
from gatewright.session import configure

Step = Policy | tuple[Policy, str | None] | tuple[Policy, str | None, Inputs]


def run_chain(
    messages: DataFrame,
    steps: Sequence[Step],
    inputs: Inputs | None = None,
    *,
    detailed: bool = True,
) -> DataFrame:
    """Messages with ``outcome``, ``halted_by`` and ``payload_out``.

    Policies run in the order given. A message stops at its first violation;
    policies behind a rewriting one see the changed payload. Everything is one
    narrow pass unless a step has to join a side table. A step may bring its own
    side inputs; the others use ``inputs``. A step that asks a function starts
    from messages written by then, so that the plan grows by one join for it.
    """
    configure(messages.sparkSession)
    inputs = inputs or Inputs()
    stage = Stage(messages, detailed=detailed)
    state = stage.named(F.struct(oc.passed().alias("outcome"), F.lit("").alias("by")))
    payload = stage.payload
    mapping = inputs.mapping if inputs.mapping in messages.columns else None
    for step in steps:
        policy, flow, own = (*step, None)[:3] if isinstance(step, tuple) else (step, None, None)
        attached = attach(stage, policy, flow)
        going = F.col(state)["outcome"]["passed"]
        active = going if attached is None else going & attached
        stage.active, stage.payload = active, payload
        stage.live = (state, payload, *([mapping] if mapping else []))
        verdict = evaluate(stage, policy, own or inputs)
        decided = F.struct(verdict.outcome.alias("outcome"), F.lit(policy.name).alias("by"))
        if verdict.payload is not None:
            # A failed step leaves the payload as it was.
            payload = stage.reserve()
            stage.df = stage.df.withColumn(
                payload, F.when(active, verdict.payload).otherwise(stage.text)
            )
        state = stage.named(F.when(active, decided).otherwise(F.col(state)))
        if verdict.mapping is not None:
            new = F.when(active, verdict.mapping)
            mapping = stage.named(new if mapping is None else F.coalesce(new, F.col(mapping)))
    outcome = F.col(state)["outcome"]
    sealed = {"outcome": outcome, "halted_by": F.when(~outcome["passed"], F.col(state)["by"])}
    if mapping is not None:
        sealed[inputs.mapping] = stage.keep(F.col(mapping))
    stage.seal(**sealed)
    stage.df = stage.df.withColumn("payload_out", F.col(payload))
    return stage.result()


def policy_report(checked: DataFrame, *by: str) -> DataFrame:
    """Messages per outcome: flow, policy, fault type and code.

    A plain grouped count: it combines before the shuffle, which then moves one
    row per group and task.
    """
    return (
        checked.groupBy(
            "direction",
            *by,
            F.col("outcome.error_type").alias("error_type"),
            F.col("outcome.error_code").alias("error_code"),
        )
        .agg(
            F.count("*").alias("messages"),
            F.sum(F.octet_length("payload")).alias("payload_bytes"),
        )
    )
