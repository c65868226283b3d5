"""Applying one policy to a table or stream of messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewright import config
from gatewright import outcome as oc
from gatewright.operators.counts import check_count
from gatewright.operators.match import check_regex, check_schema
from gatewright.operators.pii import transform_pii
from gatewright.operators.rewrite import decorate, expand_templates
from gatewright.operators.scored import follow_verdict, moderate
from gatewright.operators.semantic import check_semantics
from gatewright.operators.stage import Inputs, Operator, Stage, Verdict
from gatewright.operators.urls import check_urls
from gatewright.session import configure

OPERATORS: dict[type, Operator] = {
    config.WordCount: check_count,
    config.SentenceCount: check_count,
    config.ContentLength: check_count,
    config.RegexMatch: check_regex,
    config.JsonSchema: check_schema,
    config.UrlCheck: check_urls,
    config.SemanticGuard: check_semantics,
    config.PiiRegex: transform_pii,
    config.TemplateExpansion: expand_templates,
    config.Decoration: decorate,
    config.Moderation: moderate,
    config.BedrockVerdict: follow_verdict,
}


def attach(stage: Stage, policy: config.Policy, flow: str | None) -> Column | None:
    """Messages of the flows a policy is attached to; None means all of them."""
    flows = policy.flows if flow is None else (flow,)
    if not set(flows) <= set(policy.flows):
        raise ValueError(f"{policy.label or policy.error_type} cannot be attached to {flow}")
    stage.flow = flows[0] if len(flows) == 1 else None
    if stage.flow is None:
        return None
    response = F.coalesce(stage.way == "RESPONSE", F.lit(False))
    return response if stage.flow == "RESPONSE" else ~response


def evaluate(stage: Stage, policy: config.Policy, inputs: Inputs) -> Verdict:
    return OPERATORS[type(policy)](stage, policy, inputs)


def apply(
    messages: DataFrame,
    policy: config.Policy,
    inputs: Inputs | None = None,
    *,
    flow: str | None = None,
    detailed: bool = True,
) -> DataFrame:
    """Messages with ``outcome``, and ``payload_out`` for a policy that rewrites.

    A masking policy adds ``mapping``. ``flow`` attaches the policy to requests
    or responses only; the others pass as they are. Without ``detailed`` the
    error message is the short one used where no fault sequence is deployed.
    """
    configure(messages.sparkSession)
    inputs = inputs or Inputs()
    stage = Stage(messages, detailed=detailed)
    stage.active = attach(stage, policy, flow)
    verdict = evaluate(stage, policy, inputs)
    outcome, payload, mapping = verdict
    if stage.active is not None:
        outcome = F.when(stage.active, outcome).otherwise(oc.passed())
        if payload is not None:
            payload = F.when(stage.active, payload).otherwise(stage.text)
    sealed = {"outcome": outcome}
    if mapping is not None:
        if inputs.mapping in messages.columns:
            mapping = F.coalesce(mapping, F.col(inputs.mapping))
        sealed[inputs.mapping] = stage.keep(mapping)
    if payload is not None and inputs.mapping in messages.columns:
        payload = stage.keep(payload)  # it may read the mapping that came in
    stage.seal(**sealed)
    if payload is not None:
        stage.df = stage.df.withColumn("payload_out", payload)
    return stage.result()
