"""Masking, restoring and redacting personal data by regular expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gatewright import outcome as oc
from gatewright.config import PiiRegex
from gatewright.functions import patterns
from gatewright.operators.stage import Inputs, Stage, Verdict


def mask_steps(stage: Stage, text: Column, rules) -> tuple[Column, Column]:
    """Masked text and mapping, one projection per step of each rule.

    A later rule sees the placeholders of earlier ones. The text is rebuilt
    only where the rule found something.
    """
    mapping = stage.keep(patterns.empty_mapping())
    for entity, pattern in rules:
        matches = stage.keep(patterns.find_all(text, pattern))
        mapping = stage.keep(
            F.when(F.size(matches) == 0, mapping).otherwise(
                F.concat(mapping, patterns.new_entries(matches, mapping, entity))
            )
        )
        text = stage.keep(patterns.put_placeholders(text, pattern, matches, mapping))
    return text, mapping


def transform_pii(stage: Stage, policy: PiiRegex, inputs: Inputs) -> Verdict:
    """Redact in both flows, or mask requests and restore responses."""
    for _, pattern in policy.pii_entities:
        patterns.check_regex(stage.df.sparkSession, pattern, consuming=not policy.redact)
    content = stage.content(policy.json_path, cleaned=True)
    mapping = None
    if policy.redact:
        changed = stage.keep(stage.gate(content))
        for _, pattern in policy.pii_entities:
            changed = stage.keep(patterns.redact_rule(changed, pattern))
        hit = changed != content
    else:
        response = F.coalesce(stage.way == "RESPONSE", F.lit(False))
        changed, hit = content, F.lit(False)
        if stage.flow != "RESPONSE":
            request = stage.keep(stage.gate(F.when(~response, content)))
            changed, mapping = mask_steps(stage, request, policy.pii_entities)
            hit = F.size(mapping) > 0
            mapping = F.when(hit, mapping)
        if stage.flow != "REQUEST" and inputs.mapping in stage.df.columns:
            stored = F.col(inputs.mapping)
            back = stage.keep(stage.gate(F.when(response, patterns.restore(content, stored))))
            changed = F.when(response, back).otherwise(changed)
            hit = F.when(response, F.size(stored) > 0).otherwise(hit)
    # An empty result counts as "nothing to do".
    hit = F.coalesce(hit & (changed != ""), F.lit(False))
    failed = ~stage.empty & content.isNull()
    payload = F.when(hit, stage.with_text(policy.json_path, changed)).otherwise(stage.text)
    outcome = F.when(failed, oc.internal_error(policy)).otherwise(oc.passed())
    return Verdict(outcome, payload, mapping)
