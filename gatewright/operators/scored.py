"""Policies that follow the answer of an outside scorer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gatewright import outcome as oc
from gatewright.config import BedrockVerdict, Moderation
from gatewright.functions import patterns, scorers
from gatewright.operators.stage import Inputs, Stage, Verdict
from gatewright.session import stored


def _response(stage: Stage, inputs: Inputs) -> Column:
    """Answer of the scorer; NULL stands for an unreachable one.

    A response table is joined on the message keys (and the direction, if it
    has one). Spark picks the strategy by size. Of several answers to one
    message the smallest text counts; any answer comes before none. A function
    is asked about messages that are written first, and its answers are written
    too: one run of what comes before, and one call for each message.
    """
    if inputs.responses is None:
        return F.col(inputs.response)
    responses, asking = inputs.responses, callable(inputs.responses)
    if asking:
        stage.cut()
        asked = stage.df if stage.active is None else stage.df.where(stage.active)
        columns = dict.fromkeys((*inputs.keys, stage.direction))
        responses = responses(asked.select(*columns, stage.text.alias("payload")))
    keys = list(inputs.keys)
    if stage.direction in responses.columns and stage.direction not in keys:
        keys.append(stage.direction)
    name = stage.reserve()
    answers = responses.groupBy(*keys).agg(F.min(inputs.response).alias(name))
    if asking:
        answers = stored(answers, "answers")
    stage.df = stage.df.join(answers, keys, "left")
    return F.col(name)


def moderate(stage: Stage, policy: Moderation, inputs: Inputs) -> Verdict:
    if not any(0 <= level <= 7 for level in policy.thresholds.values()):
        # Nothing to ask for is an error even with pass-through.
        empty = oc.violation(policy, F.lit(None), stage.detailed)
        return Verdict(F.when(stage.empty, empty).otherwise(oc.internal_error(policy)))
    # Joined first, so that no extracted text travels along.
    response = _response(stage, inputs)
    content = stage.content(policy.json_path, cleaned=True)
    answer = stage.keep(stage.gate(F.try_parse_json(response)))
    found = stage.keep(scorers.analysis(answer))
    # An empty answer holds no category and so finds nothing.
    unreachable = response.isNull() | ((response != "") & answer.isNull())
    finding = stage.keep(
        F.when(
            found.isNotNull(), scorers.moderation_finding(found, policy.thresholds)
        ).otherwise("pass")
    )
    details = failure = None
    if policy.show_assessment:
        details = F.struct(
            content.alias("inspectedContent"),
            scorers.moderation_rows(found, policy.thresholds).alias("categories"),
        )
        failure = F.lit(
            "Azure Content Safety API is unreachable or returned an invalid response."
        )

    def blocked(message: Column) -> Column:
        return oc.violation(policy, message, stage.detailed)

    if policy.passthrough_on_error:
        unreached = oc.passed()
    else:
        unreached = blocked(oc.assessment(policy, stage.way, failure))
    outcome = (
        F.when(stage.empty, blocked(F.lit(None)))
        .when(content.isNull(), oc.internal_error(policy))
        .when(unreachable, unreached)
        .when(finding == "error", oc.internal_error(policy))
        .when(finding == "block", blocked(oc.assessment(policy, stage.way, details)))
        .otherwise(oc.passed())
    )
    return Verdict(outcome)


def follow_verdict(stage: Stage, policy: BedrockVerdict, inputs: Inputs) -> Verdict:
    """Block, mask or redact as the scorer says; restore responses."""
    response = _response(stage, inputs)
    content = stage.content(policy.json_path, cleaned=True)
    answer = stage.keep(stage.gate(F.try_parse_json(response)))
    action = F.try_variant_get(answer, "$.action", "string")
    reason = F.try_variant_get(answer, "$.actionReason", "string")
    intervened = action == scorers.INTERVENED
    blocked = intervened & (reason == scorers.BLOCKED)
    changed = intervened & (reason == scorers.MASKED)

    restoring = (
        F.lit(False) if policy.redact_pii else F.coalesce(stage.way == "RESPONSE", F.lit(False))
    )
    missing = F.lit("AWS Bedrock Guardrails API is unreachable or returned an invalid response.")
    first = scorers.first_assessment(answer) if policy.show_assessment else None

    def violation(details: Column | None) -> Column:
        return oc.violation(policy, oc.assessment(policy, stage.way, details), stage.detailed)

    unreached = oc.passed() if policy.passthrough_on_error else violation(
        missing if policy.show_assessment else None
    )
    error = oc.internal_error(policy, oc.HTTP_STATUS)
    unexpected = oc.passed() if policy.passthrough_on_error else error
    # A path that leads nowhere is an error that pass-through does not cover.
    nowhere = content.isNull() & F.lit(bool(policy.json_path.strip()))
    outcome = (
        F.when(restoring, oc.passed())
        .when(nowhere, error)
        .when(response.isNull() | (response == ""), unreached)
        .when(blocked, violation(first))
        .when(changed | (action == scorers.NOT_INTERVENED), oc.passed())
        .otherwise(unexpected)
    )

    text = stage.text
    mapping = None
    if policy.redact_pii:
        output = stage.keep(F.when(changed, scorers.redacted_text(answer)))
        payload = F.when(
            output.isNotNull() & ~nowhere, stage.with_text(policy.json_path, output)
        ).otherwise(text)
    else:
        masking = F.coalesce(changed & ~restoring & ~nowhere, F.lit(False))
        found = stage.keep(F.when(masking, scorers.anonymized(answer)))
        masked, entries = patterns.mask_found(content, found)
        masked = stage.keep(masked)
        mapping = stage.keep(entries)
        payload = F.when(
            F.size(mapping) > 0, stage.with_text(policy.json_path, masked)
        ).otherwise(text)
        if inputs.mapping in stage.df.columns:
            carried = F.col(inputs.mapping)
            payload = F.when(
                restoring & (F.size(carried) > 0), patterns.restore(text, carried)
            ).otherwise(payload)
        mapping = F.when(F.size(mapping) > 0, mapping)
    return Verdict(outcome, payload, mapping)
