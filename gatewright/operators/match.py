"""Regular expression and JSON Schema checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from gatewright.config import JsonSchema, RegexMatch
from gatewright.functions import patterns
from gatewright.functions.jsonpath import document
from gatewright.functions.jsonschema import SchemaCheck
from gatewright.functions.unescape import unescape_java
from gatewright.operators.stage import Inputs, Stage, Verdict


def check_regex(stage: Stage, policy: RegexMatch, inputs: Inputs) -> Verdict:
    patterns.check_regex(stage.df.sparkSession, policy.regex)
    content = stage.content(policy.json_path, cleaned=True)
    found = stage.keep(
        stage.gate(
            F.when(stage.empty, False).otherwise(patterns.regex_find(content, policy.regex))
        )
    )
    details = F.lit(f"Violated regular expression: {policy.regex}")
    return Verdict(
        stage.decide(
            policy,
            ~found if policy.invert else found,
            details if policy.show_assessment else None,
        )
    )


def schema_match(content, schema: str):
    """True when at least one ``{...}`` piece of ``content`` is valid."""
    check = SchemaCheck(schema)
    parsed = F.transform(
        patterns.json_candidates(content), lambda piece: document(unescape_java(piece))
    )
    return F.when(content.contains("{"), F.exists(parsed, check.valid)).otherwise(
        content.isNull() & F.lit(None).cast("boolean")
    )


def check_schema(stage: Stage, policy: JsonSchema, inputs: Inputs) -> Verdict:
    """A blank payload passes, inverted or not."""
    content = stage.content(policy.json_path, cleaned=False)
    valid = stage.keep(stage.gate(schema_match(content, policy.schema)))
    blank = stage.text.isNull() | ~stage.text.rlike(r"\P{javaWhitespace}")
    passed = F.when(blank, True).otherwise(~valid if policy.invert else valid)
    details = F.concat(
        F.lit("The inspected response payload content: "),
        content,
        F.lit(f" does not satisfy the JSON schema: {policy.schema}"),
    )
    return Verdict(
        stage.decide(policy, passed, details if policy.show_assessment else None)
    )
