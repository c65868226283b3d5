"""Outcome of a policy for one message, and the assessment text it carries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewright.config import Policy

# Fixed codes and texts of the reference behaviour.
VIOLATION = 900514
INTERNAL_ERROR = 900967
HTTP_STATUS = 446
ACTION = "GUARDRAIL_INTERVENED"
REASONS = {
    "WORD_COUNT_GUARDRAIL": "Violation of applied word count constraints detected.",
    "SENTENCE_COUNT_GUARDRAIL": "Violation of applied sentence count constraints detected.",
    "CONTENT_LENGTH_GUARDRAIL": "Violation of applied content length constraints detected.",
    "REGEX_GUARDRAIL": "Violation of regular expression detected.",
    "JSON_SCHEMA_GUARDRAIL": "Violation of enforced JSON schema detected.",
    "URL_GUARDRAIL": "Violation of url validity detected.",
    "SEMANTIC_PROMPT_GUARD": "Violation of guard prompts detected.",
    "AZURE_CONTENT_SAFETY_CONTENT_MODERATION":
        "Violation of azure content safety content moderation detected.",
    "AWS_BEDROCK_GUARDRAIL": "Violation of AWS Bedrock Guardrails detected.",
}

OUTCOME = (
    "struct<passed:boolean,error_code:int,error_type:string,http_sc:int,error_message:string>"
)


def _sql_text(value: str | None) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _outcome(passed: bool, code=None, kind=None, http=None, message=None) -> Column:
    """A constant outcome, as one SQL expression."""
    def number(value):
        return f"CAST({'NULL' if value is None else value} AS INT)"

    return F.expr(
        f"named_struct('passed', {str(passed).lower()}, 'error_code', {number(code)}, "
        f"'error_type', {_sql_text(kind)}, 'http_sc', {number(http)}, "
        f"'error_message', {_sql_text(message)})"
    )


def passed() -> Column:
    return _outcome(True)


def internal_error(policy: Policy, http: int | None = None) -> Column:
    return _outcome(False, INTERNAL_ERROR, None, http, policy.internal_error)


def assessment(policy: Policy, direction: Column, details: Column | None) -> Column:
    """JSON text of the assessment; the ``assessments`` field is optional."""
    parts = [
        F.lit(ACTION).alias("action"),
        F.lit(policy.name).alias("interveningGuardrail"),
        F.when(direction == "RESPONSE", "RESPONSE").otherwise("REQUEST").alias("direction"),
        F.lit(REASONS[policy.error_type]).alias("actionReason"),
    ]
    if details is not None:
        parts.append(details.alias("assessments"))
    return F.to_json(F.struct(*parts))


def violation(policy: Policy, message: Column, detailed: bool) -> Column:
    """Blocked message; without a fault sequence the text is a short one."""
    short = None if detailed else f"Violation of {policy.name} detected."
    blocked = _outcome(False, VIOLATION, policy.error_type, HTTP_STATUS, short)
    return blocked.withField("error_message", message.cast("string")) if detailed else blocked


def violations(df: DataFrame) -> DataFrame:
    """Messages that did not pass."""
    return df.where(~F.col("outcome.passed"))


def allowed(df: DataFrame) -> DataFrame:
    """Messages that may go on."""
    return df.where(F.col("outcome.passed"))


def fault_records(df: DataFrame) -> DataFrame:
    """Quarantine table: one row per stopped message, outcome as columns."""
    keep = [c for c in df.columns if c not in ("outcome", "payload_out")]
    return violations(df).select(
        *keep,
        *[
            F.col(f"outcome.{name}").alias(name)
            for name in ("error_code", "error_type", "http_sc", "error_message")
        ],
    )
