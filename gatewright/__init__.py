"""Content policies for tables and streams of JSON messages, on Spark."""

from gatewright.config import (
    BedrockVerdict,
    ContentLength,
    Decoration,
    JsonSchema,
    Moderation,
    PiiRegex,
    RegexMatch,
    SemanticGuard,
    SentenceCount,
    TemplateExpansion,
    UrlCheck,
    WordCount,
)
from gatewright.operators.apply import apply
from gatewright.operators.stage import Inputs
from gatewright.outcome import allowed, fault_records, violations
from gatewright.plans.chain import policy_report, run_chain

__all__ = [
    "BedrockVerdict", "ContentLength", "Decoration", "Inputs", "JsonSchema", "Moderation",
    "PiiRegex", "RegexMatch", "SemanticGuard", "SentenceCount", "TemplateExpansion",
    "UrlCheck", "WordCount", "allowed", "apply", "fault_records", "policy_report",
    "run_chain", "violations",
]
