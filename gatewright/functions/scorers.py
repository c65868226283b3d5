"""Requests to outside scorers and the reading of their answers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the two scorer protocols.
INTERVENED = "GUARDRAIL_INTERVENED"
NOT_INTERVENED = "NONE"
BLOCKED = "Guardrail blocked."
MASKED = "Guardrail masked."
ANONYMIZED = "ANONYMIZED"
INVOCATION_METRICS = "invocationMetrics"
MODERATION_ENDPOINT = "/contentsafety/text:analyze?api-version=2024-09-01"
MODERATION_CATEGORIES = ("Hate", "Sexual", "SelfHarm", "Violence")

_FOUND = "array<struct<action:string,match:string,type:string,name:string>>"


def bedrock_request(content: Column, direction: Column) -> Column:
    """Request body; keys in alphabetical order, a null text is kept."""
    source = F.when(direction == "RESPONSE", "OUTPUT").otherwise("INPUT")
    body = F.struct(
        F.array(F.struct(F.struct(content.alias("text")).alias("text"))).alias("content"),
        source.alias("source"),
    )
    return F.to_json(body, {"ignoreNullFields": "false"})


def bedrock_call(region: str, guardrail_id: str, version: str) -> dict[str, str]:
    """Call-out fields that are the same for every message of a policy."""
    host = f"bedrock-runtime.{region}.amazonaws.com"
    uri = f"/guardrail/{guardrail_id}/version/{version}/apply"
    return {
        "service": "bedrock",
        "guardrail_region": region,
        "request_host": host,
        "request_uri": uri,
        "request_url": f"https://{host}{uri}",
    }


def moderation_request(content: Column, thresholds: Mapping[str, int]) -> Column:
    """Request body; NULL when no category has a valid threshold."""
    wanted = [name for name, level in thresholds.items() if 0 <= level <= 7]
    if not wanted:
        return F.lit(None).cast("string")
    body = F.struct(
        content.alias("text"),
        F.array(*[F.lit(name) for name in wanted]).alias("categories"),
        F.lit(True).alias("haltOnBlocklistHit"),
        F.lit("EightSeverityLevels").alias("outputType"),
    )
    return F.when(content.isNotNull(), F.to_json(body))


def _get(answer: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(answer, path, kind)


def analysis(answer: Column) -> Column:
    """``(category, severity)`` pairs of a moderation answer, in its order."""
    return F.transform(
        _get(answer, "$.categoriesAnalysis", "array<variant>"),
        lambda item: F.struct(
            F.coalesce(_get(item, "$.category", "string"), F.lit("")).alias("category"),
            F.coalesce(_get(item, "$.severity", "int"), F.lit(0)).alias("severity"),
        ),
    )


def threshold_of(category: Column, thresholds: Mapping[str, int]) -> Column:
    """NULL for a category the policy does not know."""
    value = F.lit(None).cast("int")
    for name, level in thresholds.items():
        value = F.when(category == name, F.lit(level)).otherwise(value)
    return value


def moderation_finding(found: Column, thresholds: Mapping[str, int]) -> Column:
    """``block``, ``error`` or ``pass``; the first decisive category counts.

    A category that is switched off has threshold -1 and so always blocks when
    the scorer returns it; an unknown category is an error.
    """

    def finding(item: Column) -> Column:
        limit = threshold_of(item["category"], thresholds)
        return F.when(limit.isNull(), "error").when(item["severity"] >= limit, "block")

    decisive = F.filter(F.transform(found, finding), lambda x: x.isNotNull())
    return F.coalesce(F.try_element_at(decisive, F.lit(1)), F.lit("pass"))


def moderation_rows(found: Column, thresholds: Mapping[str, int]) -> Column:
    """Per-category report of a blocked message."""

    def row(item: Column) -> Column:
        limit = F.coalesce(threshold_of(item["category"], thresholds), F.lit(-1))
        failed = (limit >= 0) & (item["severity"] >= limit)
        return F.struct(
            item["category"].alias("category"),
            item["severity"].alias("severity"),
            limit.alias("threshold"),
            F.when(failed, "FAIL").otherwise("PASS").alias("result"),
        )

    return F.transform(found, row)


def anonymized(answer: Column) -> Column:
    """``(match, label)`` of the texts to mask: entities first, then regexes."""
    policy = "$.assessments[0].sensitiveInformationPolicy"
    none = F.array().cast(_FOUND)
    both = F.concat(
        F.coalesce(_get(answer, policy + ".piiEntities", _FOUND), none),
        F.coalesce(_get(answer, policy + ".regexes", _FOUND), none),
    )
    wanted = F.filter(both, lambda e: e["action"] == ANONYMIZED)
    return F.transform(
        wanted,
        lambda e: F.struct(
            F.coalesce(e["match"], F.lit("")).alias("match"),
            F.coalesce(
                F.when(e["type"] != "", e["type"]), F.upper(e["name"]), F.lit("")
            ).alias("label"),
        ),
    )


def redacted_text(answer: Column) -> Column:
    """Text of the first output; NULL when the scorer returned no output."""
    first = _get(answer, "$.output[0]", "variant")
    return F.when(
        first.isNotNull(), F.coalesce(_get(first, "$.text", "string"), F.lit(""))
    )


def first_assessment(answer: Column) -> Column:
    """First assessment without its metrics: a JSON object, else its text."""
    first = _get(answer, "$.assessments[0]", "variant")
    fields = F.map_filter(
        _get(first, "$", "map<string,variant>"), lambda key, _: key != INVOCATION_METRICS
    )
    return F.coalesce(
        F.to_variant_object(fields),
        F.coalesce(F.to_json(first), F.lit("")).cast("variant"),
    )


def thresholds(levels: Sequence[int]) -> dict[str, int]:
    return dict(zip(MODERATION_CATEGORIES, levels, strict=True))
