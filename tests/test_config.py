import json

import pytest

import gatewright as g


def test_attributes_of_a_form():
    policy = g.WordCount.from_attributes(
        {"name": "W", "min": "2", "max": 5, "jsonPath": "$.a", "invert": "true", "showAssessment": "false"})
    assert policy == g.WordCount("W", "$.a", min=2, max=5, invert=True)
    assert g.UrlCheck.from_attributes({"name": "U", "onlyDNS": "true"}) == g.UrlCheck(
        "U", only_dns=True, show_assessment=False)
    assert g.UrlCheck("U").timeout == 3000 and g.UrlCheck("U").show_assessment
    assert not g.ContentLength.from_attributes({"name": "L", "min": 1, "max": 2}).show_assessment
    assert g.BedrockVerdict.from_attributes(
        {"name": "B", "region": "r", "guardrailId": "i", "guardrailVersion": "1", "redactPII": "true",
         "passthroughOnError": "true"}).redact_pii
    assert g.Moderation.from_attributes({"name": "M", "hateCategory": "2"}).thresholds == {
        "Hate": 2, "Sexual": -1, "SelfHarm": -1, "Violence": -1}
    rules = {"allowPrompts": ["a"], "denyPrompts": []}
    semantic = g.SemanticGuard.from_attributes({"name": "S", "rules": json.dumps(rules), "threshold": "80"})
    assert semantic.mode == "ALLOW_ONLY" and semantic.threshold == 80.0
    pii = g.PiiRegex.from_attributes(
        {"name": "P", "piiEntities": json.dumps([{"piiEntity": "E", "piiRegex": "x"}]), "redact": "true"})
    assert pii.pii_entities == (("E", "x"),) and pii.redact
    decoration = g.Decoration.from_attributes(
        {"name": "D", "promptDecoratorConfig": json.dumps({"decoration": "x"})})
    assert decoration.json_path == "$.messages" and not decoration.append
    template = g.TemplateExpansion.from_attributes(
        {"name": "T", "promptTemplateConfig": json.dumps([{"name": "n", "prompt": "p"}])})
    assert template.templates == {"n": "p"}
    assert g.RegexMatch.from_attributes({"name": "R", "regex": "x"}).regex == "x"
    assert g.JsonSchema.from_attributes({"name": "J", "schema": "{}"}).schema == "{}"


@pytest.mark.parametrize("policy,attributes", [
    (g.WordCount, {"name": "W", "min": "0", "max": "5"}),
    (g.WordCount, {"name": "W", "min": "x", "max": "5"}),
    (g.WordCount, {"name": "W", "min": "6", "max": "5"}),
    (g.WordCount, {"name": "", "min": "1", "max": "5"}),
    (g.WordCount, {"name": "W", "min": "1", "max": "5", "invert": "perhaps"}),
    (g.WordCount, {"name": "W", "min": "1", "max": "5", "other": 1}),
    (g.Moderation, {"name": "M", "hateCategory": "8"}),
    (g.SemanticGuard, {"name": "S", "rules": {"denyPrompts": ["x"]}, "threshold": "101"}),
    (g.SemanticGuard, {"name": "S", "rules": "[]"}),
    (g.TemplateExpansion, {"name": "T", "promptTemplateConfig": '[{"name": "n"}]'}),
    (g.UrlCheck, {"name": "U", "timeout": "0"}),
    (g.RegexMatch, {"name": "R", "regex": "x", "jsonPath": "a.b"}),
])
def test_bad_attributes(policy, attributes):
    with pytest.raises(ValueError):
        policy.from_attributes(attributes)


def test_zero_bounds_are_fine_in_code():
    assert g.WordCount("W", min=0, max=0).min == 0


def test_vectors_must_fit_the_prompts():
    rules = {"denyPrompts": ["a", "b"]}
    for vectors in (((1.0,),), ((1.0,), (1.0, 2.0))):
        with pytest.raises(ValueError):
            g.SemanticGuard("S", rules=rules, vectors=vectors)
