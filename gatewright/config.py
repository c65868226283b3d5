"""Policy configurations: one frozen dataclass per policy.

``from_attributes`` takes the attribute names of a policy form (camelCase,
values as text, numbers or JSON) and applies the checks of that form.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from typing import Any, ClassVar

from gatewright.functions import jsonpath, scorers


def _snake(name: str) -> str:
    special = {"onlyDNS": "only_dns", "redactPII": "redact_pii"}
    return special.get(name) or re.sub(r"(?<!^)(?=[A-Z])", "_", name).lower()


def _flag(value: Any) -> bool:
    if isinstance(value, bool):
        return value
    text = str(value).strip().lower()
    if text not in ("true", "false", ""):
        raise ValueError(f"not a boolean: {value!r}")
    return text == "true"


def _document(value: Any) -> Any:
    return json.loads(value) if isinstance(value, str) else value


@dataclass(frozen=True)
class Policy:
    name: str
    json_path: str = ""

    # Flows a policy can be attached to, and the fault type it reports.
    flows: ClassVar[tuple[str, ...]] = ("REQUEST", "RESPONSE")
    error_type: ClassVar[str | None] = None
    # Name of the policy kind in its internal error text (fixed value).
    label: ClassVar[str] = ""
    # Attribute checks of the policy form: name -> pattern.
    form: ClassVar[Mapping[str, str]] = {}

    def __post_init__(self):
        if not self.name:
            raise ValueError("a policy needs a name")
        if not jsonpath.is_whole(self.json_path):
            jsonpath.parse(self.json_path)

    @property
    def internal_error(self) -> str:
        return f"Error occurred during {self.label} mediation"

    @classmethod
    def from_attributes(cls, attributes: Mapping[str, Any]) -> "Policy":
        known = {f.name: f for f in fields(cls) if f.init}
        values: dict[str, Any] = {}
        for attribute, value in attributes.items():
            pattern = cls.form.get(attribute)
            if pattern and not re.fullmatch(pattern, str(value)):
                raise ValueError(f"{attribute}={value!r} does not match {pattern}")
            name = _snake(attribute)
            if name not in known:
                raise ValueError(f"unknown attribute of {cls.__name__}: {attribute!r}")
            kind = str(known[name].type)
            if kind == "bool":
                value = _flag(value)
            elif kind == "int":
                value = int(value)
            elif kind == "float":
                value = float(value)
            values[name] = value
        return cls(**values)


_COUNT_FORM = {"min": "[1-9][0-9]*", "max": "[1-9][0-9]*"}


@dataclass(frozen=True)
class CountPolicy(Policy):
    min: int = 0
    max: int = 0
    invert: bool = False
    show_assessment: bool = False

    form: ClassVar = _COUNT_FORM

    def __post_init__(self):
        super().__post_init__()
        if self.min > self.max:
            raise ValueError(f"no count lies between {self.min} and {self.max}")

    # The inverted message speaks of "less than" and "or more than".
    @property
    def bounds(self) -> str:
        if self.invert:
            return f"less than {self.min} or more than {self.max}"
        return f"between {self.min} and {self.max}"


@dataclass(frozen=True)
class WordCount(CountPolicy):
    label: ClassVar = "WordCountGuardrail"
    error_type: ClassVar = "WORD_COUNT_GUARDRAIL"


@dataclass(frozen=True)
class SentenceCount(CountPolicy):
    label: ClassVar = "SentenceCountGuardrail"
    error_type: ClassVar = "SENTENCE_COUNT_GUARDRAIL"


@dataclass(frozen=True)
class ContentLength(CountPolicy):
    label: ClassVar = "ContentLengthGuardrail"

    show_assessment: bool = True

    error_type: ClassVar = "CONTENT_LENGTH_GUARDRAIL"

    @classmethod
    def from_attributes(cls, attributes):
        return super().from_attributes({"showAssessment": False, **attributes})


@dataclass(frozen=True)
class RegexMatch(Policy):
    label: ClassVar = "RegexGuardrail"
    regex: str = ""
    invert: bool = False
    show_assessment: bool = False

    error_type: ClassVar = "REGEX_GUARDRAIL"


@dataclass(frozen=True)
class JsonSchema(Policy):
    label: ClassVar = "JSONSchemaGuardrail"
    schema: str = "{}"
    invert: bool = False
    show_assessment: bool = False

    error_type: ClassVar = "JSON_SCHEMA_GUARDRAIL"

    def __post_init__(self):
        super().__post_init__()
        if not isinstance(self.schema, str):
            object.__setattr__(self, "schema", json.dumps(self.schema))
        json.loads(self.schema)


@dataclass(frozen=True)
class UrlCheck(Policy):
    label: ClassVar = "URLGuardrail"
    timeout: int = 3000
    only_dns: bool = False
    show_assessment: bool = True

    error_type: ClassVar = "URL_GUARDRAIL"
    form: ClassVar = {"timeout": "[1-9][0-9]*"}

    @classmethod
    def from_attributes(cls, attributes):
        return super().from_attributes({"showAssessment": False, **attributes})


@dataclass(frozen=True)
class SemanticGuard(Policy):
    """``rules`` lists prompts; ``vectors`` holds their embeddings.

    Deny prompts come first in ``vectors``, then allow prompts. Leave it empty
    to have an embedding provider fill it in. Rule sets of any size come as a
    table (``Inputs.rules``); ``table`` then says what it holds: DENY_ONLY,
    ALLOW_ONLY or HYBRID.
    """

    rules: Any = field(default_factory=dict)
    threshold: float = 90.0
    show_assessment: bool = False
    vectors: tuple[tuple[float, ...], ...] = ()
    table: str = ""

    error_type: ClassVar = "SEMANTIC_PROMPT_GUARD"
    form: ClassVar = {"threshold": "100|[1-9]?[0-9]"}

    def __post_init__(self):
        super().__post_init__()
        rules = _document(self.rules)
        if not isinstance(rules, Mapping):
            raise ValueError("the prompt rules are not a JSON object")
        deny = tuple(rules.get("denyPrompts") or ())
        allow = tuple(rules.get("allowPrompts") or ())
        if self.table not in ("", "DENY_ONLY", "ALLOW_ONLY", "HYBRID"):
            raise ValueError(f"not a mode of a rule table: {self.table}")
        if bool(self.table) == bool(deny or allow):
            raise ValueError("a semantic policy needs an allow or a deny prompt, or else a table of rules")
        object.__setattr__(self, "rules", {"denyPrompts": deny, "allowPrompts": allow})
        if self.vectors:
            vectors = tuple(tuple(float(x) for x in v) for v in self.vectors)
            if len(vectors) != len(deny) + len(allow):
                raise ValueError("one vector per prompt is needed")
            if len({len(v) for v in vectors}) != 1:
                raise ValueError("rule vectors differ in length")
            object.__setattr__(self, "vectors", vectors)

    @property
    def deny(self) -> tuple[str, ...]:
        return self.rules["denyPrompts"]

    @property
    def allow(self) -> tuple[str, ...]:
        return self.rules["allowPrompts"]

    @property
    def mode(self) -> str:
        if self.table:
            return self.table
        if not self.allow:
            return "DENY_ONLY"
        return "HYBRID" if self.deny else "ALLOW_ONLY"

    @property
    def internal_error(self) -> str:
        return f"Error occurred during {self.name} mediation"


@dataclass(frozen=True)
class PiiRegex(Policy):
    label: ClassVar = "PIIMaskingRegex"
    pii_entities: Any = ()
    redact: bool = False

    def __post_init__(self):
        super().__post_init__()
        # A repeated entity name keeps its place and takes the last pattern.
        rules: dict[str, str] = {}
        for item in _document(self.pii_entities):
            entity, pattern = (
                (item.get("piiEntity"), item.get("piiRegex"))
                if isinstance(item, Mapping)
                else item
            )
            if entity is None or pattern is None:
                raise ValueError(
                    f"a masking rule needs piiEntity and piiRegex, not {item}"
                )
            rules[entity] = pattern
        object.__setattr__(self, "pii_entities", tuple(rules.items()))


@dataclass(frozen=True)
class TemplateExpansion(Policy):
    label: ClassVar = "PromptTemplate"
    prompt_template_config: Any = ()

    flows: ClassVar = ("REQUEST",)

    def __post_init__(self):
        super().__post_init__()
        templates: dict[str, str] = {}
        for item in _document(self.prompt_template_config):
            name, prompt = item.get("name"), item.get("prompt")
            if name is None or prompt is None:
                raise ValueError(f"a template needs a name and a prompt, not {item}")
            templates[name] = prompt
        object.__setattr__(self, "prompt_template_config", tuple(templates.items()))

    @property
    def templates(self) -> dict[str, str]:
        return dict(self.prompt_template_config)


@dataclass(frozen=True)
class Decoration(Policy):
    label: ClassVar = "PromptDecorator"
    json_path: str = "$.messages"
    prompt_decorator_config: Any = field(default_factory=dict)
    append: bool = False

    flows: ClassVar = ("REQUEST",)

    def __post_init__(self):
        super().__post_init__()
        root = _document(self.prompt_decorator_config)
        decoration = root.get("decoration") if isinstance(root, Mapping) else None
        if not isinstance(decoration, (str, list)):
            raise ValueError("a decoration is a text or an array of messages")
        if jsonpath.is_whole(self.json_path):
            raise ValueError("a decorator needs a JSON path")
        object.__setattr__(self, "prompt_decorator_config", {"decoration": decoration})

    @property
    def decoration(self) -> str | list:
        return self.prompt_decorator_config["decoration"]


_LEVEL = "[0-7]"


@dataclass(frozen=True)
class Moderation(Policy):
    label: ClassVar = "AzureContentSafetyContentModeration"
    hate_category: int = -1
    sexual_category: int = -1
    self_harm_category: int = -1
    violence_category: int = -1
    passthrough_on_error: bool = False
    show_assessment: bool = False

    error_type: ClassVar = "AZURE_CONTENT_SAFETY_CONTENT_MODERATION"
    form: ClassVar = {
        "hateCategory": _LEVEL,
        "sexualCategory": _LEVEL,
        "selfHarmCategory": _LEVEL,
        "violenceCategory": _LEVEL,
    }

    @property
    def thresholds(self) -> dict[str, int]:
        return scorers.thresholds(
            (
                self.hate_category,
                self.sexual_category,
                self.self_harm_category,
                self.violence_category,
            )
        )


@dataclass(frozen=True)
class BedrockVerdict(Policy):
    region: str = ""
    guardrail_id: str = ""
    guardrail_version: str = ""
    passthrough_on_error: bool = False
    redact_pii: bool = False
    show_assessment: bool = False

    error_type: ClassVar = "AWS_BEDROCK_GUARDRAIL"

    @property
    def internal_error(self) -> str:
        return f"Violation of {self.name} detected."
