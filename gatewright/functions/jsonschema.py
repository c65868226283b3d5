"""JSON Schema keywords as boolean Column expressions over a variant value.

A schema is turned into one expression on the driver. Keywords that are not
listed here are refused when the policy is built, so a schema is never checked
in part.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from gatewright.functions.patterns import check_regex

_ANNOTATIONS = {
    "$schema", "$id", "id", "$comment", "title", "description", "default",
    "examples", "definitions", "$defs", "readOnly", "writeOnly",
}

# Patterns for the supported formats.
_FORMATS = {
    "email": r"^[A-Za-z0-9.!#$%&'*+/=?^_`{|}~-]+@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}$",
    "uri": r"^[A-Za-z][A-Za-z0-9+.-]*:[^\s<>\"{}|\\^`]+$",
    "date-time": r"^\d{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])[Tt](?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d(?:\.\d+)?(?:[Zz]|[+-]\d{2}:\d{2})$",
    "ipv4": r"^(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)$",
    "hostname": r"^(?=.{1,253}$)[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?)*$",
    "ipv6": r"^(?=[0-9A-Fa-f:.]*$)(?=(?:[^:]*:){2,7}[^:]*$)(?!.*::.*::)(?!:[^:])(?!.*[^:]:$)(?=.*::|(?:[^:]+:){7}[^:]+$|(?:[^:]+:){6}\d+\.)(?:[0-9A-Fa-f]{0,4}:)+(?:[0-9A-Fa-f]{0,4}|(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d))$",
    "uri-reference": r"^[^\s<>\"{}|\\^`]*$",
    "date": r"^\d{4}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12]\d|3[01])$",
    "time": r"^(?:[01]\d|2[0-3]):[0-5]\d:[0-5]\d(?:\.\d+)?(?:[Zz]|[+-]\d{2}:\d{2})$",
    "json-pointer": r"^(?:/(?:[^~/]|~[01])*)*$",
}
# Formats no pattern can decide.
_OTHER_FORMATS = {"regex", "uri-template", "relative-json-pointer"}

Check = Callable[[Column], Column]


def _bind(value: Column, check: Check) -> Column:
    """Evaluate ``value`` once and use it many times inside ``check``."""
    return F.exists(F.array(value), check)


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _fields(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>")


def _items(value: Column) -> Column:
    return F.try_variant_get(value, "$", "array<variant>")


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _number(value: Column) -> Column:
    return F.try_variant_get(value, "$", "double")


# 1.0 parses as DECIMAL(1,0) and is a number; an integer too long for a BIGINT
# parses as a DECIMAL without fraction and is still an integer.
def _is_integer(kind: Column) -> Column:
    return (kind == "BIGINT") | kind.rlike(r"^DECIMAL\((?:19|2\d|3\d),0\)$")


def _is_number(kind: Column) -> Column:
    return kind.rlike(r"^(?:BIGINT|DECIMAL|DOUBLE)")


_TYPES: dict[str, Callable[[Column], Column]] = {
    "string": lambda kind: kind == "STRING",
    "integer": _is_integer,
    "number": _is_number,
    "boolean": lambda kind: kind == "BOOLEAN",
    "null": lambda kind: kind == "VOID",
    "object": lambda kind: kind.startswith("OBJECT"),
    "array": lambda kind: kind.startswith("ARRAY"),
}


def _same(value: Column, expected: Any) -> Column:
    wanted = F.to_json(F.parse_json(F.lit(json.dumps(expected))))
    same = F.to_json(value) == wanted
    if isinstance(expected, (int, float)) and not isinstance(expected, bool):
        return _is_number(_kind(value)) & (_number(value) == float(expected))
    return same


def _checked_pattern(pattern: str) -> None:
    """Refuse a bad pattern now rather than in the running job."""
    spark = SparkSession.getActiveSession()
    if spark is not None:
        check_regex(spark, pattern)


def _all(checks: list[Column]) -> Column:
    result = F.lit(True)
    for check in checks:
        result = result & check
    return result


def _any(checks: list[Column]) -> Column:
    result = F.lit(False)
    for check in checks:
        result = result | check
    return result


class SchemaCheck:
    """Builds the expression for one schema document."""

    def __init__(self, schema: str | Mapping[str, Any] | bool):
        self.root = json.loads(schema) if isinstance(schema, str) else schema
        if not isinstance(self.root, (dict, bool)):
            raise ValueError("a JSON Schema is an object")
        self.check(self.root)(F.lit(None).cast("variant"))  # refuse bad schemas now

    def valid(self, value: Column) -> Column:
        """True for a valid value; NULL input is not valid."""
        return F.coalesce(value.isNotNull() & self.check(self.root)(value), F.lit(False))

    def _target(self, ref: str, trail: tuple[str, ...]) -> Check:
        if not ref.startswith("#"):
            raise ValueError(f"only local references are supported: {ref!r}")
        if ref in trail:
            raise ValueError(f"recursive reference: {ref!r}")
        node = self.root
        for part in [p for p in ref[1:].split("/") if p]:
            part = part.replace("~1", "/").replace("~0", "~")
            if not isinstance(node, dict) or part not in node:
                raise ValueError(f"unknown reference: {ref!r}")
            node = node[part]
        return self.check(node, trail + (ref,))

    def check(self, schema: Any, trail: tuple[str, ...] = ()) -> Check:
        if isinstance(schema, bool):
            return lambda value: F.lit(schema)
        if not isinstance(schema, dict):
            raise ValueError(f"not a schema: {schema!r}")
        if "$ref" in schema:
            return self._target(schema["$ref"], trail)
        # A type keyword is checked first and stands for the others' own tests.
        schema = dict(sorted(schema.items(), key=lambda item: item[0] != "type"))
        checks: list[Check] = []
        for keyword in schema:
            if keyword in _ANNOTATIONS or keyword in (
                "additionalProperties", "patternProperties", "additionalItems",
                "exclusiveMinimum", "exclusiveMaximum", "then", "else",
            ):
                continue
            build = getattr(self, "_kw_" + keyword, None)
            if build is None:
                raise ValueError(f"unsupported JSON Schema keyword: {keyword!r}")
            checks.append(build(schema[keyword], schema, trail))
        if "additionalProperties" in schema or "patternProperties" in schema:
            checks.append(self._other_properties(schema, trail))
        if "exclusiveMinimum" in schema or "exclusiveMaximum" in schema:
            checks.append(self._exclusive(schema))
        return lambda value: _all([check(value) for check in checks])

    # A keyword for one type says nothing about values of other types.
    @staticmethod
    def _typed(name: str, check: Check, schema) -> Check:
        pinned = schema.get("type")
        if pinned == name or (pinned == "integer" and name == "number"):
            return check
        return lambda value: ~_TYPES[name](_kind(value)) | check(value)

    def _kw_type(self, wanted, schema, trail) -> Check:
        names = [wanted] if isinstance(wanted, str) else list(wanted)
        for name in names:
            if name not in _TYPES:
                raise ValueError(f"unknown type: {name!r}")
        return lambda value: _any([_TYPES[name](_kind(value)) for name in names])

    def _kw_enum(self, wanted, schema, trail) -> Check:
        return lambda value: _any([_same(value, item) for item in wanted])

    def _kw_const(self, wanted, schema, trail) -> Check:
        return lambda value: _same(value, wanted)

    def _kw_minLength(self, limit, schema, trail) -> Check:
        return self._typed("string", lambda value: F.length(_text(value)) >= int(limit), schema)

    def _kw_maxLength(self, limit, schema, trail) -> Check:
        return self._typed("string", lambda value: F.length(_text(value)) <= int(limit), schema)

    def _kw_pattern(self, pattern, schema, trail) -> Check:
        _checked_pattern(pattern)
        return self._typed("string", lambda value: _text(value).rlike(pattern), schema)

    def _kw_format(self, name, schema, trail) -> Check:
        if name in _FORMATS:
            return self._kw_pattern(_FORMATS[name], schema, trail)
        if name in _OTHER_FORMATS:
            raise ValueError(f"unsupported format: {name!r}")
        return lambda value: F.lit(True)

    def _kw_minimum(self, limit, schema, trail) -> Check:
        if schema.get("exclusiveMinimum") is True:
            return self._typed("number", lambda value: _number(value) > float(limit), schema)
        return self._typed("number", lambda value: _number(value) >= float(limit), schema)

    def _kw_maximum(self, limit, schema, trail) -> Check:
        if schema.get("exclusiveMaximum") is True:
            return self._typed("number", lambda value: _number(value) < float(limit), schema)
        return self._typed("number", lambda value: _number(value) <= float(limit), schema)

    def _exclusive(self, schema) -> Check:
        low, high = schema.get("exclusiveMinimum"), schema.get("exclusiveMaximum")

        def check(value: Column) -> Column:
            parts = []
            if low is not None and not isinstance(low, bool):
                parts.append(_number(value) > float(low))
            if high is not None and not isinstance(high, bool):
                parts.append(_number(value) < float(high))
            return _all(parts)

        return self._typed("number", check, schema)

    def _kw_multipleOf(self, step, schema, trail) -> Check:
        if float(step) <= 0:
            raise ValueError("multipleOf must be positive")
        exact = F.lit(str(step)).cast("decimal(38,18)")

        def check(value: Column) -> Column:
            number = F.try_variant_get(value, "$", "decimal(38,18)")
            return F.coalesce(number % exact == 0, _number(value) % F.lit(float(step)) == 0)

        return self._typed("number", check, schema)

    def _kw_required(self, names, schema, trail) -> Check:
        if isinstance(names, bool):
            raise ValueError("'required' must be a list of names")
        return self._typed(
            "object",
            lambda value: _bind(_fields(value), lambda fields: _all(
                [F.map_contains_key(fields, name) for name in names])),
            schema,
        )

    def _kw_properties(self, properties, schema, trail) -> Check:
        checks = {name: self.check(sub, trail) for name, sub in properties.items()}

        def check(value: Column) -> Column:
            def each(fields: Column) -> Column:
                return _all(
                    [
                        ~F.map_contains_key(fields, name)
                        | _bind(F.try_element_at(fields, F.lit(name)), sub)
                        for name, sub in checks.items()
                    ]
                )

            return _bind(_fields(value), each)

        return self._typed("object", check, schema)

    def _other_properties(self, schema, trail) -> Check:
        names = list(schema.get("properties", {}))
        patterns = {p: self.check(s, trail) for p, s in schema.get("patternProperties", {}).items()}
        for pattern in patterns:
            _checked_pattern(pattern)
        rest = schema.get("additionalProperties", True)
        rest_check = self.check(rest, trail)

        def entry(item: Column) -> Column:
            key, value = item["key"], item["value"]
            matched = [key.rlike(p) for p in patterns]
            parts = [~key.rlike(p) | _bind(value, sub) for p, sub in patterns.items()]
            if rest is not True:
                known = _any([key.isin(names)] if names else []) | _any(matched)
                parts.append(known | _bind(value, rest_check))
            return _all(parts)

        return self._typed(
            "object", lambda value: F.forall(F.map_entries(_fields(value)), entry),
            schema,
        )

    def _kw_minProperties(self, limit, schema, trail) -> Check:
        return self._typed("object", lambda value: F.size(_fields(value)) >= int(limit), schema)

    def _kw_maxProperties(self, limit, schema, trail) -> Check:
        return self._typed("object", lambda value: F.size(_fields(value)) <= int(limit), schema)

    def _kw_items(self, items, schema, trail) -> Check:
        if isinstance(items, list):
            checks = [self.check(sub, trail) for sub in items]
            rest = self.check(schema.get("additionalItems", True), trail)

            def by_place(value: Column) -> Column:
                def each(values: Column) -> Column:
                    parts = [
                        (F.size(values) <= i) | _bind(F.get(values, i), sub)
                        for i, sub in enumerate(checks)
                    ]
                    tail = F.filter(values, lambda item, i: i >= len(checks))
                    return _all(parts + [F.forall(tail, rest)])

                return _bind(_items(value), each)

            return self._typed("array", by_place, schema)
        check = self.check(items, trail)
        return self._typed("array", lambda value: F.forall(_items(value), check), schema)

    def _kw_minItems(self, limit, schema, trail) -> Check:
        return self._typed("array", lambda value: F.size(_items(value)) >= int(limit), schema)

    def _kw_maxItems(self, limit, schema, trail) -> Check:
        return self._typed("array", lambda value: F.size(_items(value)) <= int(limit), schema)

    def _kw_uniqueItems(self, wanted, schema, trail) -> Check:
        if not wanted:
            return lambda value: F.lit(True)

        def check(value: Column) -> Column:
            texts = F.transform(_items(value), lambda item: F.to_json(item))
            return F.size(F.array_distinct(texts)) == F.size(texts)

        return self._typed("array", check, schema)

    def _kw_contains(self, part, schema, trail) -> Check:
        check = self.check(part, trail)
        return self._typed("array", lambda value: F.exists(
            _items(value), lambda item: F.coalesce(check(item), F.lit(False))), schema)

    def _kw_propertyNames(self, part, schema, trail) -> Check:
        check = self.check(part, trail)
        return self._typed("object", lambda value: F.forall(
            F.map_keys(_fields(value)), lambda key: check(key.cast("variant"))), schema)

    def _kw_dependencies(self, wanted, schema, trail) -> Check:
        """A property asks for others, by name, or for a schema of the whole object."""
        parts = {name: self.check({"required": list(then)} if isinstance(then, list) else then, trail)
                 for name, then in wanted.items()}

        def check(value: Column) -> Column:
            return _bind(F.struct(_fields(value).alias("fields"), value.alias("value")), lambda both: _all(
                [~F.map_contains_key(both["fields"], name) | part(both["value"]) for name, part in parts.items()]))

        return self._typed("object", check, schema)

    def _kw_if(self, part, schema, trail) -> Check:
        """``then`` and ``else`` without ``if`` say nothing."""
        when, then, other = (self.check(p, trail) for p in (
            part, schema.get("then", True), schema.get("else", True)))

        def check(value: Column) -> Column:
            met = F.coalesce(when(value), F.lit(False))
            return F.when(met, then(value)).otherwise(other(value))

        return check

    def _kw_allOf(self, parts, schema, trail) -> Check:
        checks = [self.check(sub, trail) for sub in parts]
        return lambda value: _all([check(value) for check in checks])

    def _kw_anyOf(self, parts, schema, trail) -> Check:
        checks = [self.check(sub, trail) for sub in parts]
        return lambda value: _any([check(value) for check in checks])

    def _kw_oneOf(self, parts, schema, trail) -> Check:
        checks = [self.check(sub, trail) for sub in parts]

        def check(value: Column) -> Column:
            hits = F.lit(0)
            for part in checks:
                hits = hits + F.coalesce(part(value), F.lit(False)).cast("int")
            return hits == 1

        return check

    def _kw_not(self, part, schema, trail) -> Check:
        check = self.check(part, trail)
        return lambda value: ~F.coalesce(check(value), F.lit(False))
