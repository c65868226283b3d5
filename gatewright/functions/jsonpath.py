"""JSON paths as Column expressions over a parsed payload.

A payload is parsed once; every path of every policy
then navigates that variant value. Paths are resolved to plain expressions on
the driver: ``$``, ``.name``, ``['name']``, ``[n]``, ``[-n]`` and ``[*]``.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

ALL = object()
Step = str | int | object

_STEP = re.compile(
    r"""\.(?P<name>[^.\[\]\s'"*()?@]+)
      | \.(?P<dotall>\*)
      | \[\s*'(?P<single>[^']+)'\s*\]
      | \[\s*"(?P<double>[^"]+)"\s*\]
      | \[\s*(?P<index>-?\d+)\s*\]
      | \[\s*(?P<all>\*)\s*\]""",
    re.VERBOSE,
)


def is_whole(path: str | None) -> bool:
    """A blank path means that the raw payload text is inspected."""
    return path is None or path.strip() == ""


@lru_cache(maxsize=256)
def parse(path: str) -> tuple[Step, ...]:
    """Split a path into names, indices and ``ALL``; other syntax is refused."""
    text = path.strip()
    if not text.startswith("$"):
        raise ValueError(f"JSON path must start with '$': {path!r}")
    steps: list[Step] = []
    at = 1
    while at < len(text):
        found = _STEP.match(text, at)
        if found is None:
            raise ValueError(f"unsupported JSON path syntax at {at}: {path!r}")
        if found["index"] is not None:
            steps.append(int(found["index"]))
        elif found["all"] or found["dotall"]:
            steps.append(ALL)
        else:
            steps.append(found["name"] or found["single"] or found["double"])
        at = found.end()
    return tuple(steps)


# One parser for all payloads: texts of any length, up to the 128 MiB of a variant.
_PARSER = {
    "maxStringLen": "2147483647", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false",
}


def document(payload: Column) -> Column:
    """Parsed payload; null when the text is not JSON."""
    return F.from_json(payload, "variant", _PARSER)


def as_text(value: Column) -> Column:
    """Text of a variant: strings as they are, objects and arrays as JSON.

    A JSON null gives SQL NULL, which the policies report as an error.
    """
    return F.try_variant_get(value, "$", "string")


def _quoted(name: str) -> str:
    return f'["{name}"]' if "'" in name else f"['{name}']"


def lookup(value: Column, steps: tuple[Step, ...], kind: str = "variant") -> Column:
    """Value at the end of ``steps``, NULL when any part is missing.

    Runs of names and forward indices become one ``try_variant_get``; only an
    index counted from the end, or ``[*]``, opens the array.
    """
    head = 0
    while head < len(steps) and (
        isinstance(steps[head], str) or (isinstance(steps[head], int) and steps[head] >= 0)
    ):
        head += 1
    prefix = "$" + "".join(
        _quoted(s) if isinstance(s, str) else f"[{s}]" for s in steps[:head]
    )
    if head == len(steps):
        return F.try_variant_get(value, prefix, kind)
    items = F.try_variant_get(value, prefix, "array<variant>")
    rest = steps[head + 1 :]
    if steps[head] is ALL:
        found = F.filter(
            F.transform(items, lambda item: lookup(item, rest)), lambda item: item.isNotNull()
        )
        return F.try_variant_get(F.to_variant_object(found), "$", kind)
    return lookup(F.try_element_at(items, F.lit(steps[head])), rest, kind)


def read(doc: Column, path: str) -> Column:
    """Text at ``path``; NULL for a missing path, a JSON null or bad JSON."""
    return lookup(doc, parse(path), "string")


def quoted_text(text: Column) -> Column:
    """JSON text of a string."""
    return F.to_json(text.cast("variant"))


def _as_written(text: Column, item: Column) -> Column:
    """JSON text of a field or element: ``text`` is a string's content or the
    JSON text of anything else, ``item`` is the parsed value.

    The parsed value has decimals exactly, but turns integers of more than 38
    digits into doubles; the text has integers exactly, but cuts long fractions.
    """
    kind, parsed = F.schema_of_variant(item), F.to_json(item)
    rounded = (kind == "DOUBLE") | parsed.rlike("[0-9]E[-+]?[0-9]")
    return (F.when(text.isNull(), "null").when(kind == "STRING", quoted_text(text))
            .when(rounded, text).otherwise(parsed))


def raw_at(raw: Column, path: str) -> Column:
    """JSON text at a path without ``[*]``, as it was written."""
    for step in parse(path):
        if isinstance(step, str):
            raw = F.try_element_at(F.from_json(raw, "map<string,string>", _PARSER), F.lit(step))
        else:
            elements = F.from_json(raw, "array<string>", _PARSER)
            raw = F.try_element_at(elements, F.lit(step + 1 if step >= 0 else step))
    return raw


def replace(raw: Column, doc: Column, path: str, value: Column) -> Column:
    """Payload text with the JSON text ``value`` at an existing ``path``.

    ``doc`` is the parsed ``raw``. Only objects and arrays on the way are taken
    apart; everything beside it keeps its value, long numbers included.
    """
    return _replace(raw, doc, parse(path), value)


def _replace(raw: Column, node: Column, steps: tuple[Step, ...], value: Column) -> Column:
    if not steps:
        return value
    step, rest = steps[0], steps[1:]
    if isinstance(step, str):
        texts = F.map_entries(F.from_json(raw, "map<string,string>", _PARSER))
        items = F.try_variant_get(node, "$", "map<string,variant>")
        keys = F.transform(texts, lambda e: e["key"])
        # of a repeated key the last entry counts
        texts = F.filter(texts, lambda e, i: F.array_position(F.reverse(keys), e["key"]) == F.size(keys) - i)

        def field(entry: Column) -> Column:
            key, text = entry["key"], entry["value"]
            item = F.try_element_at(items, key)
            new = F.when(key == step, _replace(text, item, rest, value)).otherwise(_as_written(text, item))
            return F.concat(quoted_text(key), F.lit(":"), new)

        return F.concat(F.lit("{"), F.array_join(F.transform(texts, field), ","), F.lit("}"))
    texts = F.from_json(raw, "array<string>", _PARSER)
    items = F.try_variant_get(node, "$", "array<variant>")
    pairs = F.zip_with(texts, items, lambda text, item: F.struct(text.alias("text"), item.alias("item")))

    def element(pair: Column, i: Column) -> Column:
        text, item = pair["text"], pair["item"]
        changed = _replace(text, item, rest, value)
        if step is ALL:
            return changed
        place = F.lit(step) if step >= 0 else F.size(items) + step
        return F.when(i == place, changed).otherwise(_as_written(text, item))

    return F.concat(F.lit("["), F.array_join(F.transform(pairs, element), ","), F.lit("]"))


def replace_text(raw: Column, doc: Column, path: str, text: Column) -> Column:
    """Payload text after putting the string ``text`` at ``path``."""
    return replace(raw, doc, path, quoted_text(text))
