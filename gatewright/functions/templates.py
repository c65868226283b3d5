"""Expansion of ``template://name?key=value`` references inside a payload."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed pattern of the reference behaviour.
TEMPLATE = r"""template://[a-zA-Z0-9_-]+\?[^\s"']*"""


def find_templates(payload: Column) -> Column:
    return F.regexp_extract_all(payload, F.lit(TEMPLATE), F.lit(0))


def _decoded_query(reference: Column) -> Column:
    """Query part with percent escapes decoded and ``+`` left alone."""
    raw = F.try_parse_url(reference, F.lit("QUERY"))
    return F.try_url_decode(F.replace(raw, F.lit("+"), F.lit("%2B")))


def parameters(reference: Column) -> Column:
    """``(name, value)`` pairs, decoded a second time; NULL where that fails."""
    pieces = F.filter(
        F.split(_decoded_query(reference), "&"), lambda piece: piece.contains("=")
    )
    return F.transform(
        pieces,
        lambda piece: F.struct(
            F.try_url_decode(F.substring_index(piece, "=", 1)).alias("name"),
            F.try_url_decode(F.substr(piece, F.instr(piece, "=") + 1)).alias("value"),
        ),
    )


def _fill(template: Column, pairs: Column) -> Column:
    """Put each value at its ``[[name]]``; the last value of a name counts."""
    effective = F.filter(
        pairs,
        lambda pair, i: ~F.exists(
            F.slice(pairs, i + 2, F.size(pairs)), lambda later: later["name"] == pair["name"]
        ),
    )
    filled = F.aggregate(
        effective,
        template,
        lambda text, p: F.replace(text, F.concat(F.lit("[["), p["name"], F.lit("]]")), p["value"]),
    )
    broken = F.exists(pairs, lambda p: p["name"].isNull() | p["value"].isNull())
    return F.when(~broken, filled)


def template_name(reference: Column) -> Column:
    """Name a reference asks for; NULL where it is not a valid URI."""
    return F.try_parse_url(reference, F.lit("HOST"))


def filled(reference: Column, template: Column) -> Column:
    """The template with the parameters of the reference; NULL when the
    reference has to stay: no template, or a parameter that cannot be decoded."""
    bound = F.array(parameters(reference))
    return F.element_at(F.transform(bound, lambda pairs: _fill(template, pairs)), 1)


def resolve(reference: Column, templates: Mapping[str, str]) -> Column:
    """Filled template, or NULL when the reference has to stay as it is.

    That is so for an unknown name, a reference that is not a valid URI, or a
    parameter that cannot be decoded.
    """
    known = F.create_map(*[F.lit(x) for item in templates.items() for x in item])
    return filled(reference, F.try_element_at(known, template_name(reference)))


def expand(payload: Column, templates: Mapping[str, str]) -> Column:
    """Replace every resolvable reference, everywhere in the raw payload."""
    if not templates:
        return payload
    expanded = F.aggregate(
        find_templates(payload),
        payload,
        lambda text, reference: F.coalesce(
            F.replace(text, reference, resolve(reference, templates)), text
        ),
    )
    return F.when(payload.contains("template://"), expanded).otherwise(payload)


def put_back(payload: Column, found: Column) -> Column:
    """Replace references by their values, ``found`` of ``(pos, reference, value)`` in order; NULL values stay."""
    return F.aggregate(found, payload, lambda text, e: F.coalesce(F.replace(text, e["reference"], e["value"]), text))
