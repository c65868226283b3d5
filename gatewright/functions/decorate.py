"""Decorations put before or behind a text or an array."""

from __future__ import annotations

import json

from pyspark.sql import Column
from pyspark.sql import functions as F


def decorate_string(existing: Column, decoration: str, append: bool) -> Column:
    parts = [existing, F.lit(decoration)] if append else [F.lit(decoration), existing]
    return F.concat_ws(" ", *parts)


def decorate_array(existing: Column, decoration: list, append: bool) -> Column:
    """``existing`` is the JSON text of an array; its elements stay as they are written."""
    inner = F.regexp_replace(existing, r"^\s*\[\s*|\s*\]\s*$", "")
    extra = json.dumps(decoration, ensure_ascii=False, separators=(",", ":"))[1:-1]
    if not extra:
        return existing
    parts = [inner, F.lit(extra)] if append else [F.lit(extra), inner]
    joined = F.concat_ws(",", *[F.when(p != "", p) for p in parts])
    return F.when(existing.isNotNull(), F.concat(F.lit("["), joined, F.lit("]")))
