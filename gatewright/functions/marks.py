"""Punctuation that a pattern cannot do without.

Most texts hold none of the personal data a pattern looks for. A search for one
needed character is far cheaper than the pattern itself, so it is tried first.
"""

from __future__ import annotations

from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _skip_class(pattern: str, at: int) -> int:
    """Position behind a character class; Java allows nested ones."""
    depth = 0
    while at < len(pattern):
        char = pattern[at]
        if char == "\\":
            at += 1
        elif char == "[":
            depth += 1
        elif char == "]":
            depth -= 1
            if depth == 0:
                return at + 1
        at += 1
    raise ValueError("open class")


def _skip_group(pattern: str, at: int) -> int:
    depth = 0
    while at < len(pattern):
        char = pattern[at]
        if char == "\\":
            at += 1
        elif char == "[":
            at = _skip_class(pattern, at) - 1
        elif char == "(":
            depth += 1
        elif char == ")":
            depth -= 1
            if depth == 0:
                return at + 1
        at += 1
    raise ValueError("open group")


@lru_cache(maxsize=256)
def required_marks(pattern: str) -> tuple[str, ...]:
    """Punctuation characters that are part of every match.

    Only plain characters outside of groups and classes count. The answer is
    empty whenever the pattern holds anything that could change their meaning:
    alternatives, flags, quoting, or unusual classes.
    """
    if any(part in pattern for part in ("\\Q", "\\E", "[]", "[^]", "&&")):
        return ()
    found: list[str] = []
    at = 0
    try:
        while at < len(pattern):
            char, literal = pattern[at], None
            if char == "|":
                return ()
            if char == "(":
                if pattern.startswith("(?", at) and not pattern.startswith("(?:", at):
                    return ()
                at = _skip_group(pattern, at)
            elif char == "[":
                at = _skip_class(pattern, at)
            elif char == "\\":
                literal = pattern[at + 1]
                if literal.isalnum():
                    # \d and the like; others take arguments of their own.
                    if literal not in "dDsSwWbBtnrf":
                        return ()
                    literal = None
                at += 2
            else:
                literal = None if char in "^$." else char
                at += 1
            optional = at < len(pattern) and (
                pattern[at] in "?*" or pattern.startswith("{0", at)
            )
            while at < len(pattern) and pattern[at] in "?*+{":
                at = pattern.index("}", at) + 1 if pattern[at] == "{" else at + 1
            if literal and not optional and literal.isascii() and not literal.isalnum():
                if literal.isprintable() and literal not in found:
                    found.append(literal)
    except (ValueError, IndexError):
        return ()
    return tuple(found)


def may_match(text: Column, pattern: str) -> Column | None:
    """False where ``pattern`` cannot match; None when nothing can be said."""
    marks = required_marks(pattern)
    if not marks:
        return None
    return reduce(lambda a, b: a & b, [F.contains(text, F.lit(mark)) for mark in marks])
