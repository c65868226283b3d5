"""Undoing Java string escapes in one left-to-right pass."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One token per escape; a run of \uXXXX stays together so that surrogate pairs
# decode as one character.
_TOKEN = (
    r"(?s)(?:\\u+\+?[0-9a-fA-F]{4})+"
    r"|\\[0-3][0-7]{2}|\\[0-7]{1,2}"
    r"|\\.|\\|[^\\]++"
)

# Fixed meanings of the one-letter escapes; any other letter stands for itself.
_LETTERS = {r"\b": "\b", r"\n": "\n", r"\t": "\t", r"\f": "\f", r"\r": "\r"}


def _token(token: Column) -> Column:
    value = F.when(~token.startswith("\\"), token)
    # A \u that the first alternative did not take is malformed: no value.
    value = value.when(
        token.startswith("\\u"),
        F.when(
            token.rlike(r"^\\u+\+?[0-9a-fA-F]{4}"),
            F.decode(F.unhex(F.regexp_replace(token, r"\\u+\+?", "")), "UTF-16BE"),
        ),
    )
    value = value.when(
        token.rlike(r"^\\[0-7]"),
        F.char(F.conv(F.substring(token, 2, 3), 8, 10).cast("int")),
    )
    for escape, char in _LETTERS.items():
        value = value.when(token == escape, F.lit(char))
    return value.otherwise(F.substr(token, F.lit(2)))


def unescape_java(text: Column) -> Column:
    """NULL for a malformed unicode escape."""
    tokens = F.transform(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), _token)
    whole = F.when(F.forall(tokens, lambda t: t.isNotNull()), F.array_join(tokens, ""))
    return F.when(text.contains("\\"), whole).otherwise(text)
