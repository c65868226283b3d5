"""Text cleaning and counting, all inside code generation.

The counts are written as one ``regexp_count`` each: a match starts at the
first character that survives trimming and runs to the end of its piece, so a
piece made only of blanks and control characters is never counted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns of the reference behaviour.
OUTER_QUOTES = '^"|"$'
WORD = r"[^\x00-\x20]\S*+"
SENTENCE = r"[^\x00-\x20.!?][^.!?]*+"

# What Java's String.trim removes: every character up to the blank.
TRIMMED = "".join(chr(code) for code in range(0x21))


def _quoted(text: Column) -> Column:
    # Java's "$" also stands before a final line break, hence three characters.
    return text.startswith('"') | F.right(text, F.lit(3)).contains('"')


def _padded(text: Column) -> Column:
    return (F.left(text, F.lit(1)) <= " ") | (F.right(text, F.lit(1)) <= " ")


def strip_quotes(text: Column) -> Column:
    """Drop one quote at either end; the pattern runs only where one may be."""
    return F.when(_quoted(text), F.regexp_replace(text, OUTER_QUOTES, "")).otherwise(text)


def java_trim(text: Column) -> Column:
    """Trim every character up to U+0020, not only blanks."""
    return F.when(_padded(text), F.btrim(text, F.lit(TRIMMED))).otherwise(text)


def clean(text: Column) -> Column:
    """Quotes off, then trimmed; most texts need neither."""
    full = F.btrim(F.regexp_replace(text, OUTER_QUOTES, ""), F.lit(TRIMMED))
    return F.when(_quoted(text) | _padded(text), full).otherwise(text)


def word_count(text: Column) -> Column:
    return F.regexp_count(strip_quotes(text), F.lit(WORD))


def sentence_count(text: Column) -> Column:
    return F.regexp_count(strip_quotes(text), F.lit(SENTENCE))


def byte_length(text: Column) -> Column:
    """Length in UTF-8 bytes."""
    return F.octet_length(text)
