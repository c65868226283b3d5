"""Pattern search and the masking of personal data."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from gatewright.functions.marks import may_match

# Fixed patterns and marks of the reference behaviour.
URL = r"""https?://[^\s,"'{}\[\]\\`]+"""
OBJECT = r"(?s)\{.*?\}"
REDACTED = "*****"

MAPPING = "array<struct<ord:int,original:string,placeholder:string>>"


_CHECKED: set[tuple[str, bool]] = set()


def check_regex(spark: SparkSession, pattern: str, *, consuming: bool = False) -> None:
    """Refuse a bad Java pattern while the query is being built.

    With ``consuming`` a pattern that matches the empty text is refused too.
    """
    if (pattern, consuming) in _CHECKED:
        return
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:
        return
    try:
        empty = jvm.java.util.regex.Pattern.compile(pattern).matcher("").find()
    except Exception as error:
        raise ValueError(f"invalid regular expression: {pattern!r}") from error
    if consuming and empty:
        raise ValueError(f"pattern matches the empty text: {pattern!r}")
    _CHECKED.add((pattern, consuming))


def regex_find(text: Column, pattern: str) -> Column:
    possible = may_match(text, pattern)
    found = text.rlike(pattern)
    return found if possible is None else possible & found


def find_all(text: Column, pattern: str) -> Column:
    """All matches; an empty array where there are none."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    possible = may_match(text, pattern)
    if possible is None:
        return found
    return F.when(text.isNull() | possible, found).otherwise(F.array().cast("array<string>"))


def extract_urls(text: Column) -> Column:
    """Distinct URLs in the order of their first appearance."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(URL), F.lit(0)))


# A URL authority: optional user part, host, optional port of digits.
_HOST = r"^https?://(?:[^/?#@]*@)?([^/?#@:]+)(?::[0-9]*)?(?=[/?#]|$)"


def url_host(url: Column) -> Column:
    """Host in lower case; empty where the authority is malformed."""
    return F.lower(F.regexp_extract(url, _HOST, 1))


def json_candidates(text: Column) -> Column:
    """Shortest ``{...}`` pieces; a nested object ends at its first ``}``."""
    return F.regexp_extract_all(text, F.lit(OBJECT), F.lit(0))


def placeholder(prefix: Column | str, number: Column) -> Column:
    """``PREFIX_hhhh`` with at least four hexadecimal digits."""
    head = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.format_string("%s_%04x", head, number)


def empty_mapping() -> Column:
    return F.array().cast(MAPPING)


def new_entries(matches: Column, known: Column, entity: str) -> Column:
    """Mapping entries for texts that no earlier rule has seen."""
    fresh = F.array_except(
        F.array_distinct(matches), F.transform(known, lambda e: e["original"])
    )
    return F.transform(
        fresh,
        lambda text, i: F.struct(
            (F.size(known) + i).cast("int").alias("ord"),
            text.alias("original"),
            placeholder(entity, F.size(known) + i).alias("placeholder"),
        ),
    )


def _placeholder_of(known: Column, match: Column) -> Column:
    """Placeholder of a text by halving, in ``known``: entries sorted by ``original``."""
    last = F.size(known) - 1
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.size(known), F.lit(1)).cast("double"))).cast("int"))

    def halve(state: Column, _: Column) -> Column:
        middle = F.shiftright(state["lo"] + state["hi"], 1)
        before = F.get(known, middle)["original"] < match
        return F.struct(F.when(before, middle + 1).otherwise(state["lo"]).alias("lo"),
                        F.when(before, state["hi"]).otherwise(middle).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), last.alias("hi"))
    found = F.aggregate(steps, start, halve, lambda state: F.get(known, state["lo"]))
    return F.when(found["original"] == match, found["placeholder"])


def put_placeholders(text: Column, pattern: str, matches: Column, mapping: Column) -> Column:
    """Rebuild ``text`` from the pieces between matches and their placeholders.

    The mapping is sorted once per text and searched by halving, so that many
    matches cost no more than the logarithm of their number each.
    """
    pieces = F.split(text, pattern, -1)
    known = F.array_sort(F.transform(
        mapping, lambda e: F.struct(e["original"].alias("original"), e["placeholder"].alias("placeholder"))))

    def joined(columns: Column) -> Column:
        return F.array_join(
            F.zip_with(
                columns["pieces"],
                columns["matches"],
                lambda piece, match: F.concat(
                    piece, F.coalesce(_placeholder_of(columns["known"], match), F.lit(""))
                ),
            ),
            "",
        )

    bound = F.array(
        F.struct(
            pieces.alias("pieces"),
            matches.alias("matches"),
            known.alias("known"),
        )
    )
    rebuilt = F.element_at(F.transform(bound, joined), 1)
    return F.when(F.size(matches) == 0, text).otherwise(rebuilt)


def restore(text: Column, mapping: Column) -> Column:
    """Put the originals back, entry by entry in the order of the mapping."""
    return F.aggregate(
        mapping, text, lambda done, e: F.replace(done, e["placeholder"], e["original"])
    )


def redact_rule(text: Column, pattern: str) -> Column:
    done = F.regexp_replace(text, pattern, REDACTED)
    possible = may_match(text, pattern)
    return done if possible is None else F.when(possible, done).otherwise(text)


def mask_found(text: Column, found: Column) -> tuple[Column, Column]:
    """Mask the texts an outside scorer found.

    ``found`` is an array of ``(match, label)``; the first entry for a text
    wins and numbers run over distinct texts. Returns text and mapping.
    """
    # Entries sorted by text and place: those that differ from the one before are
    # the first of their text. Sorting back by place keeps it all below n log n.
    placed = F.array_sort(F.transform(found, lambda e, i: F.struct(e["match"].alias("match"), i.alias("i"),
                                                                   e["label"].alias("label"))))
    none = F.array(F.lit(None).cast("struct<match:string,i:int,label:string>"))
    before = F.slice(F.concat(none, placed), 1, F.size(placed))
    firsts = F.zip_with(placed, before, lambda e, b: F.when(
        b.isNull() | ~e["match"].eqNullSafe(b["match"]),
        F.struct(e["i"].alias("i"), e["match"].alias("match"), e["label"].alias("label"))))
    first = F.array_sort(F.filter(firsts, lambda e: e.isNotNull()))
    mapping = F.transform(
        first,
        lambda e, i: F.struct(
            i.cast("int").alias("ord"),
            e["match"].alias("original"),
            placeholder(e["label"], i).alias("placeholder"),
        ),
    )
    masked = F.aggregate(
        mapping, text, lambda done, e: F.replace(done, e["original"], e["placeholder"])
    )
    return masked, mapping
