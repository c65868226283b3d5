"""Quality rules whose cutoffs come with a guarantee.

A base filter looks at fixed limits. Beyond it, each rule rejects documents
whose share of something (symbols, repeated lines, ...) is over a cutoff. For
each stratum, cutoffs are chosen on labelled documents such that, with
probability ``1 - delta`` over all strata and rules together, no stratum loses
more than ``risk`` of its good documents to the rules.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gatewright.llm.common import BLANKS, WORD, once
from gatewright.session import stored

SYMBOLS = r"[#*$%&|<>]"
# Fixed values of the base filter.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Most that the rules may take from the good documents of a stratum, and the
# probability that this fails anywhere.
RISK = 0.02
DELTA = 0.05
# Cutoffs of each rule's share, from lenient to strict.
GRID = tuple(round(0.95 * 0.8 ** k, 6) for k in range(24))
RULES = ("symbol_share", "dup_line_share", "repeat_share", "shout_share")


def measured(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``__q``, the measures of the row's text; see ``features``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.btrim(text, F.lit(" \t\n\x0b\f\r"))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANKS))
    df = once(docs, __words=words)
    # windows of three words, sorted with their places: equal ones are neighbours
    n = F.size("__words")
    windows = F.when(n >= 3, F.zip_with(
        F.zip_with(F.slice("__words", 1, F.greatest(n - 2, F.lit(0))), F.slice("__words", 2, F.greatest(n - 2, F.lit(0))),
                   lambda a, b: F.concat_ws(" ", a, b)),
        F.slice("__words", 3, F.greatest(n - 2, F.lit(0))), lambda ab, c: F.concat_ws(" ", ab, c)))
    windows = F.coalesce(windows, F.array().cast("array<string>"))
    df = once(df, __sorted=F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i")))))
    none = F.array(F.lit(None).cast("struct<w:string,i:int>"))
    before = F.concat(none, F.col("__sorted"))
    after = F.concat(F.slice("__sorted", 2, F.greatest(F.size("__sorted"), F.lit(1))), none)
    twice = F.zip_with(
        F.zip_with("__sorted", F.slice(before, 1, F.size("__sorted")),
                   lambda x, y: F.struct(x.w.alias("w"), x.i.alias("i"), F.coalesce(x.w == y.w, F.lit(False)).alias("hit"))),
        F.slice(after, 1, F.size("__sorted")),
        lambda x, y: F.when(x.hit | F.coalesce(x.w == y.w, F.lit(False)), x.i))
    places = F.sort_array(F.filter(twice, lambda i: i.isNotNull()))
    start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    repeats = F.aggregate(places, start, lambda acc, i: F.struct(
        (i + 3).alias("end"), (acc.n + (i + 3 - F.greatest(acc.end, i)).cast("long")).alias("n")), lambda acc: acc.n)
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    df = once(df, __lines=F.struct(F.size(lines).cast("long").alias("n_lines"),
                                   F.size(F.array_distinct(lines)).cast("long").alias("distinct_lines"),
                                   repeats.alias("n_repeat_words")))
    count = n.cast("long")
    least = F.greatest(count, F.lit(1)).cast("double")
    q = F.struct(
        count.alias("n_words"),
        F.char_length(F.regexp_replace(text, BLANKS, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.col("__lines.n_lines") - F.col("__lines.distinct_lines")).alias("n_dup_lines"),
        F.col("__lines.n_repeat_words").alias("n_repeat_words"),
        F.col("__lines.n_lines").alias("n_lines"),
        (F.regexp_count(text, F.lit("!")) / least).alias("shout_share"))
    return once(df, __q=q).drop("__words", "__sorted", "__lines")


def shares(q: str = "__q") -> dict[str, Column]:
    """The rules' shares of a measured row."""
    words = F.greatest(F.col(f"{q}.n_words"), F.lit(1)).cast("double")
    return {
        "symbol_share": F.col(f"{q}.n_symbols") / words,
        "dup_line_share": F.col(f"{q}.n_dup_lines") / F.greatest(F.col(f"{q}.n_lines"), F.lit(1)).cast("double"),
        "repeat_share": F.col(f"{q}.n_repeat_words") / words,
        "shout_share": F.col(f"{q}.shout_share"),
    }


def base_failed(q: str = "__q") -> Column:
    return (F.col(f"{q}.n_words") < MIN_WORDS) | (
        100 * F.col(f"{q}.n_repeat_words") > MAX_REPEAT_PERCENT * F.col(f"{q}.n_words"))


def features(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
             stratum_col: str | None = "lang") -> DataFrame:
    """``doc_id``, ``stratum``, the base measures, ``base_failed`` and the shares of every row.

    Null texts have no words; nothing is cut, whatever the length; repeated
    rows stay repeated; a null stratum is the stratum of the empty name.
    """
    stratum = F.coalesce(F.col(stratum_col).cast("string"), F.lit("")) if stratum_col else F.lit("")
    rows = docs.select(F.col(id_col).alias("doc_id"), stratum.alias("stratum"), F.col(text_col).alias("text"))
    q = measured(rows)
    return q.select("doc_id", "stratum", *[f"__q.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed().alias("base_failed"), *[c.alias(name) for name, c in shares().items()])


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Bin(n, p), exact up to rounding: terms are summed by their logarithms."""
    odds = math.log(p / (1 - p))
    first = n * math.log(1 - p)
    start = F.struct(first.alias("term"), first.alias("total"))
    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>"))

    def add(acc, i):
        term = acc.term + F.log((n - i + 1) / i.cast("double")) + odds
        high = F.greatest(acc.total, term)
        return F.struct(term.alias("term"), (high + F.log(F.exp(acc.total - high) + F.exp(term - high))).alias("total"))

    return F.exp(F.aggregate(steps, start, add, lambda acc: acc.total))


def certified_cutoffs(measures: DataFrame, labels: DataFrame, *, risk: float = RISK, delta: float = DELTA,
                      label_col: str = "quality") -> DataFrame:
    """``stratum`` and one cutoff for each rule (null: the rule is off there).

    ``risk`` is dealt evenly to the rules, which bounds their union. A cutoff is
    certified if so few good documents are over it that a true rate above the
    rule's share of the risk would show so few with at most ``delta`` divided by
    the number of strata and rules (Bonferroni): the exact binomial bound.
    Cutoffs are tested from lenient to strict until the first that fails, so
    that no further correction is needed. Of the certified ones that is taken
    that parts bad from good documents best.

    The bound asks for independent trials, so that each labelled id is one in
    its stratum, however many rows repeat it: over a cutoff if one of them is.
    Null labels are left out; of contradicting labels the better counts.
    Without labels all rules are off.
    """
    each = len(RULES)
    known = labels.where(F.col(label_col).isNotNull()).groupBy("doc_id").agg(F.max(label_col).alias("good"))
    rows = measures.where("not base_failed").join(known, "doc_id").groupBy("stratum", "doc_id").agg(
        F.max("good").alias("good"), *[F.max(r).alias(r) for r in RULES])
    good = F.col("good") == 1
    counts = rows.groupBy("stratum").agg(
        F.sum(good.cast("long")).alias("n_good"), F.sum((~good).cast("long")).alias("n_bad"),
        *[F.sum(((F.col(r) > c) & g).cast("long")).alias(f"{r}_{i}_{side}")
          for r in RULES for i, c in enumerate(GRID) for side, g in (("good", good), ("bad", ~good))])
    counts = counts.withColumn("strata", F.count("*").over(W.partitionBy(F.lit(1))))
    tests = counts.select("stratum", "n_good", "n_bad", "strata", F.inline(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.lit(i).alias("step"), F.lit(c).alias("cutoff"),
                 F.col(f"{r}_{i}_good").alias("good_over"), F.col(f"{r}_{i}_bad").alias("bad_over"))
        for r in RULES for i, c in enumerate(GRID)])))
    rate = risk / each
    tail = F.when(F.col("good_over") < F.col("n_good") * rate,
                  binomial_tail(F.col("good_over"), F.col("n_good"), rate)).otherwise(1.0)
    tests = tests.withColumn("failed", (tail > F.lit(delta) / (each * F.col("strata"))).cast("int"))
    so_far = W.partitionBy("stratum", "rule").orderBy("step")
    passed = tests.withColumn("failures", F.sum("failed").over(so_far)).where("failures = 0")
    gain = F.col("bad_over") / F.greatest(F.col("n_bad"), F.lit(1)) - F.col("good_over") / F.greatest(F.col("n_good"), F.lit(1))
    best = passed.where(gain > 0).groupBy("stratum", "rule").agg(
        F.max(F.struct(gain.alias("gain"), F.col("cutoff"))).alias("best"))
    return best.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == r, F.col("best.cutoff"))).alias(f"max_{r}") for r in RULES])


def rejected() -> Column:
    over = [F.coalesce(F.col(r) > F.col(f"max_{r}"), F.lit(False)) for r in RULES]
    out = over[0]
    for o in over[1:]:
        out = out | o
    return out


def judge(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The features of every row with ``kept``. Features are computed once and
    written, since both the cutoffs and the verdicts are made of them."""
    measures = stored(features(docs), "quality-features")
    cutoffs = stored(certified_cutoffs(measures, labels, **options), "cutoffs")
    return measures.join(cutoffs, "stratum", "left").withColumn("kept", ~(F.col("base_failed") | rejected()))


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge(docs, labels).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                      "n_repeat_words", "base_failed", "kept")


def filter_documents(docs: DataFrame, labels: DataFrame, *, stratum_col: str | None = "lang", **options) -> DataFrame:
    """``docs`` without the rows that the rules reject, all columns as they are.

    The measures are written once, beside the rows they belong to, since both
    the cutoffs and the verdicts are made of them. Nulls, long texts, repeated
    rows and empty tables as in ``features``.
    """
    stratum = F.coalesce(F.col(stratum_col).cast("string"), F.lit("")) if stratum_col else F.lit("")
    rows = measured(docs.withColumn("__stratum", stratum))
    rows = stored(rows.select(*docs.columns, "__stratum", base_failed().alias("__failed"), F.struct(
        *[c.alias(name) for name, c in shares().items()]).alias("__share")), "quality-measured")
    measures = rows.select("doc_id", F.col("__stratum").alias("stratum"), F.col("__failed").alias("base_failed"),
                           "__share.*")
    cutoffs = stored(certified_cutoffs(measures, labels, **options), "cutoffs")
    cutoffs = cutoffs.select(F.col("stratum").alias("__stratum"), F.struct(
        *[F.col(f"max_{r}").alias(r) for r in RULES]).alias("__max"))
    over = F.lit(False)
    for r in RULES:
        over = over | F.coalesce(F.col(f"__share.{r}") > F.col(f"__max.{r}"), F.lit(False))
    return rows.join(cutoffs, "__stratum", "left").where(~(F.col("__failed") | over)).select(*docs.columns)


def _over(side: str) -> str:
    return ", ".join(f"count(*) FILTER (WHERE {r} > {c!r} AND good = {side}) AS {r}_{i}_{side}"
                     for r in RULES for i, c in enumerate(GRID))


_SQL_TESTS = ", ".join(
    f"{{'rule': '{r}', 'step': {i}, 'cutoff': CAST({c!r} AS DOUBLE), 'good_over': {r}_{i}_true, 'bad_over': {r}_{i}_false}}"
    for r in RULES for i, c in enumerate(GRID))
_SQL_RATE = RISK / len(RULES)

OP10_SQL = rf"""
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM t)),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM twice) GROUP BY doc_id),
m AS (
  SELECT doc_id, stratum, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines,
         coalesce(repeats.n, 0) AS n_repeat_words, len(regexp_extract_all(text, '!')) AS n_shouts
  FROM t LEFT JOIN repeats USING (doc_id)),
f AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
         n_symbols / CAST(greatest(n_words, 1) AS DOUBLE) AS symbol_share,
         n_dup_lines / CAST(greatest(n_lines, 1) AS DOUBLE) AS dup_line_share,
         n_repeat_words / CAST(greatest(n_words, 1) AS DOUBLE) AS repeat_share,
         n_shouts / CAST(greatest(n_words, 1) AS DOUBLE) AS shout_share FROM m),
known AS (
  SELECT doc_id, max(quality) = 1 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
counts AS (
  SELECT stratum, count(*) FILTER (WHERE good) AS n_good, count(*) FILTER (WHERE NOT good) AS n_bad,
         {_over('true')}, {_over('false')}
  FROM (SELECT stratum, doc_id, any_value(good) AS good, {', '.join(f'max({r}) AS {r}' for r in RULES)}
        FROM f JOIN known USING (doc_id) WHERE NOT base_failed GROUP BY stratum, doc_id)
  GROUP BY stratum),
tests AS (
  SELECT stratum, n_good, n_bad, strata, unnest([{_SQL_TESTS}], recursive := true)
  FROM (SELECT *, count(*) OVER () AS strata FROM counts)),
tails AS (
  SELECT *, CASE WHEN good_over < n_good * {_SQL_RATE!r} THEN
    list_sum(list_transform(range(0, good_over + 1), lambda i: exp(
      lgamma(n_good + 1) - lgamma(i + 1) - lgamma(n_good - i + 1) + i * ln({_SQL_RATE!r})
      + (n_good - i) * ln(1 - {_SQL_RATE!r})))) ELSE 1 END AS tail FROM tests),
passed AS (
  SELECT *, bad_over / greatest(n_bad, 1) - good_over / greatest(n_good, 1) AS gain FROM tails
  QUALIFY sum(CAST(tail > {DELTA!r} / ({len(RULES)} * strata) AS INTEGER)) OVER (
    PARTITION BY stratum, rule ORDER BY step) = 0),
best AS (
  SELECT stratum, rule, max({{'gain': gain, 'cutoff': cutoff}}).cutoff AS cutoff
  FROM passed WHERE gain > 0 GROUP BY stratum, rule),
cuts AS (
  SELECT stratum, {', '.join(f"max(cutoff) FILTER (WHERE rule = '{r}') AS max_{r}" for r in RULES)}
  FROM best GROUP BY stratum)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR {' OR '.join(f'coalesce({r} > max_{r}, false)' for r in RULES)}) AS kept
FROM f LEFT JOIN cuts USING (stratum)
"""
