"""Validity of the URLs in a message, looked up in a status table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewright.config import UrlCheck
from gatewright.functions import patterns
from gatewright.operators.stage import Inputs, Stage, Verdict


def valid_entries(status: DataFrame, only_dns: bool) -> DataFrame:
    """Valid URLs (of ``url``, ``status``) or hosts (of ``host``, ``status``,
    ``answers``) as one column ``entry``. Whatever is not listed is invalid."""
    if only_dns:
        valid = (F.col("status") == 0) & (F.col("answers") > 0)
        entry = F.lower("host")  # names have no case
    else:
        valid = (F.col("status") >= 200) & (F.col("status") < 400)
        entry = F.col("url")
    return status.where(valid & entry.isNotNull()).select(entry.alias("entry"))


def distinct_urls(messages: DataFrame, text: Column) -> DataFrame:
    """Every URL once over the whole table, ready for a checker.

    ``distinct`` combines before its shuffle, so a URL that is everywhere costs
    no more than one row per task.
    """
    return messages.select(F.explode(patterns.extract_urls(text)).alias("url")).distinct()


def _entry(url: Column, only_dns: bool) -> Column:
    return patterns.url_host(url) if only_dns else url


def with_invalid(
    messages: DataFrame, text: Column, urls: Column, valid: DataFrame, only_dns: bool,
    keys: tuple[str, ...], name: str,
) -> DataFrame:
    """``messages`` with ``name``, the URLs that are not valid; null if all are.

    One plan for status tables of any size. Only keys and URLs of messages that
    may hold one go through the lookup, an anti join that Spark broadcasts or
    sorts and merges by size; AQE splits an entry that many messages share. What
    remains is grouped by message: a group holds the URLs of one message. The
    list itself belongs to the key, so messages that share an id stay apart.
    All other messages stay where they are.
    """
    renamed = [f"{name}_k{i}" for i in range(len(keys))] + [f"{name}_urls"]
    # Seen on the raw text, so that nothing is parsed for it; ``\u`` may hide a letter.
    possible = F.coalesce(text.contains("http") | text.contains("\\u"), F.lit(False))
    rest = messages.where(~possible).withColumn(name, F.lit(None).cast("array<string>"))
    messages = messages.where(possible)
    columns = [messages[k].alias(n) for k, n in zip(keys, renamed)]
    # The outer form keeps Catalyst from adding a size filter below, which would
    # extract the URLs a second time.
    pairs = (
        messages.select(*columns, urls.alias(renamed[-1]))
        .select(*renamed, F.posexplode_outer(renamed[-1]).alias("pos", "url"))
        .where("url is not null")
        .withColumn("entry", _entry(F.col("url"), only_dns))
    )
    unknown = pairs.join(valid, "entry", "left_anti")
    found = F.array_sort(F.collect_set(F.struct("pos", "url")))
    bad = unknown.groupBy(*renamed).agg(F.transform(found, lambda e: e["url"]).alias(name))
    same = urls == F.col(renamed[-1])
    for key, other in zip(keys, renamed):
        same = same & messages[key].eqNullSafe(F.col(other))
    return messages.join(bad, same, "left").drop(*renamed).unionByName(rest)


def check_urls(stage: Stage, policy: UrlCheck, inputs: Inputs) -> Verdict:
    """Blocks when at least one URL is not known as valid."""
    if inputs.status is None:
        raise ValueError("a URL policy needs a status table")
    if stage.df.isStreaming:
        raise ValueError(
            "a URL policy groups the URLs of a message, which a stream does per "
            "micro-batch: see streaming.streams.by_batch"
        )
    content = stage.content(policy.json_path, cleaned=False)
    urls = stage.keep(stage.gate(F.when(~stage.empty, patterns.extract_urls(content))))
    known = stage.keep(content.isNotNull())
    valid = valid_entries(inputs.status, policy.only_dns)
    name = stage.reserve()
    keys = tuple(dict.fromkeys((*inputs.keys, stage.direction)))
    stage.df = with_invalid(stage.df, stage.text, urls, valid, policy.only_dns, keys, name)
    invalid = F.col(name)
    bad = F.coalesce(F.size(invalid), F.lit(0)) > 0
    passed = F.when(stage.empty, True).otherwise(F.when(known, ~bad))
    details = F.struct(
        F.lit("One or more URLs in the payload failed validation.").alias("message"),
        invalid.alias("invalidUrls"),
    )
    return Verdict(
        stage.decide(policy, passed, details if policy.show_assessment else None)
    )
