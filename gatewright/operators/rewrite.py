"""Template expansion and decoration of requests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gatewright import outcome as oc
from gatewright.config import Decoration, TemplateExpansion
from gatewright.functions import jsonpath, templates
from gatewright.functions.decorate import decorate_array, decorate_string
from gatewright.operators.stage import Inputs, Stage, Verdict


def expand_templates(stage: Stage, policy: TemplateExpansion, inputs: Inputs) -> Verdict:
    """Works on the raw payload text; values are put in without escaping."""
    if inputs.templates is not None:
        return Verdict(oc.passed(), stage.gate(_from_table(stage, policy, inputs)))
    return Verdict(oc.passed(), stage.gate(templates.expand(stage.text, policy.templates)))


def _from_table(stage: Stage, policy: TemplateExpansion, inputs: Inputs) -> Column:
    """Payload with the references of a template table filled in.

    Only keys and references of the messages that hold one move: exploded, they
    meet their templates by name, one row for each name (of several prompts the
    smallest), and are filled. A group then holds the references of one message,
    and the list belongs to the key, so that messages with one id stay apart.
    The plan is the same for any number of templates; AQE splits a name that
    many messages share.
    """
    if policy.templates:
        raise ValueError("templates come with the policy or as a table, not both")
    if stage.df.isStreaming:
        raise ValueError(
            "references of a message meet their templates per micro-batch on a stream: see streaming.asking"
        )
    refs = stage.keep(stage.gate(F.when(stage.text.contains("template://"), templates.find_templates(stage.text))))
    messages, name = stage.df, stage.reserve()
    keys = tuple(dict.fromkeys((*inputs.keys, stage.direction)))
    renamed = [f"{name}_k{i}" for i in range(len(keys))] + [f"{name}_refs"]
    has = F.coalesce(F.size(refs) > 0, F.lit(False))
    rest = messages.where(~has).withColumn(name, stage.text)
    messages = messages.where(has)
    columns = [messages[k].alias(n) for k, n in zip(keys, renamed)]
    asked = messages.select(*columns, refs.alias(renamed[-1])).distinct().select(
        *renamed, F.posexplode(renamed[-1]).alias("pos", "reference"))
    asked = asked.withColumn("name", templates.template_name(F.col("reference")))
    known = inputs.templates.where("name is not null and prompt is not null").groupBy("name").agg(
        F.min("prompt").alias("prompt"))
    found = asked.join(known, "name").select(
        *renamed, F.struct("pos", "reference", templates.filled(F.col("reference"), F.col("prompt")).alias("value")).alias("e"))
    found = found.groupBy(*renamed).agg(F.array_sort(F.collect_list("e")).alias(f"{name}_found"))
    same = refs == F.col(renamed[-1])
    for key, other in zip(keys, renamed):
        same = same & messages[key].eqNullSafe(F.col(other))
    out = F.coalesce(templates.put_back(stage.text, F.col(f"{name}_found")), stage.text)
    expanded = messages.join(found, same, "left").withColumn(name, out).drop(*renamed, f"{name}_found")
    stage.df = expanded.unionByName(rest)
    return F.col(name)


def decorate(stage: Stage, policy: Decoration, inputs: Inputs) -> Verdict:
    steps = jsonpath.parse(policy.json_path)
    place = stage.keep(jsonpath.lookup(stage.document(), steps))
    if isinstance(policy.decoration, str):
        # A JSON null reads as the text "null"; a missing path is an error.
        existing = F.coalesce(
            jsonpath.as_text(place), F.when(F.is_variant_null(place), "null")
        )
        joined = decorate_string(existing, policy.decoration, policy.append)
        value = F.when(existing.isNotNull(), jsonpath.quoted_text(joined))
    else:
        is_array = F.try_variant_get(place, "$", "array<variant>").isNotNull()
        whole = jsonpath.ALL in steps
        raw = F.to_json(place) if whole else jsonpath.raw_at(stage.text, policy.json_path)
        value = F.when(is_array, decorate_array(raw, policy.decoration, policy.append))
    value = stage.keep(value)
    changed = jsonpath.replace(stage.text, stage.document(), policy.json_path, value)
    payload = F.when(value.isNotNull(), changed).otherwise(stage.text)
    failed = ~stage.empty & value.isNull()
    return Verdict(F.when(failed, oc.internal_error(policy)).otherwise(oc.passed()), payload)
