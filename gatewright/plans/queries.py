"""The registered queries: every operator over the given tables, whole."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import gatewright as g
from gatewright.functions import jsonpath, patterns, scorers, text
from gatewright.functions.similarity import cosine_to_rules
from gatewright.operators.match import schema_match
from gatewright.operators.stage import Stage
from gatewright.plans.correlate import mapping_table, with_mapping
from gatewright.session import configure, work_folder
from gatewright.sources.messages import (
    REQUEST_PATH,
    RESPONSE_PATH,
    chat_request,
    chat_response,
    conversation_messages,
    text_messages,
)
from gatewright.sources.providers import ask, embed, embed_rules, url_status
from gatewright.sources.tables import read_parquet
from gatewright.streaming.asking import Answers, Mappings, UrlStatuses, in_batches, latest
from gatewright.streaming.streams import (
    by_batch,
    drain,
    file_stream,
    keep_report,
    read_report,
    report_stream,
    restore_by_timers,
    restore_stream,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
NETWORK = r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"
PHONE = r"\([0-9]{3}\) [0-9]{3}-[0-9]{4}"
PII = (("EMAIL", EMAIL), ("NETWORK", NETWORK), ("PHONE", PHONE))
ONE_PII = (("EMAIL", EMAIL),)

SCHEMA = {
    "type": "object",
    "required": ["k"],
    "properties": {"k": {"type": "integer", "minimum": 10}, "v": {"type": "number"}},
}
TEMPLATES = [
    {"name": "quiz-card", "prompt": "Card [[no]], for [[level]] pupils: is this so? <[[claim]]> (end of card [[no]])"},
]
DENY_IDS, ALLOW_IDS = (0, 1, 2), (3, 4)
SIMILAR = 20
# Stands before every turn, so that the first message is not the last.
SYSTEM = "Stay with the topic."


def query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(configure(spark), folder)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{folder}/{name}.parquet")


def conversations(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_messages(table(spark, folder, "conversations"), system=SYSTEM)


def documents(spark: SparkSession, folder: str, direction: str = "REQUEST", *keep: str) -> DataFrame:
    return text_messages(table(spark, folder, "documents"), "doc_id", F.col("text"), direction, *keep)


def both_flows(policy: type, name: str, **options) -> list:
    """The same check on requests and on responses, each with its own path."""
    return [
        (policy(name=name, json_path=REQUEST_PATH, **options), "REQUEST"),
        (policy(name=name, json_path=RESPONSE_PATH, **options), "RESPONSE"),
    ]


def last_text(payload: Column, path: str = REQUEST_PATH) -> Column:
    return jsonpath.read(jsonpath.document(payload), path)


def report_field(name: str) -> Column:
    return F.get_json_object("outcome.error_message", f"$.{name}")


def verdicts(checked: DataFrame, *columns, details: bool = True) -> DataFrame:
    """Outcome as plain columns; the assessment by its JSON fields."""
    found = [
        F.col("outcome.passed").alias("passed"),
        F.col("outcome.error_code").alias("error_code"),
        F.col("outcome.error_type").alias("error_type"),
        F.col("outcome.http_sc").alias("http_sc"),
    ]
    if details:
        found.append(report_field("assessments").alias("assessments"))
    return checked.select(*columns, *found)


def guarded(spark, folder, policy: type, name: str, **options) -> DataFrame:
    chain = both_flows(policy, name, show_assessment=True, **options)
    return verdicts(g.run_chain(conversations(spark, folder), chain), "conv_id", "turn", "direction")


# --- payloads and JSON paths -------------------------------------------------


@query
def payload_build(spark, folder):
    return conversations(spark, folder)


@query
def jsonpath_last_message(spark, folder):
    stage = Stage(conversations(spark, folder))
    doc = stage.document()
    found = F.when(stage.way == "RESPONSE", jsonpath.read(doc, RESPONSE_PATH)).otherwise(
        jsonpath.read(doc, REQUEST_PATH)
    )
    return stage.df.select("conv_id", "turn", found.alias("content"))


@query
def jsonpath_set_last_message(spark, folder):
    stage = Stage(conversations(spark, folder).where("direction = 'REQUEST'"))
    content = stage.content(REQUEST_PATH, cleaned=False)
    changed = stage.keep(
        stage.with_text(REQUEST_PATH, F.concat(F.lit('<"checked">\n'), content))
    )
    doc = stage.keep(jsonpath.document(changed))
    return stage.df.select(
        "conv_id",
        "turn",
        jsonpath.read(doc, REQUEST_PATH).alias("content"),
        jsonpath.read(doc, "$.model").alias("model"),
        jsonpath.read(doc, "$.messages[-1].role").alias("role"),
        jsonpath.read(doc, "$.messages[0].content").alias("first"),
    )


@query
def word_count_whole_payload(spark, folder):
    return conversations(spark, folder).select(
        "conv_id", "turn", text.word_count(F.col("payload")).alias("words")
    )


# --- counts and patterns -------------------------------------------------------


def _on_documents(spark, folder, name, function):
    documents = table(spark, folder, "documents")
    return documents.select("doc_id", function(F.col("text")).alias(name))


@query
def word_count(spark, folder):
    return _on_documents(spark, folder, "words", text.word_count)


@query
def sentence_count(spark, folder):
    return _on_documents(spark, folder, "sentences", text.sentence_count)


@query
def content_length(spark, folder):
    return _on_documents(spark, folder, "bytes", text.byte_length)


@query
def regex_find(spark, folder):
    return _on_documents(spark, folder, "found", lambda c: patterns.regex_find(c, EMAIL))


# --- checks of counts and patterns ----------------------------------------------


@query
def guard_word_count(spark, folder):
    return guarded(spark, folder, g.WordCount, "words", min=10, max=60)


@query
def guard_word_count_invert(spark, folder):
    return guarded(spark, folder, g.WordCount, "words", min=10, max=60, invert=True)


@query
def guard_sentence_count(spark, folder):
    return guarded(spark, folder, g.SentenceCount, "sentences", min=2, max=6)


@query
def guard_content_length(spark, folder):
    return guarded(spark, folder, g.ContentLength, "bytes", min=20, max=500)


def _regex_guard(spark, folder, invert):
    policy = g.RegexMatch("pattern", REQUEST_PATH, regex=EMAIL, invert=invert, show_assessment=True)
    return verdicts(g.apply(documents(spark, folder), policy), F.col("msg_id").alias("doc_id"))


@query
def guard_regex(spark, folder):
    return _regex_guard(spark, folder, False)


@query
def guard_regex_invert(spark, folder):
    return _regex_guard(spark, folder, True)


@query
def fault_records(spark, folder):
    chain = both_flows(g.WordCount, "words", min=10, max=60)
    stopped = g.fault_records(g.run_chain(conversations(spark, folder), chain, detailed=False))
    return stopped.select(
        "conv_id", "turn", "msg_id", "direction", "payload",
        "error_code", "error_type", "http_sc", "error_message",
    )


@query
def assessment_json(spark, folder):
    chain = both_flows(g.SentenceCount, "sentences", min=2, max=6, show_assessment=True)
    stopped = g.violations(g.run_chain(conversations(spark, folder), chain))
    return stopped.select(
        "conv_id",
        "turn",
        *[
            report_field(name).alias(name)
            for name in ("action", "interveningGuardrail", "direction", "actionReason", "assessments")
        ],
    )


# --- personal data ------------------------------------------------------------


def masking(rules=PII, **options) -> g.PiiRegex:
    return g.PiiRegex("pii", REQUEST_PATH, pii_entities=rules, **options)


@query
def pii_mask(spark, folder):
    masked = g.apply(documents(spark, folder), masking(), flow="REQUEST")
    return masked.select(
        F.col("msg_id").alias("doc_id"),
        last_text(F.col("payload_out")).alias("masked"),
        F.coalesce(F.array_size("mapping"), F.lit(0)).alias("entries"),
    )


@query
def pii_mapping_table(spark, folder):
    masked = g.apply(documents(spark, folder), masking(), flow="REQUEST")
    return mapping_table(masked).select(
        F.col("msg_id").alias("doc_id"), F.inline("mapping").alias("ord", "original", "placeholder")
    )


@query
def pii_restore(spark, folder):
    """Requests are masked; each response repeats the masked text."""
    masked = g.apply(documents(spark, folder), masking(), flow="REQUEST")
    answers = masked.select(
        "msg_id",
        F.lit("RESPONSE").alias("direction"),
        chat_response(last_text(F.col("payload_out"))).alias("payload"),
    )
    policy = g.PiiRegex("pii", RESPONSE_PATH, pii_entities=PII)
    restored = g.apply(with_mapping(answers, mapping_table(masked)), policy, flow="RESPONSE")
    return restored.select(
        F.col("msg_id").alias("doc_id"),
        last_text(F.col("payload_out"), RESPONSE_PATH).alias("restored"),
    )


@query
def pii_redact(spark, folder):
    done = g.apply(documents(spark, folder), masking(redact=True))
    return done.select(
        F.col("msg_id").alias("doc_id"), last_text(F.col("payload_out")).alias("redacted")
    )


# --- URLs -------------------------------------------------------------------------


def page_text() -> Column:
    site = F.regexp_extract("url", r"^(https?://[^/]+)", 1)
    return F.concat(
        F.lit("Read <"), F.col("url"), F.lit("> or \""), F.col("url"), F.lit("\", then "), site,
        F.lit(", please."),
    )


def page_messages(spark, folder) -> DataFrame:
    return text_messages(table(spark, folder, "pages"), "page_id", page_text())


@query
def extract_urls(spark, folder):
    urls = patterns.extract_urls(page_text())
    return table(spark, folder, "pages").select("page_id", F.posexplode(urls).alias("pos", "url"))


def _url_rows(checked: DataFrame) -> DataFrame:
    return checked.select(
        F.col("msg_id").alias("page_id"),
        F.col("outcome.passed").alias("passed"),
        F.col("outcome.error_code").alias("error_code"),
        F.array_size(
            F.from_json(report_field("assessments.invalidUrls"), "array<string>")
        ).alias("invalid"),
        report_field("assessments.invalidUrls[0]").alias("first_invalid"),
    )


def page_status(spark, folder) -> DataFrame:
    pages = table(spark, folder, "pages").select(
        F.col("url"), F.concat("url", F.lit(">")).alias("marked"),
        F.regexp_extract("url", r"^(https?://[^/]+)", 1).alias("site"),
    )
    known = pages.select(F.explode(F.array("url", "marked", "site")).alias("url")).distinct()
    domain = F.regexp_extract("url", r"example\.([a-z]+)", 1)
    status = known.select(
        "url", F.when(domain == "com", 200).when(domain == "net", 301).otherwise(404).alias("status")
    )
    return status


@query
def guard_url_http(spark, folder):
    """Status of each page and of its site, by the top-level domain."""
    policy = g.UrlCheck("urls", REQUEST_PATH)
    inputs = g.Inputs(status=page_status(spark, folder))
    return _url_rows(g.apply(page_messages(spark, folder), policy, inputs))


@query
def guard_url_dns(spark, folder):
    hosts = table(spark, folder, "pages").select(
        F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("host")
    ).distinct()
    status = hosts.select(
        "host",
        F.when(F.col("host").endswith(".org"), 3).otherwise(0).alias("status"),
        F.when(F.col("host").endswith(".net"), 0).otherwise(2).alias("answers"),
    )
    policy = g.UrlCheck("urls", REQUEST_PATH, only_dns=True)
    return _url_rows(g.apply(page_messages(spark, folder), policy, g.Inputs(status=status)))


# --- similarity --------------------------------------------------------------------


def rule_vectors(spark, folder, ids) -> tuple[tuple[float, ...], ...]:
    """Vectors of the rule prompts. One row per id comes back, whatever the
    table holds, since rows of an id are merged first."""
    found = (
        table(spark, folder, "embeddings")
        .where(F.col("vec_id").isin(*ids))
        .groupBy("vec_id")
        .agg(F.min("embedding").alias("embedding"))
        .collect()
    )
    by_id = {r.vec_id: tuple(r.embedding) for r in found}
    return tuple(by_id[i] for i in ids)


def vector_messages(spark, folder) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    content = F.concat(F.lit("vector "), F.col("vec_id").cast("string"))
    return text_messages(vectors, "vec_id", content, "REQUEST", "embedding")


@query
def cosine_scores(spark, folder):
    rules = rule_vectors(spark, folder, DENY_IDS + ALLOW_IDS)
    scores = cosine_to_rules(F.col("embedding"), rules)
    scored = table(spark, folder, "embeddings").select(
        "vec_id", F.posexplode(scores).alias("rule", "score")
    )
    return scored.select(
        "vec_id", "rule", F.round("score", 6).alias("score")
    )


def _semantic(spark, folder, deny=(), allow=()):
    policy = g.SemanticGuard(
        "meaning", REQUEST_PATH,
        rules={"denyPrompts": [f"rule {i}" for i in deny], "allowPrompts": [f"rule {i}" for i in allow]},
        threshold=SIMILAR, vectors=rule_vectors(spark, folder, tuple(deny) + tuple(allow)),
        show_assessment=True,
    )
    checked = g.apply(vector_messages(spark, folder), policy)
    return checked.select(
        F.col("msg_id").alias("vec_id"),
        F.col("outcome.passed").alias("passed"),
        F.col("outcome.error_code").alias("error_code"),
        report_field("assessments.message").alias("message"),
        report_field("assessments.deniedRule").alias("denied_rule"),
    )


@query
def guard_semantic_deny(spark, folder):
    return _semantic(spark, folder, deny=DENY_IDS)


@query
def guard_semantic_allow(spark, folder):
    return _semantic(spark, folder, allow=ALLOW_IDS)


@query
def guard_semantic_hybrid(spark, folder):
    return _semantic(spark, folder, deny=DENY_IDS, allow=ALLOW_IDS)


@query
def guard_semantic_provider(spark, folder):
    """The embedding comes from a user function, called in the tasks."""

    def letter_vector(value: str) -> list[float]:
        """A small embedding: how often four letters occur."""
        return [float(value.count(letter)) for letter in "etin"]

    policy = embed_rules(
        g.SemanticGuard("meaning", REQUEST_PATH, rules={"denyPrompts": ["nine tin tents"]},
                        threshold=90),
        letter_vector,
    )
    messages = conversations(spark, folder).where("direction = 'REQUEST'")
    messages = messages.withColumn("content", last_text(F.col("payload")))
    messages = messages.withColumn("embedding", embed(letter_vector)(F.col("content")))
    return verdicts(g.apply(messages, policy), "conv_id", "turn", details=False)


# --- JSON Schema ----------------------------------------------------------------------


def event_text() -> Column:
    return F.concat(
        F.lit("Event "), F.col("event_type"), F.lit(": "), F.col("props"),
        F.lit(' and {"v": '), F.col("user_id").cast("string"), F.lit(', "k": "none"}.'),
    )


@query
def json_candidates(spark, folder):
    found = patterns.json_candidates(event_text())
    return table(spark, folder, "events").select(
        "event_id", F.posexplode(found).alias("pos", "candidate")
    )


@query
def json_schema_match(spark, folder):
    return table(spark, folder, "events").select(
        "event_id", schema_match(event_text(), g.JsonSchema("schema", schema=SCHEMA).schema).alias("valid")
    )


@query
def guard_json_schema(spark, folder):
    messages = text_messages(table(spark, folder, "events"), "event_id", event_text(), "RESPONSE")
    policy = g.JsonSchema("schema", RESPONSE_PATH, schema=SCHEMA, show_assessment=True)
    return verdicts(g.apply(messages, policy), F.col("msg_id").alias("event_id"))


# --- templates and decorations -------------------------------------------------------------


@query
def prompt_template(spark, folder):
    reference = F.concat(
        F.lit("Task: template://quiz-card?level=new&no="), F.length("text").cast("string"),
        F.lit("&claim="), F.url_encode("text"), F.lit(" now"),
    )
    messages = text_messages(table(spark, folder, "benchmark"), "item_id", reference)
    policy = g.TemplateExpansion("template", prompt_template_config=TEMPLATES)
    done = g.apply(messages, policy, flow="REQUEST")
    return done.select(F.col("msg_id").alias("item_id"), "payload_out")


@query
def prompt_decorate_string(spark, folder):
    policy = g.Decoration(
        "tone", REQUEST_PATH, prompt_decorator_config={"decoration": 'Answer "briefly".'}
    )
    done = g.apply(conversations(spark, folder), policy, flow="REQUEST")
    return done.where("direction = 'REQUEST'").select(
        "conv_id", "turn", last_text(F.col("payload_out")).alias("content")
    )


@query
def prompt_decorate_array(spark, folder):
    extra = [{"role": "system", "content": "Be kind."}, {"role": "system", "content": "Be brief."}]
    policy = g.Decoration("tone", prompt_decorator_config={"decoration": extra}, append=True)
    done = g.apply(conversations(spark, folder), policy, flow="REQUEST")
    stage = Stage(done.where("direction = 'REQUEST'"), payload="payload_out")
    doc = stage.document()
    return stage.df.select(
        "conv_id",
        "turn",
        jsonpath.read(doc, "$.messages[0].content").alias("first"),
        jsonpath.read(doc, "$.messages[-1].content").alias("last"),
        jsonpath.read(doc, "$.messages[-2].role").alias("role"),
        F.size(F.try_variant_get(doc, "$.messages", "array<variant>")).alias("messages"),
    )


# --- outside scorers ----------------------------------------------------------------------


@query
def moderation_request(spark, folder):
    stage = Stage(documents(spark, folder))
    content = stage.content(REQUEST_PATH, cleaned=True)
    levels = scorers.thresholds((2, -1, 4, 9))
    return stage.df.select(
        F.col("msg_id").alias("doc_id"), scorers.moderation_request(content, levels).alias("request")
    )


def moderation_answers(spark, folder) -> DataFrame:
    """Answers made from the labels; documents without one have no answer."""
    def row(category, severity):
        return F.struct(F.lit(category).alias("category"), severity.cast("int").alias("severity"))

    return table(spark, folder, "labels").select(
        F.col("doc_id").alias("msg_id"),
        F.to_json(F.struct(F.array(
            row("Hate", F.col("toxic") * 4), row("Violence", 1 - F.col("quality"))
        ).alias("categoriesAnalysis"))).alias("response"),
    )


@query
def moderation_verdict(spark, folder):
    policy = g.Moderation(
        "moderation", REQUEST_PATH, hate_category=2, violence_category=1, show_assessment=True
    )
    inputs = g.Inputs(responses=moderation_answers(spark, folder))
    checked = g.apply(documents(spark, folder), policy, inputs)
    return verdicts(checked, F.col("msg_id").alias("doc_id"), details=False).withColumn(
        "blocked", ~F.col("passed")
    )


@query
def moderation_assessment(spark, folder):
    policy = g.Moderation(
        "moderation", REQUEST_PATH, hate_category=2, violence_category=1, show_assessment=True
    )
    inputs = g.Inputs(responses=moderation_answers(spark, folder))
    stopped = g.violations(g.apply(documents(spark, folder), policy, inputs))
    return stopped.select(
        F.col("msg_id").alias("doc_id"),
        report_field("actionReason").alias("reason"),
        report_field("assessments.categories[0].result").alias("hate"),
        report_field("assessments.categories[1].result").alias("violence"),
        report_field("assessments.inspectedContent").alias("inspected"),
    )


@query
def bedrock_request(spark, folder):
    stage = Stage(documents(spark, folder))
    content = stage.content(REQUEST_PATH, cleaned=True)
    return stage.df.select(
        F.col("msg_id").alias("doc_id"), scorers.bedrock_request(content, stage.way).alias("request")
    )


def bedrock_answers(spark, folder) -> DataFrame:
    """Answers made from the documents: e-mail addresses are masked, documents
    with a phone number are blocked, the others pass."""
    content = F.col("text")
    found = table(spark, folder, "documents").select(
        F.col("doc_id").alias("msg_id"),
        "text",
        F.array_distinct(patterns.find_all(content, EMAIL)).alias("mails"),
        patterns.regex_find(content, PHONE).alias("blocked"),
    )
    entity = F.transform(
        "mails",
        lambda m: F.struct(
            F.lit("ANONYMIZED").alias("action"), m.alias("match"), F.lit("EMAIL").alias("type")
        ),
    )
    blocked, masked = F.col("blocked"), F.size("mails") > 0
    redacted = F.when(masked, F.regexp_replace(content, EMAIL, "{EMAIL}"))
    answer = F.struct(
        F.when(blocked | masked, scorers.INTERVENED).otherwise(scorers.NOT_INTERVENED).alias("action"),
        F.when(blocked, scorers.BLOCKED).when(masked, scorers.MASKED).alias("actionReason"),
        F.array(F.struct(redacted.alias("text"))).alias("output"),
        F.array(
            F.struct(
                F.struct(entity.alias("piiEntities")).alias("sensitiveInformationPolicy"),
                F.struct(F.lit(7).alias("latency")).alias("invocationMetrics"),
            )
        ).alias("assessments"),
    )
    return found.select("msg_id", F.to_json(answer).alias("response"))


def _bedrock(spark, folder, **options):
    policy = g.BedrockVerdict(
        "guard", REQUEST_PATH, region="local", guardrail_id="g1", guardrail_version="1", **options
    )
    inputs = g.Inputs(responses=bedrock_answers(spark, folder))
    return g.apply(documents(spark, folder), policy, inputs)


@query
def bedrock_block(spark, folder):
    checked = _bedrock(spark, folder, show_assessment=True)
    return checked.select(
        F.col("msg_id").alias("doc_id"),
        F.col("outcome.passed").alias("passed"),
        F.col("outcome.error_code").alias("error_code"),
        F.col("outcome.error_type").alias("error_type"),
        report_field("actionReason").alias("reason"),
        report_field("assessments.sensitiveInformationPolicy.piiEntities[0].match").alias("entity"),
        report_field("assessments.invocationMetrics").alias("metrics"),
    )


@query
def bedrock_mask(spark, folder):
    checked = _bedrock(spark, folder)
    return checked.select(
        F.col("msg_id").alias("doc_id"),
        F.col("outcome.passed").alias("passed"),
        last_text(F.col("payload_out")).alias("content"),
        F.coalesce(F.array_size("mapping"), F.lit(0)).alias("entries"),
    )


@query
def bedrock_redact(spark, folder):
    checked = _bedrock(spark, folder, redact_pii=True)
    return checked.select(
        F.col("msg_id").alias("doc_id"),
        F.col("outcome.passed").alias("passed"),
        last_text(F.col("payload_out")).alias("content"),
    )


# --- chains and reports --------------------------------------------------------------


CHAIN = (
    *both_flows(g.ContentLength, "bytes", min=20, max=1500),
    (g.RegexMatch("no-code", REQUEST_PATH, regex=r"(?i)ing the |[{}]", invert=True), "REQUEST"),
    (g.Decoration("tone", REQUEST_PATH, prompt_decorator_config={"decoration": "Be brief. Be kind."}),
     "REQUEST"),
    *both_flows(g.SentenceCount, "sentences", min=3, max=12),
    *both_flows(g.WordCount, "words", min=8, max=160),
)


def chained(spark, folder) -> DataFrame:
    return g.run_chain(conversations(spark, folder), CHAIN)


@query
def policy_chain(spark, folder):
    checked = chained(spark, folder)
    return verdicts(checked, "conv_id", "turn", "direction", "halted_by", details=False)


@query
def policy_report(spark, folder):
    return g.policy_report(chained(spark, folder), "halted_by")


# --- streams --------------------------------------------------------------------------------


def _drained(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    target = work_folder(spark, name)
    drain(stream, f"{target}/out", f"{target}/checkpoint")
    return spark.read.schema(stream.schema).parquet(f"{target}/out")


@query
def stream_policy_parity(spark, folder):
    """The chain on a file stream; the oracle is that of the batch query."""
    schema = table(spark, folder, "conversations").schema
    stream = file_stream(spark, f"{folder}/conversations.parquet", schema)
    stream = conversation_messages(stream, system=SYSTEM)
    checked = g.run_chain(stream, CHAIN)
    done = verdicts(checked, "conv_id", "turn", "direction", "halted_by", details=False)
    return _drained(spark, done, "stream-policy")


@query
def stream_pii_restore(spark, folder):
    """Masked requests and the answers that repeat them, as two streams.

    An answer comes five seconds after its request. The key is the row's place in
    its file, as ids may be null or repeat.
    """
    schema = table(spark, folder, "documents").schema
    policy = masking(ONE_PII)

    def arrivals(delay: int) -> DataFrame:
        read = file_stream(spark, f"{folder}/documents.parquet", schema)
        return read.select(
            F.concat_ws("#", "_metadata.file_path", "_metadata.row_index").alias("msg_id"),
            "doc_id",
            F.lit("REQUEST").alias("direction"),
            F.timestamp_seconds(F.lit(1_700_000_000 + delay)).alias("ts"),
            chat_request(F.col("text")).alias("payload"),
        )

    answers = g.apply(arrivals(5), policy, flow="REQUEST").select(
        "msg_id", "doc_id", F.lit("RESPONSE").alias("direction"), "ts", F.col("payload_out").alias("payload")
    )
    restored = restore_stream(arrivals(0), answers, policy, within="1 minute")
    done = restored.select("doc_id", last_text(F.col("payload_out")).alias("restored"))
    return _drained(spark, done, "stream-restore")


@query
def stream_guard_url(spark, folder):
    """The URL check on a stream of pages, micro-batch by micro-batch."""
    schema = table(spark, folder, "pages").schema
    status = page_status(spark, folder)
    policy = g.UrlCheck("urls", REQUEST_PATH)

    def step(pages: DataFrame) -> DataFrame:
        messages = text_messages(pages, "page_id", page_text())
        return _url_rows(g.apply(messages, policy, g.Inputs(status=status)))

    target = work_folder(spark, "stream-urls")
    by_batch(file_stream(spark, f"{folder}/pages.parquet", schema), step,
             f"{target}/out", f"{target}/checkpoint")
    return spark.read.parquet(f"{target}/out").drop("batch")


# --- more of the scored policies --------------------------------------------------------------


@query
def policy_chain_scored(spark, folder):
    """Decoration, then two scorers with answers of their own; the second is
    asked about the payload as it is by then."""

    def second(messages: DataFrame) -> DataFrame:
        content = last_text(F.col("payload"))
        blocked = content.startswith("Be brief. ") & patterns.regex_find(content, PHONE)
        action = F.when(blocked, scorers.INTERVENED).otherwise(scorers.NOT_INTERVENED)
        reason = F.when(blocked, scorers.BLOCKED)
        answer = F.struct(action.alias("action"), reason.alias("actionReason"))
        return messages.select("msg_id", F.to_json(answer).alias("response"))

    decoration = g.Decoration("tone", REQUEST_PATH, prompt_decorator_config={"decoration": "Be brief."})
    moderation = g.Moderation("moderation", REQUEST_PATH, hate_category=2, violence_category=7,
                              passthrough_on_error=True)
    verdict = g.BedrockVerdict("guard", REQUEST_PATH, region="local", guardrail_id="g1", guardrail_version="1")
    checked = g.run_chain(documents(spark, folder), [
        (decoration, "REQUEST"),
        (moderation, "REQUEST", g.Inputs(responses=moderation_answers(spark, folder))),
        (verdict, "REQUEST", g.Inputs(responses=second)),
    ])
    return checked.select(
        F.col("msg_id").alias("doc_id"), F.col("outcome.passed").alias("passed"), "halted_by",
        last_text(F.col("payload_out")).alias("content"),
    )


@query
def moderation_passthrough(spark, folder):
    """Documents the scorer has no answer for pass."""
    policy = g.Moderation("moderation", REQUEST_PATH, hate_category=2, violence_category=1,
                          passthrough_on_error=True)
    inputs = g.Inputs(responses=moderation_answers(spark, folder))
    checked = g.apply(documents(spark, folder), policy, inputs)
    return verdicts(checked, F.col("msg_id").alias("doc_id"), details=False)


@query
def moderation_provider(spark, folder):
    """The answers come from a user function that is called in the tasks."""

    def call_out(call: dict) -> str:
        asked = json.loads(call["request_payload"])
        severity = 4 if "###" in asked["text"] else 0
        return json.dumps({"categoriesAnalysis": [{"category": "Hate", "severity": severity}]})

    policy = g.Moderation("moderation", REQUEST_PATH, hate_category=2)
    messages = documents(spark, folder)
    inputs = g.Inputs(responses=ask(messages, policy, call_out))
    return verdicts(g.apply(messages, policy, inputs), F.col("msg_id").alias("doc_id"), details=False)


@query
def guard_url_provider(spark, folder):
    """The status table comes from a user function, asked once for each URL."""

    def head(url: str, limit: int) -> int | None:
        return 200 if "example.com" in url else 404

    policy = g.UrlCheck("urls", REQUEST_PATH)
    messages = page_messages(spark, folder)
    status = url_status(messages, policy, head)
    return _url_rows(g.apply(messages, policy, g.Inputs(status=status)))


@query
def jsonpath_set_keeps_numbers(spark, folder):
    """What is not rewritten stays as it was written, long numbers included."""
    long, fraction = "1234567890" * 4 + "12345", "0.123456789012345678901234567891"
    payload = F.concat(
        F.lit(f'{{"id":{long},"x":[{fraction},"1",null,true],"messages":[{{"content":"s","role":"system"}},'
              f'{{"n":{fraction},"content":'),
        jsonpath.quoted_text(F.col("text")), F.lit("}]}"))
    rows = table(spark, folder, "benchmark").select("item_id", "text", payload.alias("payload"))
    out = jsonpath.replace_text(F.col("payload"), jsonpath.document(F.col("payload")), REQUEST_PATH,
                                F.concat(F.lit("<"), F.col("text"), F.lit(">")))
    return rows.select("item_id", out.alias("payload_out"))


KEYWORD_SCHEMA = {
    "$schema": "http://json-schema.org/draft-07/schema#",
    "type": "object",
    "propertyNames": {"maxLength": 6},
    "dependencies": {"k": ["ip"]},
    "if": {"required": ["k"]},
    "then": {"properties": {"k": {"type": "integer", "minimum": 10}, "ip": {"format": "ipv4"}}},
    "else": {"properties": {"tags": {"type": "array", "contains": {"const": "x"}}}, "required": ["tags"]},
}


@query
def guard_json_schema_keywords(spark, folder):
    """Escaped JSON in the text, and the keywords of a draft-07 schema."""
    user = F.col("user_id")
    plain = F.concat(
        F.lit('{"k": '), user.cast("string"), F.when(user % 3 == 0, F.lit(', "ip": "10.0.0.7"')).otherwise(F.lit("")),
        F.lit('} or {"tags": ["y", "'), F.when(user % 5 == 0, F.lit("x")).otherwise(F.lit("z")), F.lit('"]}'))
    escaped = F.replace(plain, F.lit('"'), F.lit('\\"'))
    messages = text_messages(table(spark, folder, "events"), "event_id", escaped, "RESPONSE")
    policy = g.JsonSchema("schema", RESPONSE_PATH, schema=KEYWORD_SCHEMA)
    return verdicts(g.apply(messages, policy), F.col("msg_id").alias("event_id"), details=False)


@query
def bedrock_restore(spark, folder):
    """Requests masked by the scorer's findings; each response repeats the masked text."""
    masked = _bedrock(spark, folder)
    answers = masked.select(
        "msg_id", F.lit("RESPONSE").alias("direction"),
        chat_response(last_text(F.col("payload_out"))).alias("payload"))
    policy = g.BedrockVerdict(
        "guard", RESPONSE_PATH, region="local", guardrail_id="g1", guardrail_version="1")
    inputs = g.Inputs(responses=bedrock_answers(spark, folder))
    restored = g.apply(with_mapping(answers, mapping_table(masked)), policy, inputs)
    return restored.select(
        F.col("msg_id").alias("doc_id"), last_text(F.col("payload_out"), RESPONSE_PATH).alias("restored"))


@query
def bedrock_mask_regexes(spark, folder):
    """Findings under ``regexes``, which carry a name instead of a type."""
    found = table(spark, folder, "documents").select(
        F.col("doc_id").alias("msg_id"), F.array_distinct(patterns.find_all(F.col("text"), PHONE)).alias("phones"))
    entries = F.transform("phones", lambda m: F.struct(
        F.lit("ANONYMIZED").alias("action"), m.alias("match"), F.lit("CALL").alias("name")))
    hit = F.size("phones") > 0
    answer = F.struct(
        F.when(hit, scorers.INTERVENED).otherwise(scorers.NOT_INTERVENED).alias("action"),
        F.when(hit, scorers.MASKED).alias("actionReason"),
        F.array(F.struct(F.struct(entries.alias("regexes")).alias("sensitiveInformationPolicy"))).alias("assessments"))
    policy = g.BedrockVerdict(
        "guard", REQUEST_PATH, region="local", guardrail_id="g1", guardrail_version="1")
    inputs = g.Inputs(responses=found.select("msg_id", F.to_json(answer).alias("response")))
    checked = g.apply(documents(spark, folder), policy, inputs)
    return checked.select(
        F.col("msg_id").alias("doc_id"), last_text(F.col("payload_out")).alias("content"),
        F.coalesce(F.array_size("mapping"), F.lit(0)).alias("entries"))


@query
def policy_chain_asking(spark, folder):
    """Three steps that ask user functions, each about the payload as it is by then."""

    def severity(category: str, sign: str, level: int):
        def call_out(call: dict) -> str:
            found = sign in json.loads(call["request_payload"])["text"]
            return json.dumps({"categoriesAnalysis": [{"category": category, "severity": level if found else 0}]})

        return call_out

    def verdict(call: dict) -> str:
        text = json.loads(call["request_payload"])["content"][0]["text"]["text"]
        if text.startswith("Be brief. ") and re.search(PHONE, text):
            return json.dumps({"action": scorers.INTERVENED, "actionReason": scorers.BLOCKED})
        return json.dumps({"action": scorers.NOT_INTERVENED})

    first = g.Moderation("first", REQUEST_PATH, hate_category=2)
    tone = g.Decoration("tone", REQUEST_PATH, prompt_decorator_config={"decoration": "Be brief."})
    second = g.BedrockVerdict("second", REQUEST_PATH, region="local", guardrail_id="g1", guardrail_version="1")
    third = g.Moderation("third", REQUEST_PATH, violence_category=1)

    def asking(policy, call_out):
        return policy, "REQUEST", g.Inputs(responses=lambda messages: ask(messages, policy, call_out))

    checked = g.run_chain(documents(spark, folder), [
        asking(first, severity("Hate", "###", 4)), (tone, "REQUEST"), asking(second, verdict),
        asking(third, severity("Violence", "@", 1))])
    return checked.select(
        F.col("msg_id").alias("doc_id"), F.col("outcome.passed").alias("passed"), "halted_by",
        last_text(F.col("payload_out")).alias("content"))


# --- policy configuration as tables --------------------------------------------------------


def _semantic_table(spark, folder, mode: str, kind: Column, **options) -> DataFrame:
    """Every vector of the table is a rule, and every one a message."""
    rules = table(spark, folder, "embeddings").select(
        kind.alias("kind"), F.col("vec_id").alias("ord"),
        F.concat(F.lit("rule "), F.col("vec_id").cast("string")).alias("prompt"), "embedding")
    policy = g.SemanticGuard("meaning", REQUEST_PATH, table=mode, threshold=SIMILAR, show_assessment=True)
    checked = g.apply(vector_messages(spark, folder), policy, g.Inputs(rules=rules, **options))
    return checked.select(
        F.col("msg_id").alias("vec_id"), F.col("outcome.passed").alias("passed"),
        F.col("outcome.error_code").alias("error_code"), report_field("assessments.message").alias("message"),
        report_field("assessments.deniedRule").alias("denied_rule"))


@query
def guard_semantic_table(spark, folder):
    return _semantic_table(spark, folder, "DENY_ONLY", F.lit("DENY"))


@query
def guard_semantic_table_blocks(spark, folder):
    """Deny and allow rules, more of them than one pass compares."""
    kind = F.when(F.get("embedding", F.lit(0)) > 0.1, "DENY").otherwise("ALLOW")
    return _semantic_table(spark, folder, "HYBRID", kind, rule_block=1 << 13)


@query
def prompt_template_table(spark, folder):
    """A template for each customer, asked for by orders."""
    templates = table(spark, folder, "customer").select(
        F.concat(F.lit("c-"), F.col("c_custkey").cast("string")).alias("name"),
        F.concat("c_mktsegment", F.lit(" order [[[n]]] of [[who]]: [[n]]")).alias("prompt"))
    content = F.concat(
        F.lit("Take template://c-"), F.col("o_custkey").cast("string"), F.lit("?n="), F.col("o_orderkey").cast("string"),
        F.lit("&who="), F.col("o_orderstatus"), F.lit(", not template://nobody?x=1"))
    content = F.replace(content, F.lit(","), F.lit(" ,"))
    messages = text_messages(table(spark, folder, "orders"), "o_orderkey", content)
    done = g.apply(messages, g.TemplateExpansion("template"), g.Inputs(templates=templates), flow="REQUEST")
    return done.select(F.col("msg_id").alias("o_orderkey"),
                       F.replace(last_text(F.col("payload_out")), F.lit(" ,"), F.lit(",")).alias("content"))


# --- streams of several micro-batches --------------------------------------------------------


def _in_files(spark, folder: str, name: str, batches: int = 4) -> DataFrame:
    """A table as a stream of several micro-batches: its rows, dealt over files.

    A micro-batch has so many files that there are as many as the table has
    tasks, or more: files and tasks don't grow with the table.
    """
    target = work_folder(spark, f"stream-{name}")
    rows = table(spark, folder, name)
    files = max(1, math.ceil(rows.rdd.getNumPartitions() / batches))
    rows.repartition(batches * files, F.xxhash64(*rows.columns)).write.option("maxRecordsPerFile", 0).parquet(target)
    return file_stream(spark, target, rows.schema, files=files)


@query
def stream_scorer(spark, folder):
    """A scorer inside a stream: its answers are kept by batch, so that a restart asks nothing again."""

    def call_out(call: dict) -> str:
        severity = 4 if "###" in json.loads(call["request_payload"])["text"] else 0
        return json.dumps({"categoriesAnalysis": [{"category": "Hate", "severity": severity}]})

    policy = g.Moderation("moderation", REQUEST_PATH, hate_category=2)
    target = work_folder(spark, "stream-scorer")

    def step(batch: DataFrame, number: int) -> DataFrame:
        messages = text_messages(batch, "doc_id", F.col("text"))
        answers = Answers(f"{target}/answers", number)
        asked = answers("moderation", lambda m: ask(m, policy, call_out))
        checked = g.apply(messages, policy, g.Inputs(responses=asked))
        return verdicts(checked, F.col("msg_id").alias("doc_id"), details=False)

    in_batches(_in_files(spark, folder, "documents"), step, f"{target}/out", f"{target}/checkpoint")
    return spark.read.parquet(f"{target}/out").drop("batch")


def _url_stream(spark, folder, out) -> DataFrame:
    policy = g.UrlCheck("urls", REQUEST_PATH)
    target = work_folder(spark, "stream-url-status")

    def check(urls: DataFrame) -> DataFrame:
        return urls.select("url", F.when(F.col("url").contains("example.com"), 200).otherwise(404).alias("status"))

    statuses = UrlStatuses(spark, f"{target}/status", check, expiry=3600)

    def step(pages: DataFrame, number: int) -> DataFrame:
        messages = text_messages(pages, "page_id", page_text())
        known = statuses.of(messages, last_text(F.col("payload")), number, now=number)
        return _url_rows(g.apply(messages, policy, g.Inputs(status=known)))

    in_batches(_in_files(spark, folder, "pages"), step, f"{target}/out", f"{target}/checkpoint")
    return out(statuses, target)


@query
def stream_url_status(spark, folder):
    """URLs of a stream, checked by statuses that earlier batches have asked for."""
    return _url_stream(spark, folder, lambda _, target: spark.read.parquet(f"{target}/out").drop("batch"))


@query
def stream_url_asked(spark, folder):
    """How often each URL of the stream was asked."""
    return _url_stream(spark, folder, lambda statuses, _: statuses.table.rows().groupBy("url").agg(
        F.count("*").alias("asked")))


@query
def stream_pii_restore_timers(spark, folder):
    """As ``stream_pii_restore``, with timers instead of a join."""
    schema = table(spark, folder, "documents").schema
    policy = masking(ONE_PII)

    def arrivals(delay: int) -> DataFrame:
        read = file_stream(spark, f"{folder}/documents.parquet", schema)
        return read.select(
            F.concat_ws("#", "_metadata.file_path", "_metadata.row_index", "doc_id").alias("msg_id"),
            F.lit("REQUEST").alias("direction"),
            F.timestamp_seconds(F.lit(1_700_000_000 + delay)).alias("ts"),
            chat_request(F.col("text")).alias("payload"),
        )

    answers = g.apply(arrivals(5), policy, flow="REQUEST").select(
        "msg_id", F.lit("RESPONSE").alias("direction"), "ts", F.col("payload_out").alias("payload"))
    restored = restore_by_timers(arrivals(0), answers, policy, within_seconds=60)
    number = F.split("msg_id", "#")
    done = restored.select(F.when(F.size(number) > 2, F.element_at(number, -1).cast("long")).alias("doc_id"),
                           last_text(F.col("payload_out")).alias("restored"))
    return _drained(spark, done, "stream-timers")


@query
def stream_policy_report(spark, folder):
    """The report of the chain by windows of event time; a turn is a minute."""
    stream = conversation_messages(_in_files(spark, folder, "conversations"), system=SYSTEM)
    stream = stream.withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_100) + 60 * F.coalesce("turn", F.lit(0))))
    report = report_stream(g.run_chain(stream, CHAIN), "halted_by", window="2 minutes", late="1 day")
    target = work_folder(spark, "stream-report")
    keep_report(report, f"{target}/table", f"{target}/checkpoint")
    kept = read_report(spark, f"{target}/table", report.schema)
    return kept.withColumn("window_start", F.unix_timestamp("window_start"))


@query
def stream_pii_mapping(spark, folder):
    """The mappings of a stream's masked requests, kept in a table by batch."""
    target = work_folder(spark, "stream-mapping")
    kept = Mappings(spark, f"{target}/mappings", "msg_id long", expiry=3600, merge=2)

    def step(batch: DataFrame, number: int) -> DataFrame:
        messages = text_messages(batch, "doc_id", F.col("text"))
        return kept.add(g.apply(messages, masking(), flow="REQUEST"), number, now=number)

    in_batches(_in_files(spark, folder, "documents"), step, f"{target}/out", f"{target}/checkpoint")
    return kept.current().select(F.col("msg_id").alias("doc_id"), F.inline("mapping").alias("ord", "original", "placeholder"))
