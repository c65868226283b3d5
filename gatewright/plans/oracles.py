"""The same queries as SQL over the same tables, for the cross-check.

They are written from the rules, not from the engine: texts are taken from the
tables directly and the policies are spelled out as CASE expressions.
"""

from __future__ import annotations

from gatewright.plans.queries import ALLOW_IDS, DENY_IDS, EMAIL, NETWORK, ONE_PII, PHONE, PII, SIMILAR, SYSTEM

BLANKS = r"[ \t\n\x0B\f\r]+"


def clean(value: str) -> str:
    unquoted = rf"""regexp_replace({value}, '^"|"$', '', 'g')"""
    return rf"regexp_replace({unquoted}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"


def pieces(value: str, pattern: str) -> str:
    trimmed = r"regexp_replace(p, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"
    return (
        f"len(list_filter(regexp_split_to_array({clean(value)}, '{pattern}'), "
        f"lambda p: {trimmed} <> ''))"
    )


def words(value: str) -> str:
    return pieces(value, BLANKS)


def sentences(value: str) -> str:
    return pieces(value, "[.!?]")


def size(value: str) -> str:
    return f"octet_length(encode({value}))"


REQUEST = (
    "CAST(to_json({{'model': 'chat-model', 'messages': [{{'role': 'system', 'content': '{system}'}}, "
    "{{'role': {role}, 'content': {text}}}]}}) AS VARCHAR)"
)
RESPONSE = "CAST(to_json({{'choices': [{{'message': {{'role': 'assistant', 'content': {text}}}}}]}}) AS VARCHAR)"


def request(text: str, role: str = "'user'") -> str:
    return REQUEST.format(role=role, text=text, system=SYSTEM)


def response(text: str) -> str:
    return RESPONSE.format(text=text)


MESSAGES = f"""messages AS (
  SELECT conv_id, turn, role, text,
         concat(conv_id, ':', CASE WHEN role = 'assistant' THEN turn - 1 ELSE turn END) AS msg_id,
         CASE WHEN role = 'assistant' THEN 'RESPONSE' ELSE 'REQUEST' END AS direction,
         CASE WHEN role = 'assistant' THEN {response('text')} ELSE {request('text', 'role')} END AS payload
  FROM conversations)"""


def verdict(passed: str, kind: str, details: str | None) -> str:
    columns = f"""{passed} AS passed,
  CASE WHEN NOT {passed} THEN 900514 END AS error_code,
  CASE WHEN NOT {passed} THEN '{kind}' END AS error_type,
  CASE WHEN NOT {passed} THEN 446 END AS http_sc"""
    if details is not None:
        columns += f",\n  CASE WHEN NOT {passed} THEN {details} END AS assessments"
    return columns


def count_guard(count: str, passed: str, kind: str, details: str) -> str:
    return f"""WITH {MESSAGES}, counted AS (SELECT *, {count} AS n FROM messages)
SELECT conv_id, turn, direction, {verdict(passed, kind, details)} FROM counted"""


WORD_DETAILS = "'Violation of word count detected. Expected {0} words. But found ' || n || ' words.'"
SENTENCE_DETAILS = (
    "'Violation of sentence count detected: expected between 2 and 6 sentences. But found ' "
    "|| n || ' sentences.'"
)
CLEANED = clean("text")


def masked(rules, source: str) -> str:
    """CTEs that apply the masking rules one after another to ``t``."""
    parts = [
        f"step0 AS (SELECT id, t, CAST([] AS VARCHAR[]) AS originals, "
        f"CAST([] AS VARCHAR[]) AS marks FROM ({source}))"
    ]
    for i, (entity, pattern) in enumerate(rules):
        parts.append(f"""found{i} AS (
  SELECT *, regexp_extract_all(t, '{pattern}') AS m FROM step{i}),
fresh{i} AS (
  SELECT *, list_filter(m, lambda x, i: list_position(m, x) = i
                                    AND NOT list_contains(originals, x)) AS f FROM found{i}),
known{i} AS (
  SELECT id, t, m, list_concat(originals, f) AS originals,
         list_concat(marks, list_transform(f, lambda x, i:
           '{entity}_' || printf('%04x', len(originals) + i - 1))) AS marks FROM fresh{i}),
step{i + 1} AS (
  SELECT id, originals, marks,
         CASE WHEN len(m) = 0 THEN t ELSE
         array_to_string(list_transform(list_zip(regexp_split_to_array(t, '{pattern}'), m),
           lambda z: z[1] || CASE WHEN z[2] IS NULL THEN ''
                             ELSE marks[list_position(originals, z[2])] END), '') END AS t
  FROM known{i})""")
    parts.append(f"masked AS (SELECT * FROM step{len(rules)})")
    return ",\n".join(parts)


CLEAN_DOCUMENTS = f"SELECT doc_id AS id, {CLEANED} AS t FROM documents"
HAS_PII = " OR ".join(f"regexp_matches({CLEANED}, '{pattern}')" for _, pattern in PII)

SITE = "regexp_extract(url, '^(https?://[^/]+)', 1)"
PAGE_TEXT = f"""'Read <' || url || '> or "' || url || '", then ' || {SITE} || ', please.'"""
URL = r"""https?://[^\s,"''{}\[\]\\`]+"""
PAGE_URLS = f"""found AS (
  SELECT page_id, regexp_extract_all({PAGE_TEXT}, '{URL}') AS m FROM pages),
urls AS (
  SELECT page_id, list_filter(m, lambda x, i: list_position(m, x) = i) AS u FROM found),
listed AS (
  SELECT page_id, unnest(u) AS url, unnest(range(len(u))) AS pos FROM urls)"""


def url_guard(valid: str) -> str:
    return f"""WITH {PAGE_URLS},
bad AS (SELECT page_id, count(*) AS invalid, arg_min(url, pos) AS first_invalid
        FROM listed WHERE NOT ({valid}) GROUP BY page_id)
SELECT p.page_id, bad.invalid IS NULL AS passed,
  CASE WHEN bad.invalid IS NOT NULL THEN 900514 END AS error_code,
  CAST(bad.invalid AS INTEGER) AS invalid, bad.first_invalid
FROM pages p LEFT JOIN bad USING (page_id)"""


RULES = f"""rules AS (
  SELECT vec_id AS rule_id, min(CAST(embedding AS DOUBLE[])) AS rule FROM embeddings
  WHERE vec_id IN {DENY_IDS + ALLOW_IDS} GROUP BY vec_id)"""


def semantic(deny, allow) -> str:
    mode = "true" if not allow else "false"
    message = "One or more semantic rules are violated." if not allow else (
        "None of the allowed prompts are met.")
    denied = "'rule ' || first_rule" if not allow else "CAST(NULL AS VARCHAR)"
    return f"""WITH {RULES}, hits AS (
  SELECT v.vec_id, min(r.rule_id) AS first_rule
  FROM embeddings v, rules r
  WHERE r.rule_id IN ({', '.join(map(str, tuple(deny) + tuple(allow)))})
    AND list_cosine_similarity(CAST(v.embedding AS DOUBLE[]), r.rule) * 100 >= {SIMILAR}
  GROUP BY v.vec_id),
decided AS (
  SELECT e.vec_id, first_rule,
         CASE WHEN first_rule IS NULL THEN {mode}
              ELSE first_rule IN ({', '.join(map(str, allow)) or 'NULL'}) IS TRUE END AS passed
  FROM embeddings e LEFT JOIN hits USING (vec_id))
SELECT vec_id, passed, CASE WHEN NOT passed THEN 900514 END AS error_code,
  CASE WHEN NOT passed THEN '{message}' END AS message,
  CASE WHEN NOT passed THEN {denied} END AS denied_rule
FROM decided"""


def semantic_table(allow: str, hybrid: bool) -> str:
    message = "None of the allowed prompts are met." if hybrid else "One or more semantic rules are violated."
    return f"""WITH hits AS (
  SELECT v.vec_id, arg_min(r.vec_id, struct_pack(a := {allow}, i := r.vec_id)) AS rule,
         arg_min({allow}, struct_pack(a := {allow}, i := r.vec_id)) AS allowed
  FROM embeddings v, embeddings r
  WHERE list_cosine_similarity(CAST(v.embedding AS DOUBLE[]), CAST(r.embedding AS DOUBLE[])) * 100 >= {SIMILAR}
  GROUP BY v.vec_id),
decided AS (
  SELECT e.vec_id, rule, coalesce(allowed, {'false' if hybrid else 'true'}) AS passed
  FROM embeddings e LEFT JOIN hits USING (vec_id))
SELECT vec_id, passed, CASE WHEN NOT passed THEN 900514 END AS error_code,
  CASE WHEN NOT passed THEN '{message}' END AS message,
  {"CAST(NULL AS VARCHAR)" if hybrid else "CASE WHEN NOT passed THEN 'rule ' || rule END"} AS denied_rule
FROM decided"""


EVENT_TEXT = """'Event ' || event_type || ': ' || props || ' and {"v": ' || user_id || ', "k": "none"}.'"""
CANDIDATES = rf"regexp_extract_all({EVENT_TEXT}, '(?s)\{{.*?\}}')"


def valid_candidate(c: str) -> str:
    return (
        f"(json_valid({c}) AND json_type({c}, '$.k') IN ('UBIGINT', 'BIGINT') "
        f"AND TRY_CAST(json_extract_string({c}, '$.k') AS BIGINT) >= 10)"
    )


SCHEMA_VALID = f"len(list_filter({CANDIDATES}, lambda c: {valid_candidate('c')})) > 0"

TEMPLATE_TEXT = "replace(split_part(text, '&', 1), '+', ' ')"

LABELLED = f"""scored AS (
  SELECT d.doc_id, {CLEANED} AS content, l.doc_id IS NOT NULL AS answered,
         l.toxic * 4 AS hate, 1 - l.quality AS violence
  FROM documents d LEFT JOIN labels l USING (doc_id)),
decided AS (
  SELECT *, answered AND hate < 2 AND violence < 1 AS passed FROM scored)"""

BEDROCK = f"""answered AS (
  SELECT doc_id, text, {CLEANED} AS content, regexp_matches(text, '{PHONE}') AS blocked,
         regexp_matches(text, '{EMAIL}') AS has_mail,
         regexp_extract_all(text, '{EMAIL}') AS mails FROM documents)"""

# Mails are replaced text by text, each wherever it occurs.
BEDROCK_MASK = f"""WITH RECURSIVE {BEDROCK},
listed AS (
  SELECT *, list_filter(mails, lambda x, i: list_position(mails, x) = i) AS u,
         has_mail AND NOT blocked AS masking FROM answered),
steps AS (
  SELECT doc_id, 0 AS i, content AS t, u FROM listed WHERE masking
  UNION ALL
  SELECT doc_id, i + 1, replace(t, u[i + 1], 'EMAIL_' || printf('%04x', i)), u
  FROM steps WHERE i < len(u)),
done AS (SELECT doc_id, t, i FROM steps WHERE i = len(u))
SELECT l.doc_id, NOT l.blocked AS passed, coalesce(done.t, l.text) AS content,
       CAST(coalesce(done.i, 0) AS INTEGER) AS entries
FROM listed l LEFT JOIN done USING (doc_id)"""

CHAINED = f"""{MESSAGES},
first AS (
  SELECT *, {size(CLEANED)} BETWEEN 20 AND 1500 AS ok_size,
         NOT regexp_matches({CLEANED}, '(?i)ing the |[{{}}]') OR direction = 'RESPONSE' AS ok_code,
         CASE WHEN direction = 'REQUEST' THEN 'Be brief. Be kind. ' || text ELSE text END AS changed
  FROM messages),
second AS (
  SELECT *, {sentences('changed')} BETWEEN 3 AND 12 AS ok_sentences,
         {words('changed')} BETWEEN 8 AND 160 AS ok_words FROM first),
decided AS (
  SELECT *, CASE WHEN NOT ok_size THEN 'bytes' WHEN NOT ok_code THEN 'no-code'
                 WHEN NOT ok_sentences THEN 'sentences' WHEN NOT ok_words THEN 'words' END AS halted_by
  FROM second),
chained AS (
  SELECT conv_id, turn, direction, halted_by, payload, halted_by IS NULL AS passed,
         CASE WHEN halted_by IS NOT NULL THEN 900514 END AS error_code,
         CASE halted_by WHEN 'bytes' THEN 'CONTENT_LENGTH_GUARDRAIL' WHEN 'no-code' THEN 'REGEX_GUARDRAIL'
           WHEN 'sentences' THEN 'SENTENCE_COUNT_GUARDRAIL' WHEN 'words' THEN 'WORD_COUNT_GUARDRAIL'
         END AS error_type,
         CASE WHEN halted_by IS NOT NULL THEN 446 END AS http_sc
  FROM decided)"""
CHAIN_ROWS = (
    f"WITH {CHAINED} SELECT conv_id, turn, direction, halted_by, passed, error_code, error_type, "
    "http_sc FROM chained"
)


def letters(value: str) -> str:
    return "[" + ", ".join(
        f"CAST(length({value}) - length(replace({value}, '{c}', '')) AS DOUBLE)" for c in "etin"
    ) + "]"


ORACLES: dict[str, str] = {
    "payload_build": f"WITH {MESSAGES} SELECT conv_id, turn, msg_id, direction, payload FROM messages",
    "jsonpath_last_message": f"""WITH {MESSAGES} SELECT conv_id, turn,
  json_extract_string(payload, CASE WHEN direction = 'RESPONSE' THEN '$.choices[0].message.content'
                               ELSE '$.messages[#-1].content' END) AS content FROM messages""",
    "jsonpath_set_last_message": f"""SELECT conv_id, turn,
  '<"checked">' || chr(10) || text AS content, 'chat-model' AS model, role, '{SYSTEM}' AS first
FROM conversations WHERE role <> 'assistant'""",
    "word_count_whole_payload":
        f"WITH {MESSAGES} SELECT conv_id, turn, CAST({words('payload')} AS INTEGER) AS words FROM messages",
    "word_count": f"SELECT doc_id, CAST({words('text')} AS INTEGER) AS words FROM documents",
    "sentence_count": f"SELECT doc_id, CAST({sentences('text')} AS INTEGER) AS sentences FROM documents",
    "content_length": f"SELECT doc_id, CAST({size('text')} AS INTEGER) AS bytes FROM documents",
    "regex_find": f"SELECT doc_id, regexp_matches(text, '{EMAIL}') AS found FROM documents",
    "guard_word_count": count_guard(
        words("text"), "(n BETWEEN 10 AND 60)", "WORD_COUNT_GUARDRAIL",
        WORD_DETAILS.format("between 10 and 60")),
    "guard_word_count_invert": count_guard(
        words("text"), "(n NOT BETWEEN 10 AND 60)", "WORD_COUNT_GUARDRAIL",
        WORD_DETAILS.format("less than 10 or more than 60")),
    "guard_sentence_count": count_guard(
        sentences("text"), "(n BETWEEN 2 AND 6)", "SENTENCE_COUNT_GUARDRAIL", SENTENCE_DETAILS),
    "guard_content_length": count_guard(
        size(CLEANED), "(n BETWEEN 20 AND 500)", "CONTENT_LENGTH_GUARDRAIL",
        "'Expected between 20 and 500 bytes. But found ' || n || '.'"),
    "guard_regex": f"""WITH found AS (SELECT doc_id, regexp_matches({CLEANED}, '{EMAIL}') AS hit FROM documents)
SELECT doc_id, {verdict('hit', 'REGEX_GUARDRAIL', f"'Violated regular expression: {EMAIL}'")} FROM found""",
    "guard_regex_invert": f"""WITH found AS (SELECT doc_id, regexp_matches({CLEANED}, '{EMAIL}') AS hit FROM documents)
SELECT doc_id, {verdict('(NOT hit)', 'REGEX_GUARDRAIL', f"'Violated regular expression: {EMAIL}'")} FROM found""",
    "fault_records": f"""WITH {MESSAGES}, counted AS (SELECT *, {words('text')} AS n FROM messages)
SELECT conv_id, turn, msg_id, direction, payload, 900514 AS error_code,
  'WORD_COUNT_GUARDRAIL' AS error_type, 446 AS http_sc, 'Violation of words detected.' AS error_message
FROM counted WHERE n NOT BETWEEN 10 AND 60""",
    "assessment_json": f"""WITH {MESSAGES}, counted AS (SELECT *, {sentences('text')} AS n FROM messages)
SELECT conv_id, turn, 'GUARDRAIL_INTERVENED' AS action, 'sentences' AS "interveningGuardrail", direction,
  'Violation of applied sentence count constraints detected.' AS "actionReason",
  {SENTENCE_DETAILS} AS assessments FROM counted WHERE n NOT BETWEEN 2 AND 6""",
    "pii_mask": f"""WITH {masked(PII, CLEAN_DOCUMENTS)}
SELECT d.doc_id, CASE WHEN len(originals) > 0 THEN t ELSE text END AS masked,
  CAST(len(originals) AS INTEGER) AS entries FROM masked m JOIN documents d ON m.id = d.doc_id""",
    "pii_mapping_table": f"""WITH {masked(PII, CLEAN_DOCUMENTS)}
SELECT id AS doc_id, CAST(unnest(range(len(originals))) AS INTEGER) AS ord,
  unnest(originals) AS original, unnest(marks) AS placeholder FROM masked""",
    "pii_restore": f"""SELECT doc_id, CASE WHEN {HAS_PII} THEN {CLEANED} ELSE text END AS restored
FROM documents""",
    "pii_redact": "SELECT doc_id, CASE WHEN {0} THEN {1} ELSE text END AS redacted FROM documents".format(
        HAS_PII,
        f"regexp_replace(regexp_replace(regexp_replace({CLEANED}, '{EMAIL}', '*****', 'g'), "
        f"'{NETWORK}', '*****', 'g'), '{PHONE}', '*****', 'g')"),
    "extract_urls": f"WITH {PAGE_URLS} SELECT page_id, CAST(pos AS INTEGER) AS pos, url FROM listed",
    "guard_url_http": url_guard("regexp_matches(url, 'example[.](com|net)')"),
    "guard_url_dns": url_guard("regexp_matches(url, 'example[.]com')"),
    "cosine_scores": f"""WITH {RULES}
SELECT vec_id, CAST(rule_id AS INTEGER) AS rule,
  round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), rule), 6) AS score
FROM embeddings, rules""",
    "guard_semantic_deny": semantic(DENY_IDS, ()),
    "guard_semantic_allow": semantic((), ALLOW_IDS),
    "guard_semantic_hybrid": semantic(DENY_IDS, ALLOW_IDS),
    "guard_semantic_provider": f"""WITH {MESSAGES}, scored AS (
  SELECT conv_id, turn, CASE WHEN {clean('text')} = '' THEN false
    WHEN list_sum({letters('text')}) = 0 THEN false
    ELSE list_cosine_similarity({letters('text')}, {letters("'nine tin tents'")}) * 100 >= 90 END AS hit
  FROM messages WHERE direction = 'REQUEST')
SELECT conv_id, turn, {verdict('(NOT hit)', 'SEMANTIC_PROMPT_GUARD', None)} FROM scored""",
    "json_candidates": f"""WITH found AS (SELECT event_id, {CANDIDATES} AS m FROM events)
SELECT event_id, CAST(unnest(range(len(m))) AS INTEGER) AS pos, unnest(m) AS candidate FROM found""",
    "json_schema_match": f"SELECT event_id, {SCHEMA_VALID} AS valid FROM events",
    "guard_json_schema": "WITH checked AS (SELECT event_id, {0} AS valid, {1} AS content FROM events)\n"
        "SELECT event_id, {2} FROM checked".format(
            SCHEMA_VALID, EVENT_TEXT, verdict(
                "valid", "JSON_SCHEMA_GUARDRAIL",
                "'The inspected response payload content: ' || content || ' does not satisfy the JSON schema: "
                '{"type": "object", "required": ["k"], "properties": {"k": {"type": "integer", "minimum": 10}, '
                '"v": {"type": "number"}}}' + "'")),
    "prompt_template": f"""SELECT item_id,
  '{{"model":"chat-model","messages":[{{"role":"user","content":"Task: Card '
  || length(text) || ', for new pupils: is this so? <' || {TEMPLATE_TEXT} || '> (end of card ' || length(text)
  || ') now"}}]}}' AS payload_out FROM benchmark""",
    "prompt_decorate_string": """SELECT conv_id, turn, 'Answer "briefly". ' || text AS content
FROM conversations WHERE role <> 'assistant'""",
    "prompt_decorate_array": f"""SELECT conv_id, turn, '{SYSTEM}' AS first, 'Be brief.' AS last, 'system' AS role,
  CAST(4 AS INTEGER) AS messages FROM conversations WHERE role <> 'assistant'""",
    "moderation_request": f"""SELECT doc_id, CAST(to_json({{'text': {CLEANED},
  'categories': ['Hate', 'SelfHarm'], 'haltOnBlocklistHit': true,
  'outputType': 'EightSeverityLevels'}}) AS VARCHAR) AS request FROM documents""",
    "moderation_verdict": f"""WITH {LABELLED} SELECT doc_id,
  {verdict('passed', 'AZURE_CONTENT_SAFETY_CONTENT_MODERATION', None)}, NOT passed AS blocked FROM decided""",
    "moderation_assessment": f"""WITH {LABELLED} SELECT doc_id,
  'Violation of azure content safety content moderation detected.' AS reason,
  CASE WHEN answered THEN CASE WHEN hate >= 2 THEN 'FAIL' ELSE 'PASS' END END AS hate,
  CASE WHEN answered THEN CASE WHEN violence >= 1 THEN 'FAIL' ELSE 'PASS' END END AS violence,
  CASE WHEN answered THEN content END AS inspected FROM decided WHERE NOT passed""",
    "bedrock_request": f"""SELECT doc_id, CAST(to_json({{'content': [{{'text': {{'text': {CLEANED}}}}}],
  'source': 'INPUT'}}) AS VARCHAR) AS request FROM documents""",
    "bedrock_block": f"""WITH {BEDROCK} SELECT doc_id, NOT blocked AS passed,
  CASE WHEN blocked THEN 900514 END AS error_code,
  CASE WHEN blocked THEN 'AWS_BEDROCK_GUARDRAIL' END AS error_type,
  CASE WHEN blocked THEN 'Violation of AWS Bedrock Guardrails detected.' END AS reason,
  CASE WHEN blocked THEN mails[1] END AS entity, CAST(NULL AS VARCHAR) AS metrics FROM answered""",
    "bedrock_mask": BEDROCK_MASK,
    "bedrock_redact": f"""WITH {BEDROCK} SELECT doc_id, NOT blocked AS passed,
  CASE WHEN has_mail AND NOT blocked THEN regexp_replace(text, '{EMAIL}', '{{EMAIL}}', 'g')
       ELSE text END AS content FROM answered""",
    "policy_chain": CHAIN_ROWS,
    "policy_report": f"""WITH {CHAINED} SELECT direction, halted_by, error_type, error_code,
  count(*) AS messages, CAST(sum(octet_length(encode(payload))) AS BIGINT) AS payload_bytes
FROM chained GROUP BY ALL""",
    "stream_policy_parity": CHAIN_ROWS,
    "stream_pii_restore": f"""SELECT doc_id, CASE WHEN regexp_matches({CLEANED}, '{ONE_PII[0][1]}')
  THEN {CLEANED} ELSE text END AS restored FROM documents""",
    "stream_guard_url": url_guard("regexp_matches(url, 'example[.](com|net)')"),
    "guard_url_provider": url_guard("contains(url, 'example.com')"),
    "policy_chain_scored": f"""WITH decided AS (
  SELECT d.doc_id, 'Be brief. ' || d.text AS content, coalesce(l.toxic, 0) * 4 >= 2 AS hateful,
         regexp_matches({clean("('Be brief. ' || d.text)")}, '{PHONE}') AS phoned
  FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT doc_id, NOT (hateful OR phoned) AS passed,
       CASE WHEN hateful THEN 'moderation' WHEN phoned THEN 'guard' END AS halted_by, content FROM decided""",
    "moderation_passthrough": f"""WITH {LABELLED}, kept AS (
  SELECT doc_id, passed OR NOT answered AS fine FROM decided)
SELECT doc_id, {verdict('fine', 'AZURE_CONTENT_SAFETY_CONTENT_MODERATION', None)} FROM kept""",
    "moderation_provider": f"""WITH asked AS (
  SELECT doc_id, NOT contains({CLEANED}, '###') AS fine FROM documents)
SELECT doc_id, {verdict('fine', 'AZURE_CONTENT_SAFETY_CONTENT_MODERATION', None)} FROM asked""",
    "jsonpath_set_keeps_numbers": """SELECT item_id,
  '{"id":123456789012345678901234567890123456789012345,"x":[0.123456789012345678901234567891,"1",null,true],'
  || '"messages":[{"content":"s","role":"system"},{"n":0.123456789012345678901234567891,"content":'
  || to_json('<' || text || '>') || '}]}' AS payload_out FROM benchmark""",
    "guard_json_schema_keywords": "WITH checked AS (SELECT event_id, (user_id % 3 = 0 AND user_id >= 10) "
        "OR user_id % 5 = 0 AS valid FROM events) SELECT event_id, {0} FROM checked".format(
            verdict("valid", "JSON_SCHEMA_GUARDRAIL", None)),
    "bedrock_restore": f"""WITH {BEDROCK}
SELECT doc_id, CASE WHEN has_mail AND NOT blocked THEN content ELSE text END AS restored FROM answered""",
    "stream_url_asked": r"""SELECT DISTINCT url, CAST(1 AS BIGINT) AS asked FROM (
  SELECT unnest([url || '>', url, regexp_extract(url, '^(https?://[^/]+)', 1)]) AS url FROM pages) WHERE url <> ''""",
    "stream_policy_report": f"""WITH {CHAINED} SELECT
  CAST(1700000100 + 60 * turn - (1700000100 + 60 * turn) % 120 AS BIGINT) AS window_start, direction, halted_by,
  error_type, error_code, count(*) AS messages, CAST(sum(octet_length(encode(payload))) AS BIGINT) AS payload_bytes
FROM chained GROUP BY ALL""",
    "prompt_template_table": """SELECT o_orderkey, 'Take ' || coalesce(
  c_mktsegment || ' order [' || o_orderkey || '] of ' || o_orderstatus || ': ' || o_orderkey,
  'template://c-' || o_custkey || '?n=' || o_orderkey || '&who=' || o_orderstatus)
  || ', not template://nobody?x=1' AS content FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
    "guard_semantic_table": semantic_table("false", False),
    "guard_semantic_table_blocks": semantic_table("CAST(r.embedding[1] AS DOUBLE) <= 0.1", True),
    "policy_chain_asking": f"""WITH found AS (
  SELECT doc_id, text, contains({CLEANED}, '###') AS a, 'Be brief. ' || text AS briefed FROM documents),
decided AS (
  SELECT *, regexp_matches({clean("briefed")}, '{PHONE}') AS b, contains({clean("briefed")}, '@') AS c FROM found)
SELECT doc_id, NOT (a OR b OR c) AS passed,
       CASE WHEN a THEN 'first' WHEN b THEN 'second' WHEN c THEN 'third' END AS halted_by,
       CASE WHEN a THEN text ELSE briefed END AS content FROM decided""",
    "bedrock_mask_regexes": f"""WITH RECURSIVE found AS (
  SELECT doc_id, text, {CLEANED} AS content, regexp_extract_all(text, '{PHONE}') AS m FROM documents),
listed AS (SELECT *, list_filter(m, lambda x, i: list_position(m, x) = i) AS u FROM found),
steps AS (
  SELECT doc_id, 0 AS i, content AS t, u FROM listed WHERE len(u) > 0
  UNION ALL
  SELECT doc_id, i + 1, replace(t, u[i + 1], 'CALL_' || printf('%04x', i)), u FROM steps WHERE i < len(u)),
done AS (SELECT doc_id, t, i FROM steps WHERE i = len(u))
SELECT l.doc_id, coalesce(done.t, l.text) AS content, CAST(coalesce(done.i, 0) AS INTEGER) AS entries
FROM listed l LEFT JOIN done USING (doc_id)""",
}

# The same rows as their counterparts in batches or by another operator.
for streamed, plain in (("stream_scorer", "moderation_provider"), ("stream_url_status", "guard_url_provider"),
                        ("stream_pii_restore_timers", "stream_pii_restore"), ("stream_pii_mapping", "pii_mapping_table")):
    ORACLES[streamed] = ORACLES[plain]
