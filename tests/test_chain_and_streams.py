import json

import pytest
from pyspark.sql import functions as F

import gatewright as g
from gatewright.functions import scorers
from gatewright.plans.correlate import with_mapping
from gatewright.session import work_folder
from gatewright.sources import providers
from gatewright.sources.messages import conversation_messages
from gatewright.streaming.streams import by_batch, drain, file_stream, restore_stream
from tests.conftest import outcomes, rows

LAST = "$.messages[-1].content"
EMAIL = ("EMAIL", r"[a-z]+@[a-z]+\.[a-z]+")


def short(df):
    return [(r.outcome.passed, r.outcome.error_type, r.halted_by)
            for r in df.orderBy("msg_id").select("outcome", "halted_by").collect()]


def test_chain_stops_at_the_first_violation_and_passes_changes_on(messages, chat):
    steps = [
        g.WordCount("few", LAST, min=1, max=4),
        g.PiiRegex("pii", LAST, pii_entities=[EMAIL], redact=True),
        g.RegexMatch("no-mail", LAST, regex="@", invert=True),
        g.Decoration("tone", LAST, prompt_decorator_config={"decoration": "Be brief."}),
        g.WordCount("many", LAST, min=1, max=5),
    ]
    df = messages(chat("mail a@b.org"), chat("one two three four"), chat("a b c d e"), "bad", chat("x"))
    done = g.run_chain(df, steps)
    assert short(done) == [
        (True, None, None), (False, "WORD_COUNT_GUARDRAIL", "many"),
        (False, "WORD_COUNT_GUARDRAIL", "few"), (False, None, "few"), (True, None, None)]
    out = [r[0] for r in rows(done, "payload_out")]
    assert json.loads(out[0])["messages"][1]["content"] == "Be brief. mail *****"
    # A stopped message keeps what earlier policies made of it.
    assert json.loads(out[1])["messages"][1]["content"] == "Be brief. one two three four"
    assert json.loads(out[2]) == chat("a b c d e") and out[3] == "bad"
    assert set(done.columns) == set(df.columns) | {"outcome", "halted_by", "payload_out"}


def test_chain_order_is_kept(messages, chat):
    a, b = g.WordCount("a", LAST, min=5, max=9), g.RegexMatch("b", LAST, regex="z")
    df = messages(chat("x"))
    assert short(g.run_chain(df, [a, b]))[0][2] == "a"
    assert short(g.run_chain(df, [b, a]))[0][2] == "b"


def test_chain_by_flow_with_joins_and_masking(spark, messages, chat):
    status = spark.createDataFrame([("http://ok", 200)], "url string, status int")
    df = messages(chat("http://ok a@b.org"), chat("http://no a@b.org"),
                  ("RESPONSE", chat("http://no a@b.org")))
    done = g.run_chain(
        df, [(g.UrlCheck("urls", LAST), "REQUEST"), (g.PiiRegex("pii", LAST, pii_entities=[EMAIL]), "REQUEST")],
        g.Inputs(status=status))
    got = done.orderBy("msg_id").collect()
    assert [r.halted_by for r in got] == [None, "urls", None]
    assert json.loads(got[0].payload_out)["messages"][1]["content"] == "http://ok EMAIL_0000"
    assert got[0].mapping[0].original == "a@b.org"
    assert got[1].payload_out == got[1].payload and got[1].mapping is None
    assert got[2].payload_out == got[2].payload


def test_chain_with_scores_and_vectors(messages, chat):
    df = messages(chat("a"), chat("b"), chat("c"))
    df = df.withColumn("embedding", F.when(F.col("msg_id") == 0, F.array(F.lit(1.0), F.lit(0.0)))
                       .otherwise(F.array(F.lit(0.0), F.lit(1.0))))
    df = df.withColumn("response", F.when(F.col("msg_id") == 1, '{"categoriesAnalysis": [{"category": "Hate", "severity": 5}]}')
                       .otherwise("{}"))
    steps = [g.SemanticGuard("meaning", LAST, rules={"denyPrompts": ["x"]}, vectors=((1.0, 0.0),)),
             g.Moderation("hate", LAST, hate_category=3)]
    assert [s[2] for s in short(g.run_chain(df, steps))] == ["meaning", "hate", None]


def test_report_and_fault_records(messages, chat):
    df = messages(chat("a"), chat("a b"), ("RESPONSE", chat("a b")), "bad")
    done = g.run_chain(df, [g.WordCount("w", LAST, min=1, max=1)], detailed=False)
    report = {(r.direction, r.error_type, r.error_code): r.messages for r in g.policy_report(done).collect()}
    assert report == {("REQUEST", None, None): 1, ("REQUEST", "WORD_COUNT_GUARDRAIL", 900514): 1,
                      ("RESPONSE", "WORD_COUNT_GUARDRAIL", 900514): 1, ("REQUEST", None, 900967): 1}
    faults = g.fault_records(done).orderBy("msg_id").collect()
    assert [r.error_message for r in faults] == [
        "Violation of w detected.", "Violation of w detected.",
        "Error occurred during WordCountGuardrail mediation"]
    assert g.allowed(done).count() == 1 and g.violations(done).count() == 3


def test_filters_do_not_repeat_a_policy(messages, chat):
    """A filter on the outcome stays above; one on a given column goes below."""
    done = g.run_chain(messages(chat("a b")), [g.WordCount("w", LAST, min=1, max=1)])
    plan = done.where("not outcome.passed and msg_id = 3")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert plan.index("passed") < plan.index("Generate") < plan.rindex("msg_id")


def test_conversation_messages_never_shuffle(spark):
    data = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "system", "s")]
    df = conversation_messages(spark.createDataFrame(data, "conv_id long, turn long, role string, text string"))
    got = df.orderBy("turn").collect()
    assert [(r.msg_id, r.direction) for r in got] == [("1:0", "REQUEST"), ("1:0", "RESPONSE"), ("1:2", "REQUEST")]
    assert json.loads(got[1].payload) == {"choices": [{"message": {"role": "assistant", "content": "a"}}]}
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


# --- user functions ---------------------------------------------------------------


def test_embedding_provider(messages, chat):
    def provider(text):
        if text == "broken":
            raise RuntimeError("no answer")
        return [1.0, 0.0] if "bad" in text else [0.0, 1.0]

    policy = providers.embed_rules(g.SemanticGuard("G", "$.t", rules={"denyPrompts": ["bad"]}), provider)
    df = messages({"t": "bad"}, {"t": "good"}, {"t": "broken"})
    df = df.withColumn("embedding", providers.embed(provider)(F.get_json_object("payload", "$.t")))
    assert [o.error_code for o in outcomes(g.apply(df, policy))] == [900514, None, 900967]


def test_scorer(messages):
    def call_out(request):
        text = json.loads(request)["content"][0]["text"]["text"]
        if text == "down":
            raise ConnectionError
        return json.dumps({"action": "NONE" if text == "fine" else "GUARDRAIL_INTERVENED",
                           "actionReason": "Guardrail blocked."})

    df = messages({"t": "fine"}, {"t": "bad"}, {"t": "down"})
    requests = df.select("msg_id", scorers.bedrock_request(
        F.get_json_object("payload", "$.t"), F.col("direction")).alias("request"))
    answers = providers.score(requests, call_out, tasks=2)
    policy = g.BedrockVerdict("B", "$.t", passthrough_on_error=False)
    got = outcomes(g.apply(df, policy, g.Inputs(responses=answers)))
    assert [o.error_code for o in got] == [None, 900514, 900514]


@pytest.mark.parametrize("threads", [1, 4])
def test_scorer_for_a_policy(messages, threads):
    def call_out(fields):
        text = json.loads(fields["request_payload"])["text"]
        assert fields["service"].startswith("/contentsafety/")
        if text == "down":
            raise ConnectionError
        return json.dumps({"categoriesAnalysis": [{"category": "Hate", "severity": len(text)}]})

    policy = g.Moderation("M", "$.t", hate_category=3)
    df = messages({"t": "ok"}, {"t": "hate"}, {"t": "down"}, {"x": 1}, "")
    answers = providers.ask(df, policy, call_out, threads=threads)
    got = outcomes(g.apply(df, policy, g.Inputs(responses=answers)))
    assert [o.error_code for o in got] == [None, 900514, 900514, 900967, 900514]


def test_scorer_is_not_asked_about_responses_that_are_only_restored(messages):
    policy = g.BedrockVerdict("B", "$.t", region="r", guardrail_id="i", guardrail_version="1")
    df = messages({"t": "a"}, ("RESPONSE", {"t": "b"}))
    asked = providers.requests(df, policy).orderBy("msg_id").collect()
    assert asked[0].request is not None and asked[1].request is None
    both = g.BedrockVerdict("B", "$.t", redact_pii=True)
    assert providers.requests(df, both).where("request is null").count() == 0
    assert providers.call_fields(policy)["request_url"].endswith("/guardrail/i/version/1/apply")


def test_batched_providers_and_visible_errors(spark, messages):
    def call_out(calls):
        bodies = [json.loads(c["request_payload"])["text"] for c in calls]
        if "down" in bodies:
            raise ConnectionError("no route")
        return [json.dumps({"categoriesAnalysis": [{"category": "Hate", "severity": len(b)}]}) for b in bodies]

    policy = g.Moderation("M", "$.t", hate_category=3)
    fine = providers.ask(messages({"t": "ok"}, {"t": "hate"}, ""), policy, call_out, batched=True)
    assert [r.error for r in fine.collect()] == [None] * 3
    got = outcomes(g.apply(messages({"t": "ok"}, {"t": "hate"}), policy, g.Inputs(responses=fine)))
    assert [o.passed for o in got] == [True, False]
    down = providers.ask(messages({"t": "down"}), policy, call_out, batched=True).first()
    assert down.response is None and down.error == "ConnectionError: no route"
    short = providers.score(spark.createDataFrame([(1, "a"), (2, "b")], "msg_id int, request string").coalesce(1),
                            lambda bodies: bodies[:1], batched=True)
    assert {r.error for r in short.collect()} == {"1 answers to 2 calls"}
    failures = spark.sparkContext.accumulator(0)
    texts = spark.createDataFrame([("a",), ("bad",), (None,), ("",)], "t string").coalesce(1)

    def vector(text):
        return [float("nan" if text == "x" else len(text))] if text != "bad" else 1 / 0

    found = texts.select(providers.embed(vector, failures=failures)("t").alias("v")).collect()
    assert [r.v for r in found] == [[1.0], None, None, None] and failures.value == 1
    found = texts.select(providers.embed(lambda ts: [[len(t)] for t in ts], batched=True)("t").alias("v")).collect()
    assert [r.v for r in found] == [[1.0], [3.0], None, None]


def test_rules_that_are_too_many_to_travel_are_refused(monkeypatch):
    from gatewright.functions import similarity
    monkeypatch.setattr(similarity, "MOST_RULE_NUMBERS", 5)
    with pytest.raises(ValueError):
        similarity.cosine_to_rules(F.col("v"), [[1.0, 2.0], [1.0, 2.0], [3.0, 4.0]])


def test_url_status_of_a_policy(messages):
    policy = g.UrlCheck("U", "$.t", timeout=50)
    df = messages({"t": "http://ok/50"}, {"t": "http://no/"}, {"x": "http://elsewhere"})
    status = providers.url_status(df, policy, lambda url, limit: 200 if url.endswith(str(limit)) else 500)
    assert {r.url: r.status for r in status.collect()} == {"http://ok/50": 200, "http://no/": 500}
    hosts = providers.url_status(df, g.UrlCheck("U", "$.t", only_dns=True), lambda host, limit: (0, 1))
    assert {r.host for r in hosts.collect()} == {"ok", "no"}


def test_request_bodies(spark):
    df = spark.range(1).select(
        scorers.bedrock_request(F.lit("x"), F.lit("RESPONSE")).alias("b"),
        scorers.moderation_request(F.lit("x"), scorers.thresholds((0, 7, -1, 8))).alias("m"),
        scorers.moderation_request(F.lit("x"), scorers.thresholds((-1, -1, -1, 8))).alias("n"))
    r = df.first()
    assert r.b == '{"content":[{"text":{"text":"x"}}],"source":"OUTPUT"}'
    assert json.loads(r.m) == {"text": "x", "categories": ["Hate", "Sexual"], "haltOnBlocklistHit": True,
                               "outputType": "EightSeverityLevels"}
    assert r.n is None
    call = scorers.bedrock_call("eu", "g", "2")
    assert call["request_url"] == "https://bedrock-runtime.eu.amazonaws.com/guardrail/g/version/2/apply"


def test_url_checkers(messages):
    def head(url):
        if "down" in url:
            raise TimeoutError
        return 200 if "ok" in url else 404

    df = messages("http://ok/1 http://ok/1", "http://no", "http://down", "none")
    status = providers.check_urls(df, F.col("payload"), head, tasks=2)
    assert {r.url: r.status for r in status.collect()} == {"http://ok/1": 200, "http://no": 404, "http://down": None}
    got = outcomes(g.apply(df, g.UrlCheck("U"), g.Inputs(status=status)))
    assert [o.passed for o in got] == [True, False, False, True]
    hosts = providers.check_hosts(df, F.col("payload"), lambda h: (0, 1) if h == "ok" else None)
    got = outcomes(g.apply(df, g.UrlCheck("U", only_dns=True), g.Inputs(status=hosts)))
    assert [o.passed for o in got] == [True, False, False, True]


# --- streams -------------------------------------------------------------------------


@pytest.mark.parametrize("policy", [
    g.WordCount("w", LAST, min=2, max=3, show_assessment=True),
    g.PiiRegex("p", LAST, pii_entities=[EMAIL], redact=True),
    g.JsonSchema("j", LAST, schema={"required": ["a"]}),
    g.Decoration("d", prompt_decorator_config={"decoration": [{"role": "system", "content": "x"}]}),
])
def test_stream_equals_batch(spark, messages, chat, tmp_path, policy):
    df = messages(chat("a b"), chat("a@b.org"), chat('{"a":1}'), "bad", ("RESPONSE", chat("a b c d")))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = g.apply(file_stream(spark, str(tmp_path / "in"), df.schema), policy)
    drain(stream, str(tmp_path / "out"), str(tmp_path / "ck"))
    got = spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))
    want = g.apply(df, policy)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.select(*got.columns).collect()))


def test_restore_stream(spark, tmp_path):
    minute = lambda m: f"2024-01-01 00:{m:02d}:00"
    asked = [("a", minute(0), "mail a@b.org"), ("b", minute(0), "nothing"), ("c", minute(1), "x@y.org"),
             ("late", minute(0), "l@m.org"), ("end", minute(59), "e@e.org")]
    answered = [("a", minute(1), "to EMAIL_0000"), ("b", minute(1), "EMAIL_0000"), ("c", minute(2), "EMAIL_0000!"),
                ("late", minute(30), "EMAIL_0000"), ("end", minute(59), "EMAIL_0000")]
    for name, data, way in (("req", asked, "REQUEST"), ("resp", answered, "RESPONSE")):
        spark.createDataFrame(data, "msg_id string, at string, payload string").select(
            "msg_id", F.lit(way).alias("direction"), "payload", F.to_timestamp("at").alias("ts")
        ).coalesce(1).write.parquet(str(tmp_path / name))
    schema = "msg_id string, direction string, payload string, ts timestamp"
    read = lambda name: file_stream(spark, str(tmp_path / name), schema)
    policy = g.PiiRegex("p", pii_entities=[EMAIL])
    restored = restore_stream(read("req"), read("resp"), policy, within="10 minutes", late="1 minute")
    drain(restored, str(tmp_path / "out"), str(tmp_path / "ck"))
    got = dict(spark.read.parquet(str(tmp_path / "out")).select("msg_id", "payload_out").collect())
    # "late" comes after the bound; "b" had nothing to restore.
    assert got == {"a": "to a@b.org", "b": "EMAIL_0000", "c": "x@y.org!", "late": "EMAIL_0000", "end": "e@e.org"}


def test_restore_stream_over_part_files_and_batches(spark, tmp_path):
    """One file in a micro-batch; the rows are those of the batch join."""
    asked = [(f"m{i}", f"to a{i}@b.org" if i % 3 else "nothing") for i in range(30)]
    requests = spark.createDataFrame(asked, "msg_id string, payload string").select(
        "msg_id", F.lit("REQUEST").alias("direction"), "payload", F.to_timestamp(F.lit("2024-01-01")).alias("ts"))
    requests.repartition(3).write.parquet(str(tmp_path / "t.parquet"))
    policy = g.PiiRegex("p", pii_entities=[EMAIL])

    def read():
        return file_stream(spark, str(tmp_path / "t.parquet"), requests.schema, files=1)

    answers = g.apply(read(), policy, flow="REQUEST").select(
        "msg_id", F.lit("RESPONSE").alias("direction"), F.col("payload_out").alias("payload"), "ts")
    drain(restore_stream(read(), answers, policy), str(tmp_path / "out"), str(tmp_path / "ck"))
    got = spark.read.parquet(str(tmp_path / "out")).select("msg_id", "payload_out").collect()
    assert sorted(map(tuple, got)) == sorted(asked)


def test_urls_on_a_stream(spark, messages, chat, tmp_path):
    df = messages(*[chat(f"http://u{i}") for i in range(30)])
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    status = spark.range(2500).selectExpr("'http://u' || id * 2 AS url", "200 AS status")
    policy = g.UrlCheck("U", LAST)
    stream = file_stream(spark, str(tmp_path / "in"), df.schema, files=1)
    with pytest.raises(ValueError):
        g.apply(stream, policy, g.Inputs(status=status))
    by_batch(stream, lambda batch: g.apply(batch, policy, g.Inputs(status=status)).select("msg_id", "outcome.passed"),
             str(tmp_path / "out"), str(tmp_path / "ck"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.select("batch").distinct().count() == 3
    assert {r.msg_id: r.passed for r in got.collect()} == {i: i % 2 == 0 for i in range(30)}


def test_repeated_answers_do_not_repeat_messages(spark, messages, chat):
    answers = spark.createDataFrame(
        [(0, '{"action": "NONE"}'), (0, '{"action": "NONE"}'), (0, None)], "msg_id long, response string")
    policy = g.BedrockVerdict("b", LAST, region="r", guardrail_id="g", guardrail_version="1")
    got = g.apply(messages(chat("x")), policy, g.Inputs(responses=answers)).collect()
    assert len(got) == 1 and got[0].outcome.passed
    mappings = spark.createDataFrame([(0, [(0, "a", "E_0")]), (0, [(0, "a", "E_0")])],
                                     "msg_id long, mapping array<struct<ord:int,original:string,placeholder:string>>")
    assert with_mapping(messages(("RESPONSE", chat("E_0"))), mappings).count() == 1


def test_each_step_of_a_chain_has_its_own_answers(spark, messages, chat):
    def answer(blocked):
        def responses(asked):
            hit = F.col("payload").contains(blocked)
            return asked.select("msg_id", F.when(
                hit, '{"action": "GUARDRAIL_INTERVENED", "actionReason": "Guardrail blocked."}').otherwise(
                '{"action": "NONE"}').alias("response"))
        return g.Inputs(responses=responses)

    guard = lambda name: g.BedrockVerdict(name, LAST, region="r", guardrail_id="g", guardrail_version="1")
    tone = g.Decoration("tone", LAST, prompt_decorator_config={"decoration": "soft"})
    done = g.run_chain(messages(chat("a"), chat("b"), chat("c")), [
        (guard("first"), "REQUEST", answer('"a"')), (tone, "REQUEST"), (guard("second"), "REQUEST", answer("soft b"))])
    assert [r.halted_by for r in done.orderBy("msg_id").collect()] == ["first", "second", None]


def test_work_folders_are_shared_or_refused():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return self.folder

    class Session:
        conf, sparkContext = Conf(), Context()

    Context.folder = None
    with pytest.raises(ValueError):
        work_folder(Session, "x")
    Context.folder = "hdfs://a/b"
    assert work_folder(Session, "x").startswith("hdfs://a/b/x-")


def test_repeated_keys_need_no_setting(spark, messages):
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    got = g.apply(messages('{"t": "a", "t": "b b"}'), g.WordCount("w", "$.t", min=2, max=2)).collect()
    assert got[0].outcome.passed


def test_rewriting_keeps_long_numbers(messages):
    long = '{"id": 123456789012345678901234567890123456789012345, "d": 0.123456789012345678901234567891, "t": "a@b.org"}'
    for policy in (g.PiiRegex("p", "$.t", pii_entities=[EMAIL]),
                   g.Decoration("d", "$.t", prompt_decorator_config={"decoration": "x"})):
        out = g.apply(messages(long), policy).collect()[0].payload_out
        assert '123456789012345678901234567890123456789012345' in out and '0.123456789012345678901234567891' in out


def test_blank_payloads_of_any_kind_pass_the_schema(messages):
    got = g.apply(messages("\u3000\u2003", "\u00a0"), g.JsonSchema("j", "", schema={"type": "object"})).orderBy("msg_id")
    assert [r.outcome.passed for r in got.collect()] == [True, False]


@pytest.mark.parametrize("size", [4_000_000, 15_000_000])
def test_long_arrays_and_large_payloads(messages, size):
    many = {"messages": [{"content": str(i)} for i in range(20000)]}
    large = {"messages": [{"content": "a@b.org " + "w " * size + "end@b.org"}]}
    done = g.apply(messages(many, large), g.PiiRegex("p", LAST, pii_entities=[EMAIL], redact=True))
    got = done.select("outcome.passed", F.octet_length("payload_out").alias("n")).orderBy("msg_id").collect()
    assert [r.passed for r in got] == [True, True]
    # Both addresses are gone, and nothing else.
    assert got[1].n == len('{"messages":[{"content":"***** *****"}]}') + 2 * size


def test_functions_travel_by_value(tmp_path):
    """Workers need no installed package for the Python parts."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from gatewright.functions import similarity

    (tmp_path / "f").write_bytes(cloudpickle.dumps((providers._answers, similarity._exact_cosine)))
    code = ("import sys; from pyspark import cloudpickle; "
            "a, c = cloudpickle.load(open('f', 'rb')); print(a(len, ['x', None], 2)); "
            "assert 'gatewright' not in sys.modules")
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
                          env={}, timeout=120)
    assert done.stdout.strip() == "([1, None], [None, None])", done.stderr


# --- scorers in a chain --------------------------------------------------------------


def asking_chain(spark, policies, blocked, calls):
    """Steps that ask a function each; ``calls`` counts by step."""
    def step(policy, counter):
        def call_out(call):
            counter.add(1)
            text = json.loads(call["request_payload"])["text"]
            return json.dumps({"categoriesAnalysis": [{"category": "Hate", "severity": 5 * (blocked[policy.name] in text)}]})

        return policy, "REQUEST", g.Inputs(responses=lambda m: providers.ask(m, policy, call_out))

    return [step(p, c) for p, c in zip(policies, calls)]


def test_every_step_asks_once_for_each_message(spark, messages, chat):
    names = ("one", "two", "three")
    policies = [g.Moderation(n, LAST, hate_category=3) for n in names]
    calls = [spark.sparkContext.accumulator(0) for _ in names]
    df = messages(chat("a"), chat("b"), chat("c"), chat("d"), ("RESPONSE", chat("a")))
    done = g.run_chain(df, asking_chain(spark, policies, {"one": "a", "two": "b", "three": "c"}, calls))
    assert [s[2] for s in short(done)] == ["one", "two", "three", None, None]
    assert done.count() == 5 and g.policy_report(done).count() > 0  # asks nobody again
    assert [c.value for c in calls] == [4, 3, 2]


def test_the_plan_grows_by_one_join_for_each_asking_step(spark, messages, chat):
    def scans(k):
        policies = [g.Moderation(f"p{i}", LAST, hate_category=3) for i in range(k)]
        steps = asking_chain(spark, policies, {f"p{i}": "zzz" for i in range(k)},
                             [spark.sparkContext.accumulator(0)] * k)
        plan = g.run_chain(messages(chat("a")), steps)._jdf.queryExecution().optimizedPlan().toString()
        return plan.count("parquet"), plan.count("Join")

    assert scans(1) == scans(3) == scans(5) == (2, 1)


def test_asking_keeps_mappings_changes_and_columns(spark, messages, chat):
    """Masking before a scorer, decoration behind it; a column of the caller's comes along."""
    policy = g.Moderation("hate", LAST, hate_category=3)
    steps = [(g.PiiRegex("pii", LAST, pii_entities=[EMAIL]), "REQUEST"),
             *asking_chain(spark, [policy], {"hate": "@"}, [spark.sparkContext.accumulator(0)]),
             (g.Decoration("tone", LAST, prompt_decorator_config={"decoration": "Be brief."}), "REQUEST")]
    df = messages(chat("to a@b.org"), "bad", chat("x"), extra=F.col("msg_id") * 2)
    got = g.run_chain(df, steps).orderBy("msg_id").collect()
    assert [r.halted_by for r in got] == [None, "pii", None] and [r.extra for r in got] == [0, 2, 4]
    assert json.loads(got[0].payload_out)["messages"][1]["content"] == "Be brief. to EMAIL_0000"
    assert [r.mapping is not None and r.mapping[0].original for r in got] == ["a@b.org", False, False]


def test_a_stream_is_not_cut(spark, tmp_path):
    spark.createDataFrame([("a", "REQUEST", "{}")], "msg_id string, direction string, payload string").write.parquet(
        str(tmp_path / "in"))
    stream = file_stream(spark, str(tmp_path / "in"), "msg_id string, direction string, payload string")
    with pytest.raises(ValueError, match="micro-batch"):
        g.apply(stream, g.Moderation("m", "$.t", hate_category=3), g.Inputs(responses=lambda m: m))
