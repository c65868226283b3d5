"""Streams that ask, look up and keep tables: restarts, repeated batches, expiry."""

import json

import pytest
from pyspark.sql import functions as F

import gatewright as g
from gatewright.plans.correlate import with_mapping
from gatewright.sources import providers
from gatewright.streaming.asking import Answers, Mappings, UrlStatuses, in_batches, latest
from gatewright.streaming.streams import drain, file_stream, keep_report, read_report, report_stream, restore_by_timers
from gatewright.streaming.tables import BatchTable

LAST = "$.messages[-1].content"
EMAIL = ("EMAIL", r"[a-z]+@[a-z]+\.[a-z]+")
SCHEMA = "msg_id string, direction string, payload string, ts timestamp"


def payload(text):
    return json.dumps({"messages": [{"role": "user", "content": text}]})


def add_file(spark, folder, rows):
    """One file of ``(msg_id, text, minute)`` messages, later than those before."""
    spark.createDataFrame([(i, payload(t), f"2024-01-01 {m // 60:02d}:{m % 60:02d}:00") for i, t, m in rows],
                          "msg_id string, payload string, at string").select(
        "msg_id", F.lit("REQUEST").alias("direction"), "payload", F.to_timestamp("at").alias("ts")
    ).coalesce(1).write.mode("append").parquet(folder)


# --- the table ---------------------------------------------------------------------


def test_batches_are_written_once_and_the_latest_counts(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), "k string, v int", ("k",))
    rows = lambda *pairs: spark.createDataFrame(list(pairs), "k string, v int")
    assert table.current().collect() == [] and table.parts() == []
    table.once(0, 10, lambda: rows(("a", 1), ("b", 1)))
    table.once(1, 20, lambda: rows(("b", 7), ("c", 9), ("c", 3)))
    again = table.once(1, 99, lambda: pytest.fail("a batch is made once"))
    assert sorted((r.k, r.v) for r in again.collect()) == [("b", 7), ("c", 3), ("c", 9)]
    want = [("a", 1), ("b", 7), ("c", 3)]
    assert sorted(map(tuple, table.current().collect())) == want
    assert sorted(map(tuple, table.current(since=15).collect())) == want[1:]
    assert [r.v for r in table.before(1).where("k = 'b'").collect()] == [1]
    table.compact(1)
    assert [(p.batch, p.merged) for p in table.parts()] == [(1, True)]
    assert sorted(map(tuple, table.current().collect())) == want
    assert sorted(map(tuple, table.current(since=15).collect())) == want[1:]
    assert table.once(1, 5, lambda: pytest.fail("merged batches are known")).count() == 2  # one row a key is left
    table.once(2, 30, lambda: rows((None, 1), (None, 1)))
    table.compact(2)
    table.compact(2)
    assert sorted(map(tuple, table.current().collect()), key=repr) == sorted([*want, (None, 1)], key=repr)
    table.expire(31)
    assert table.parts() == []


def test_a_part_that_was_not_finished_is_written_again(spark, tmp_path):
    table = BatchTable(spark, str(tmp_path / "t"), "k string", ("k",))
    table.once(0, 0, lambda: spark.createDataFrame([("half",)], "k string"))
    (tmp_path / "t" / "part-0-at-0" / "_SUCCESS").unlink()
    table.once(0, 0, lambda: spark.createDataFrame([("whole",)], "k string"))
    assert [r.k for r in table.current().collect()] == ["whole"]


# --- scorers -----------------------------------------------------------------------


def test_a_stopped_stream_asks_nothing_twice(spark, tmp_path):
    """The second batch fails behind its calls; started again, it asks only about what is new."""
    calls = spark.sparkContext.accumulator(0)
    folder = str(tmp_path / "in")

    def call_out(call):
        calls.add(1)
        return json.dumps({"categoriesAnalysis": [{"category": "Hate", "severity": 5 * ("bad" in call["request_payload"])}]})

    policy = g.Moderation("hate", LAST, hate_category=3)
    state = {"fail": True}

    def step(batch, number):
        answers = Answers(str(tmp_path / "answers"), number)
        steps = [(p, "REQUEST", g.Inputs(responses=answers(p.name, lambda m, p=p: providers.ask(m, p, call_out))))
                 for p in (policy, g.Moderation("again", LAST, hate_category=3))]
        checked = g.run_chain(batch, steps)
        if number == 1 and state["fail"]:
            raise RuntimeError("the executor is gone")
        return checked.select("msg_id", "halted_by")

    def run():
        return in_batches(file_stream(spark, folder, SCHEMA, files=1), step, str(tmp_path / "out"), str(tmp_path / "ck"))

    add_file(spark, folder, [("a", "good", 0), ("b", "bad", 0)])
    run()
    assert calls.value == 3
    add_file(spark, folder, [("c", "bad", 1)])
    with pytest.raises(Exception, match="gone"):
        run()
    assert calls.value == 4
    state["fail"] = False
    add_file(spark, folder, [("d", "good", 2)])
    run()
    assert calls.value == 6
    got = {r.msg_id: r.halted_by for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"a": None, "b": "hate", "c": "hate", "d": None}


def test_a_stream_that_goes_on(spark, tmp_path):
    """A trigger by time returns a running query."""
    folder = str(tmp_path / "in")
    add_file(spark, folder, [("a", "x", 0)])
    query = in_batches(file_stream(spark, folder, SCHEMA), lambda batch, _: batch.select("msg_id"), str(tmp_path / "out"),
                       str(tmp_path / "ck"), trigger={"processingTime": "200 milliseconds"})
    try:
        query.processAllAvailable()
        assert query.isActive and spark.read.parquet(str(tmp_path / "out")).count() == 1
        add_file(spark, folder, [("b", "y", 1)])
        query.processAllAvailable()
        assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    finally:
        query.stop()


# --- URLs --------------------------------------------------------------------------


def test_a_url_is_asked_again_only_after_expiry(spark, tmp_path):
    asked = spark.sparkContext.accumulator(0)
    folder = str(tmp_path / "in")

    def head(url):
        asked.add(1)
        return 404 if "bad" in url else 200

    def check(urls):
        return providers.check_urls(urls, F.col("url"), head).select("url", "status")

    policy = g.UrlCheck("urls", LAST)
    statuses = UrlStatuses(spark, str(tmp_path / "status"), check, expiry=30 * 60, merge=2)

    def step(batch, number):
        text = F.get_json_object("payload", "$.messages[0].content")
        known = statuses.of(batch, text, number, latest(batch, "ts"))
        return g.apply(batch, policy, g.Inputs(status=known)).select("msg_id", "outcome.passed")

    seen = []
    for k, minute in enumerate((0, 5, 29, 30, 100)):
        add_file(spark, folder, [(f"m{k}", "see http://one", minute), (f"n{k}", "see http://bad and http://one", minute),
                                 (f"o{k}", "nothing", minute)])
        in_batches(file_stream(spark, folder, SCHEMA, files=1), step, str(tmp_path / "out"), str(tmp_path / "ck"))
        seen.append(asked.value)
    assert seen == [2, 2, 2, 4, 6]
    got = {r.msg_id: r.passed for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {f"{c}{k}": c != "n" for c in "mno" for k in range(5)}
    assert all(p.at >= 100 * 60 - 3600 + latest(spark.sql("SELECT timestamp'2024-01-01' AS ts"), "ts") for p in statuses.table.parts())


# --- mappings ----------------------------------------------------------------------


def test_mappings_outlive_runs(spark, tmp_path):
    policy = g.PiiRegex("p", LAST, pii_entities=[EMAIL])
    folder = str(tmp_path / "in")

    def run():
        kept = Mappings(spark, str(tmp_path / "mappings"), expiry=3600, merge=2)

        def step(batch, number):
            masked = g.apply(batch, policy, flow="REQUEST")
            once = kept.add(masked, number, latest(batch, "ts"))
            assert kept.add(masked, number, 7).count() == once.count()  # a repeated batch
            return once

        in_batches(file_stream(spark, folder, SCHEMA, files=1), step, str(tmp_path / "out"), str(tmp_path / "ck"))
        return kept

    add_file(spark, folder, [("a", "to a@b.org", 0), ("b", "nothing", 0)])
    run()
    add_file(spark, folder, [("a", "to c@d.org", 10), ("c", "e@f.org", 10)])
    run()
    add_file(spark, folder, [("d", "g@h.org", 65)])
    kept = run()
    got = {r.msg_id: r.mapping[0].original for r in kept.current().collect()}
    assert got == {"a": "c@d.org", "c": "e@f.org", "d": "g@h.org"}
    answer = spark.createDataFrame([("a", "RESPONSE", payload("EMAIL_0000")), ("x", "RESPONSE", payload("EMAIL_0000"))],
                                   "msg_id string, direction string, payload string")
    back = g.apply(with_mapping(answer, kept.current()), policy, flow="RESPONSE")
    assert {r.msg_id: json.loads(r.payload_out)["messages"][0]["content"] for r in back.collect()} == {
        "a": "c@d.org", "x": "EMAIL_0000"}
    add_file(spark, folder, [("e", "i@j.org", 200)])
    assert {r.msg_id for r in run().current().collect()} == {"e"}


# --- reports -----------------------------------------------------------------------


def test_reports_follow_the_stream(spark, tmp_path):
    folder = str(tmp_path / "in")
    steps = [g.WordCount("w", LAST, min=1, max=1)]

    def run():
        report = report_stream(g.run_chain(file_stream(spark, folder, SCHEMA, files=1), steps), "halted_by",
                               window="10 minutes", late="20 minutes")
        keep_report(report, str(tmp_path / "table"), str(tmp_path / "ck"), merge=2)
        rows = read_report(spark, str(tmp_path / "table"), report.schema)
        return {(r.window_start.minute + 60 * r.window_start.hour, r.halted_by): r.messages for r in rows.collect()}

    add_file(spark, folder, [("a", "x", 1), ("b", "x y", 2), ("c", "x", 11)])
    assert run() == {(0, None): 1, (0, "w"): 1, (10, None): 1}
    add_file(spark, folder, [("d", "x", 3), ("e", "x", 50)])
    assert run() == {(0, None): 2, (0, "w"): 1, (10, None): 1, (50, None): 1}
    # the watermark stands at 30 by now: minute 4 is late, minute 40 is not
    add_file(spark, folder, [("f", "x", 4), ("g", "x", 40)])
    got = run()
    assert got == {(0, None): 2, (0, "w"): 1, (10, None): 1, (50, None): 1, (40, None): 1}
    timely = g.run_chain(spark.read.parquet(folder).where("msg_id <> 'f'"), steps)
    batch = {r.halted_by: r.messages for r in g.policy_report(timely, "halted_by").collect()}
    assert {h: sum(n for (_, x), n in got.items() if x == h) for h in (None, "w")} == batch


# --- timers ------------------------------------------------------------------------


def test_restore_by_timers(spark, tmp_path):
    asked = [("a", "mail a@b.org", 0), ("b", "nothing", 0), ("c", "x@y.org", 5), ("late", "l@m.org", 0)]
    answered = [("a", "to EMAIL_0000", 1), ("a", "once more EMAIL_0000", 2), ("c", "EMAIL_0000!", 4), ("c", "EMAIL_0000!", 6),
                ("late", "EMAIL_0000", 30), ("alone", "EMAIL_0000", 1)]
    policy = g.PiiRegex("p", LAST, pii_entities=[EMAIL])

    def run():
        read = [file_stream(spark, str(tmp_path / n), SCHEMA) for n in ("req", "resp")]
        answers = read[1].withColumn("direction", F.lit("RESPONSE"))
        restored = restore_by_timers(read[0], answers, policy, within_seconds=600, late="1 minute")
        drain(restored, str(tmp_path / "out"), str(tmp_path / "ck"))
        rows = spark.read.parquet(str(tmp_path / "out")).collect()
        return sorted((r.msg_id, json.loads(r.payload_out)["messages"][0]["content"]) for r in rows)

    add_file(spark, str(tmp_path / "req"), asked)
    add_file(spark, str(tmp_path / "resp"), answered)
    # what came before its request is not restored, nor is "late", which came behind the
    # bound; the watermark stands at minute 29, so that "alone" waits for nobody
    done = [("a", "once more a@b.org"), ("a", "to a@b.org"), ("alone", "EMAIL_0000"), ("c", "EMAIL_0000!"),
            ("c", "x@y.org!"), ("late", "EMAIL_0000")]
    assert run() == done
    # a restart with later messages
    add_file(spark, str(tmp_path / "req"), [("end", "nothing", 90)])
    add_file(spark, str(tmp_path / "resp"), [("end", "bye", 90)])
    run()
    add_file(spark, str(tmp_path / "resp"), [("end", "bye again", 91)])
    assert run() == sorted([*done, ("end", "bye"), ("end", "bye again")])


def test_timers_leave_no_state_behind(spark, tmp_path):
    policy = g.PiiRegex("p", LAST, pii_entities=[EMAIL])
    add_file(spark, str(tmp_path / "req"), [(f"m{i}", "a@b.org", 0) for i in range(20)])
    add_file(spark, str(tmp_path / "resp"), [(f"m{i}", "EMAIL_0000", 1) for i in range(20)])
    kept = []
    for minute in (0, 90, 91):
        if minute:
            add_file(spark, str(tmp_path / "req"), [(f"end{minute}", "nothing", minute)])
        read = [file_stream(spark, str(tmp_path / n), SCHEMA) for n in ("req", "resp")]
        restored = restore_by_timers(read[0], read[1].withColumn("direction", F.lit("RESPONSE")), policy, within_seconds=600)
        query = drain(restored, str(tmp_path / "out"), str(tmp_path / "ck"))
        kept.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert kept[0] == 20 and kept[-1] <= 2
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20


def test_files_of_a_micro_batch_grow_with_the_table(spark, tmp_path, monkeypatch):
    """Four micro-batches whatever the size, and as many files as the table has tasks."""
    from gatewright.plans import queries
    from gatewright.streaming.asking import in_batches

    spark.range(4000).repartition(12).write.parquet(str(tmp_path / "rows.parquet"))
    monkeypatch.setattr(queries, "work_folder", lambda spark, name: str(tmp_path / name))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        stream = queries._in_files(spark, str(tmp_path), "rows")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(list((tmp_path / "stream-rows").glob("*.parquet"))) >= 12
    counts = []

    def step(batch, number):
        counts.append(batch.count())
        return batch

    in_batches(stream, step, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert len(counts) == 4 and sum(counts) == 4000
    assert spark.read.parquet(str(tmp_path / "out")).distinct().count() == 4000
