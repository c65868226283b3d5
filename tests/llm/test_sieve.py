import numpy as np
import pytest
from pyspark.sql import functions as F

from gatewright.llm import near_copies as near
from gatewright.llm import sieve as sv
from gatewright.llm import suffix_array as sa


@pytest.mark.parametrize("most", [1 << 10, 1 << 25])
def test_a_sieve_loses_no_key(spark, monkeypatch, most):
    monkeypatch.setattr(sv, "MOST_BITS", most)
    rows = spark.range(20_000).select(F.xxhash64("id").alias("x"))
    keys = rows.limit(3000).localCheckpoint()
    words = sv.sieve(keys, F.col("x"))
    held = {r.x for r in keys.collect()}
    by = {r.x for r in sv.sieved(rows, words, F.col("x")).collect()}
    rest = {r.x for r in sv.sieved(rows, words, F.col("x"), out=True).collect()}
    assert held <= by and not by & rest and len(by) + len(rest) == 20_000
    assert len(words) * 64 <= most and (most == 1 << 10 or len(by) < 5000)


def test_no_keys_let_nothing_by(spark):
    words = sv.sieve(spark.range(0).select(F.col("id").alias("x")), F.col("x"))
    assert not sv.may_hold(words, np.array([-1, 0, 5], np.int64)).any()


def test_crowded_posts_are_those_of_a_join(spark, documents):
    texts = [f"eight words that all of these texts share own{i}" for i in range(50)] + ["", None, "one"]
    nodes = near.marked(documents(texts), "doc_id", "text").select(F.col("doc_id").alias("k"), "n", "prefix")
    posts = nodes.select("k", "n", F.posexplode("prefix").alias("p", "s"))
    crowded = posts.groupBy("s").count().where("count > 1").select("s")
    want = posts.join(crowded, "s").select("s", "k", "n", "p").collect()
    got = near.crowded_posts(nodes, crowded).select("s", "k", "n", "p").collect()
    assert want and sorted(map(tuple, got)) == sorted(map(tuple, want))


def shuffled_bytes(spark, work):
    """Bytes that ``work`` writes to shuffles, by the exchanges' own metrics, all joins by sorted shuffles."""
    seen = []
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = work()._jdf.queryExecution()
        plan.toRdd().count()

        def walk(node):
            name = node.nodeName()
            if name == "AdaptiveSparkPlan":
                return walk(node.executedPlan())
            if name == "ShuffleQueryStage":
                seen.append(node.shuffle().metrics().apply("shuffleBytesWritten").value())
                return walk(node.shuffle().child())
            for i in range(node.children().size()):
                walk(node.children().apply(i))

        walk(plan.executedPlan())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    return sum(seen)


def test_texts_that_stay_do_not_move(spark, documents, rng, tmp_path):
    """Of 400 texts one goes: nearly all stay where they are read."""
    words = [f"v{i}" for i in range(20_000)]
    texts = [" ".join(rng.choices(words, k=100)) for _ in range(400)]
    texts.append(f"{texts[0]} more")
    documents(texts).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    assert shuffled_bytes(spark, lambda: near.keep_one(docs)) < sum(map(len, texts)) / 10


def test_few_of_all_texts_move(spark, documents, rng, tmp_path, monkeypatch):
    """Whole texts meet only where they may be asked for: two of 300 repeat a passage, and two are similar."""
    words = [f"v{i}" for i in range(20_000)]
    passage = " ".join(rng.choices(words, k=120))
    texts = [" ".join(rng.choices(words, k=150)) for _ in range(300)]
    documents([*texts, f"one {passage} end", f"two {passage} stop"]).write.parquet(str(tmp_path / "d"))
    docs, moved = spark.read.parquet(str(tmp_path / "d")), {}
    for module in (sa, near):
        monkeypatch.setattr(module, "stored", lambda df, purpose, real=module.stored: (
            moved.setdefault(purpose, shuffled_bytes(spark, lambda: df)), real(df, purpose))[1])
    kept = {r.doc_id: r.text for r in sa.remove(docs, words=50).collect()}
    assert kept[300] == "oneend" and kept[301] == "twostop"
    assert [kept[i] for i in range(300)] == texts
    assert moved["shared-texts"] < sum(map(len, texts)) / 8
    nodes = near.marked(docs, "doc_id", "text").withColumnRenamed("doc_id", "k").localCheckpoint()
    pairs = spark.createDataFrame([(300, 301)], "a long, b long")
    assert [tuple(r) for r in near.verified(pairs, nodes, docs, "text").collect()] == [(300, 301)]
    assert moved["sets"] < sum(map(len, texts)) / 8
