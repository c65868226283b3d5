import random

import numpy as np
import pytest
from pyspark.sql import Window

import corpus_pipeline
from gatewright.llm import near_copies as near


def shingle_set(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
    if not words:
        return frozenset()
    return frozenset(" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def classes(texts):
    """Number of the first text reachable, by comparing all pairs."""
    sets, root = [shingle_set(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            either = len(sets[i] | sets[j])
            if either == 0 or 5 * len(sets[i] & sets[j]) >= 4 * either:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    return root


@pytest.fixture()
def copies(rng):
    """Texts, copies with words put in, out and changed, shared passages, and short ones."""
    words = [f"w{i}" for i in range(400)]
    passage = rng.choices(words, k=40)
    out = []
    for i in range(25):
        text = rng.choices(words, k=rng.randint(5, 150))
        if i % 3 == 0:
            text = passage + text
        out.append(" ".join(text))
        for _ in range(rng.choice([0, 1, 4])):
            for _ in range(rng.randint(0, 4)):
                text = list(text)
                at = rng.randrange(len(text))
                text[at:at + rng.randint(0, 2)] = rng.choices(words, k=rng.randint(0, 2))
                text = text or ["w"]
            out.append(" ".join(text))
    return [*out, out[0].upper(), out[3], None, "", " \n", "one", "One", "one two", "a b c d e", "a b c d e f"]


@pytest.mark.parametrize("large", [2, 5, 256])
def test_classes_equal_all_pairs(documents, copies, large):
    rows = near.near_copies(documents(copies), large=large).collect()
    want = classes(copies)
    assert len(rows) == len(copies) and len(set(want)) < len(want) - 20
    got = {}
    for r in rows:
        got[r.root] = min(got.get(r.root, r.doc_id), r.doc_id)
    assert [got[r.root] for r in sorted(rows, key=lambda r: r.doc_id)] == want


def test_frequent_shingles_come_last():
    hashes = np.arange(20)
    assert near.prefix(hashes, np.array([0, 1]), np.array([9, 7])).tolist() == [2, 3, 4, 5, 6]
    assert near.prefix(hashes[:1], hashes[:0], hashes[:0]).tolist() == [0]


def through_stages(spark, docs):
    one = corpus_pipeline.stored(corpus_pipeline.drop_near_duplicates(spark, docs, ""), "stage")
    return one, corpus_pipeline.cut_repeats(spark, one, "")


def test_planted_near_copy_goes(spark, documents):
    """A copy with some words changed, far more than two bits away; its partner keeps its whole text."""
    rng = random.Random(3)
    text = rng.choices([f"word{i}" for i in range(900)], k=300)
    copy = list(text)
    for at in (10, 90, 170, 250):
        copy[at] = "other"
    text, copy = " ".join(text), " ".join(copy)
    one, cut = through_stages(spark, documents([text, copy, "more words " * 9], ids=[4, 2, 9]))
    assert sorted(r.doc_id for r in one.collect()) == [2, 9]
    assert {r.doc_id: r.text for r in cut.collect()}[2] == copy


def test_rows_without_id_take_part(spark, documents):
    rng = random.Random(5)
    known, unknown, alone = (" ".join(rng.choices([f"word{i}" for i in range(900)], k=120)) for _ in range(3))
    docs = documents([known, known, unknown, unknown, unknown + " end", alone], ids=[3, None, None, None, None, 8])
    one, cut = through_stages(spark, docs)
    got = sorted(((r.doc_id, r.text) for r in cut.collect()), key=repr)
    assert len(got) == 3 and (3, known) in got and (8, alone) in got
    assert any(i is None and t in (unknown, unknown + " end") for i, t in got)


def common_shingles(n):
    """Eight words that all texts share and one of their own: similarity 2/3."""
    return [f"eight words that all of these texts share own{i}" for i in range(n)]


@pytest.mark.parametrize("large", [3, 50])
def test_large_groups_equal_all_pairs(documents, rng, large):
    """One common shingle; texts with more of their own or of the common ones are linked or not."""
    texts = common_shingles(60)
    for i in range(60):
        own = [f"x{i}y{j}" for j in range(rng.randint(0, 3))]
        texts.append(" ".join([*"it is a very common line of words that comes again and again in texts".split()[:rng.randint(8, 14)], *own]))
    rows = near.near_copies(documents(texts), large=large).collect()
    got = {}
    for r in rows:
        got[r.root] = min(got.get(r.root, r.doc_id), r.doc_id)
    want = classes(texts)
    assert [got[r.root] for r in sorted(rows, key=lambda r: r.doc_id)] == want
    assert len(set(want)) > 61


def test_a_common_shingle_costs_no_pairs(spark, documents):
    """2,000 texts share a shingle and none is similar: no pair is written, whoever meets."""
    texts = common_shingles(2000)
    rows = near.marked(documents(texts), "doc_id", "text")
    posts = rows.select(near.F.col("doc_id").alias("k"), "n", near.F.posexplode("prefix").alias("p", "s")).select(
        "s", "k", "n", near.F.col("p").cast("long").alias("p"))
    told = near.meetings(posts, 256).collect()
    assert [r.kind for r in told] == [near.LARGE]
    often = posts.where(near.F.col("s") == told[0].a).withColumn("root", near.F.col("k"))
    assert near.unlinked(often).count() == 0


def test_empty_table_and_very_long_text(documents):
    assert near.keep_one(documents([])).collect() == []
    long = " ".join(f"w{i}" for i in range(30_000))
    kept = near.keep_one(documents([long, long + " more", long[:1000], None, ""])).collect()
    assert sorted(r.doc_id for r in kept) == [0, 2, 3]


def test_a_large_group_is_not_held(documents, monkeypatch):
    """A group of more rows than a block goes by in parts and is told once."""
    monkeypatch.setattr(near, "BLOCK", 50)
    texts = [*common_shingles(400), "a b c d e f", "a b c d e f g h i j k"]
    rows = near.near_copies(documents(texts), large=20).collect()
    assert len({r.root for r in rows}) == len(set(classes(texts)))


def few_bits_apart(rng):
    """A text and a copy with a word more, one or two bits apart."""
    while True:
        text = " ".join(rng.choices([f"word{i}" for i in range(900)], k=200))
        copy = f"{text} end"
        if bin(near.fingerprint(text) ^ near.fingerprint(copy)).count("1") in (1, 2):
            return text, copy


def test_simhash_links_and_texts_it_links_do_not_meet_again(spark, documents, rng, monkeypatch):
    text, copy = few_bits_apart(rng)
    docs = documents([text, copy, "other words " * 30], ids=[5, 3, 8])
    meetings, met = near.meetings, []

    def none(posts, large):
        met.append(meetings(posts, large).count())
        return spark.createDataFrame([], near.MEETING)

    monkeypatch.setattr(near, "meetings", none)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted(r.doc_id for r in kept) == [3, 8] and met == [0]


def test_simhash_links_are_verified(documents, monkeypatch):
    """One fingerprint for all: texts that are not similar stay apart."""
    texts = ["a b c d e f g", "h i j k l m n", "a b c d e f g", "o p"]
    nodes = near.near_copies(documents(texts)).collect()
    monkeypatch.setattr(near, "sketched", lambda nodes: nodes.select(near.F.min("k").over(
        Window.partitionBy()).alias("a"), near.F.col("k").alias("b")).where("a < b"))
    found = near.near_copies(documents(texts)).collect()
    assert len({r.root for r in found}) == len({r.root for r in nodes}) == 3


def test_sketches_rule_out_only_what_differs(rng, copies):
    words = [f"v{i}" for i in range(3000)]
    every = [*copies, *(" ".join(rng.choices(words, k=k)) for k in (300, 2000, 5000))]
    sets = [near.shingles(t)[1] for t in every]
    sketches = [near.sketch(x) for x in sets]
    for a, x in zip(sets, sketches):
        for b, y in zip(sets, sketches):
            assert int(np.bitwise_count((x ^ y).view(np.uint64)).sum()) <= len(np.setxor1d(a, b))


def test_texts_that_share_a_passage_make_no_pair(spark, documents, rng):
    """A shingle of many texts pairs those that are similar, not all that hold it."""
    words = [f"v{i}" for i in range(20_000)]
    passage = rng.choices(words, k=150)
    texts = [" ".join(passage + rng.choices(words, k=200)) for _ in range(60)]
    texts += [f"{texts[0]} more", f"{texts[1]} more"]
    rows = near.marked(documents(texts), "doc_id", "text").drop("prefix", "words", "th", "fp")
    one = near.shingles(" ".join(passage[:5]))[1][0].item()
    often = rows.select(near.F.lit(one).alias("s"), near.F.col("doc_id").alias("k"), "n",
                        near.F.lit(0).cast("long").alias("p"), near.F.col("doc_id").alias("root"), "sketch")
    assert sorted(map(tuple, near.unlinked(often).collect())) == [(0, 60), (1, 61)]
    nodes = rows.withColumnRenamed("doc_id", "k")
    every = nodes.select(near.F.col("k").alias("a")).join(nodes.select(near.F.col("k").alias("b"))).where("a < b")
    assert sorted(map(tuple, near.unruled(every, nodes).collect())) == [(0, 60), (1, 61)]


def test_wide_sketches_rule_out_only_what_differs(spark, rng):
    """Long texts, at sizes around a power of two, where the wider sketch is folded."""
    words = [f"v{i}" for i in range(100_000)]
    long = rng.choices(words, k=2040)
    texts = [long, [*long, *rng.choices(words, k=30)], [*long, *rng.choices(words, k=400)], long[:1500], long[:1020],
             [*long[:100], *rng.choices(words, k=1900)], [*long[:100], *rng.choices(words, k=2200)]]
    sets = [near.shingles(" ".join(t))[1] for t in texts]
    rows = [(i, len(s), near.wide_sketch(s).tolist()) for i, s in enumerate(sets)]
    assert [len(r[2]) for r in rows] == [32, 64, 64, 32, 0, 32, 64]
    frame = spark.createDataFrame(rows, "k long, n long, w array<long>")
    both = frame.toDF("a", "na", "wa").crossJoin(frame.toDF("b", "nb", "wb")).where(
        "na < nb and 5 * na >= 4 * nb or a = b")
    both = both.withColumn("close", near.may_be_close(*map(near.F.col, ("wa", "wb", "na", "nb"))))
    told = {(r.a, r.b): r.close for r in both.collect()}
    for (a, b), close in told.items():
        alike = 5 * len(np.intersect1d(sets[a], sets[b])) >= 4 * len(np.union1d(sets[a], sets[b]))
        assert close or not alike
    assert told[0, 1] and told[0, 2] and not told[5, 0] and not told[0, 6] and not told[5, 2]


def test_long_texts_that_share_a_passage_move_no_sets(spark, documents, rng, tmp_path, monkeypatch):
    """Whole sets are larger than their texts: only those that may be similar are made, however long texts are."""
    words = [f"v{i}" for i in range(100_000)]
    passage = rng.choices(words, k=400)
    texts = [" ".join(passage + rng.choices(words, k=4000)) for _ in range(24)]
    texts += [f"{texts[0]} {' '.join(rng.choices(words, k=300))}"]
    documents(texts).write.parquet(str(tmp_path / "d"))
    docs, sets = spark.read.parquet(str(tmp_path / "d")), []
    monkeypatch.setattr(near, "stored", lambda df, purpose, real=near.stored: (
        sets.append(df.count()) if purpose == "sets" else None, real(df, purpose))[1])
    for large in (5, 50):
        rows = near.near_copies(docs, large=large).collect()
        assert len({r.root for r in rows}) == 24 and sum(sets) <= 4
        sets.clear()
