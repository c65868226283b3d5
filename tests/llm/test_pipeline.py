"""The pipeline against plain versions of its stages."""

import re
from collections import Counter

import pytest

import corpus_pipeline
from gatewright.llm import quality_rules
from tests.llm.test_decontaminate import brute as benchmark_hits
from tests.llm.test_near_copies import classes
from tests.llm.test_quality_rules import brute as measures
from tests.llm.test_simhash import plain_fingerprint
from tests.llm.test_suffix_array import brute as repeats
from tests.llm.test_suffix_array import passage_brute


@pytest.fixture()
def folder(spark, rng, tmp_path):
    words = [f"word{i}" for i in range(500)]
    passage = " ".join(rng.choices(words, k=90))
    short = " ".join(rng.choices("abcdefghij", k=52))  # far under 400 bytes
    item = "this exact question of the test set has more than ten words in it"
    rows = []
    for i in range(40):
        body = rng.choices(words, k=rng.randint(60, 160))
        text = " ".join(body)
        if i % 10 == 3:
            text = f"{text} {passage} {' '.join(rng.choices(words, k=30))}"
        if i % 10 == 6:
            text = f"{text} {short} {' '.join(rng.choices(words, k=30))}"
        if i % 13 == 5:
            text = f"{item.upper()} {text}"
        rows.append((i, text))
    rows += [(100 + i, rows[i][1]) for i in range(5)]
    # near copies by shingles that differ in more than two bits of a fingerprint
    for i in (1, 2):
        copy = rows[i][1].split()
        copy[len(copy) // 2] = "other"
        rows.append((300 + i, " ".join(copy + ["end"])))
    rows += [(200, "too short"), (201, None), (202, ""), (203, "again and " * 60), (None, " ".join(rng.choices(words, k=70)))]
    rows.append(rows[7])
    full = [(i, t, "en", "s", len(t or ""), "extra") for i, t in rows]
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, maybe string"
                          ).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path), rows, item


def test_every_stage(spark, folder):
    path, rows, item = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, path), "stage")
        seen[name] = docs
        if name != "packing":
            assert docs.columns == columns
    # too few labels for cutoffs: the base filter alone
    good = [(i, t) for i, t in rows if measures(t)[0] >= 50 and 2 * measures(t)[4] <= measures(t)[0]]
    got = [(r.doc_id, r.text) for r in seen["quality rules"].collect()]
    assert sorted(got, key=repr) == sorted(good, key=repr)
    # one of each class, the row without an id, and the repeated row once
    first = sorted(dict(good).items(), key=lambda r: (r[0] is None, r[0] or 0))
    root = classes([t for _, t in first])
    kept = [row for k, row in enumerate(first) if root[k] == k]
    assert not any(i in (301, 302) for i, _ in kept)
    assert all(bin(plain_fingerprint(dict(good)[i]) ^ plain_fingerprint(dict(good)[300 + i])).count("1") > 2 for i in (1, 2))
    got = [(r.doc_id, r.text) for r in seen["near-duplicates"].collect()]
    assert sorted(got, key=repr) == sorted(kept, key=repr)
    texts = [t for _, t in kept]
    cut = {i: n for (i, _), n in zip(kept, passage_brute(texts, 50, 400, 400))}
    assert sum(cut.values()) > sum(n for _, n, *_ in repeats(texts, 400)) > 0
    after = {r.doc_id: r.text for r in seen["repeated strings"].collect()}
    assert {i: len(t) - len(after[i]) for i, t in kept} == cut  # plain ASCII: nothing is rounded
    clean = {r.doc_id: r.text for r in seen["benchmark passages"].collect()}
    for i, text in after.items():
        hit = benchmark_hits(text, [(1, item)], 10)[1]
        assert benchmark_hits(clean[i], [(1, item)], 10)[1] == 0
        assert (clean[i] == text) == (hit == 0)
        assert len(re.findall(r"\w+", text)) - len(re.findall(r"\w+", clean[i])) == hit
    packed = seen["packing"].collect()
    assert {r.doc_id for r in packed} == {i for i, t in clean.items() if t} and max(Counter(
        (r.sequence_id, r.offset) for r in packed).values()) == 1


def test_run_gives_the_last_stage(spark, folder):
    path, _, _ = folder
    assert set(corpus_pipeline.run(spark, path).columns) >= {"doc_id", "piece", "sequence_id", "offset"}


def test_nothing_in_nothing_out(spark, folder, tmp_path):
    path, _, _ = folder
    empty = tmp_path / "none"
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{path}/{name}.parquet").where("false").write.parquet(str(empty / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(empty)).collect() == []


def test_stages_leave_no_tables_behind(spark, folder):
    """What a stage needed is gone when the next one has started."""
    from gatewright import session

    path, _, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        made = list(corpus_pipeline._left)
        out = stage(spark, docs, path)
        assert not set(made) & set(session._folders)
        docs = corpus_pipeline.stored(out, "stage")


def test_rules_take_part_where_labels_allow(spark, rng):
    """Bad documents are shouted; cutoffs come from the labelled ones and hold for the others."""
    words = [f"w{i}" for i in range(900)]
    rows, labels = [], []
    for i in range(6000):
        good = i % 5 != 0
        text = rng.choices(words, k=60)
        rows.append((i, " ".join(text if good else [w + "!" for w in text])))
        if i < 5500:
            labels.append((i, int(good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    kept = {r.doc_id for r in quality_rules.filter_documents(docs, known, stratum_col=None).collect()}
    assert kept == {i for i in range(6000) if i % 5}
