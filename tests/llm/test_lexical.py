"""Ranked search against a plain scan of all documents for every item."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from gatewright.llm import lexical as lx

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, top=10):
    vectors = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    vectors = [v for v in vectors if v[2]]
    n_docs, n_terms = len(vectors), sum(v[2] for v in vectors)
    df = Counter(t for _, tf, _ in vectors for t in tf)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(terms(t))
    out = []
    for item, wanted in asked.items():
        scored = []
        for doc, tf, n in vectors:
            m = 10 + 90 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10 ** 9 * tf[t] // (1000 * tf[t] + 8 * m)) for t in wanted if t in tf)
            if score > 0:
                scored.append((-score, doc is None, doc))
        out += [(item, r + 1, doc, -score) for r, (score, _, doc) in enumerate(
            sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:top])]
    return out


def key(row):
    return repr(row[0]), row[1]


@pytest.fixture()
def corpus(rng):
    words = [f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(400)] + ["Añb", "É", "x-y", "漢字", "a1B2"]
    docs = [" ".join(rng.choices(words, k=rng.randint(0, 60))) for _ in range(900)]
    docs += ["w1 w2 w3 w4"] * 150 + [None, "", "...", "W1,w2;É", " ".join(["w7"] * 5000 + ["w9"])]
    items = [(i, " ".join(rng.choices(words, k=rng.randint(1, 20)))) for i in range(25)]
    items += [(100, None), (101, "!!"), (102, "unheard of"), (103, "w1"), (103, "W2 w1"), (None, "w5 w6"), (104, "w1 w2 w3 w4")]
    return docs, items


def found(spark, documents, docs, items, **options):
    table = spark.createDataFrame([(i, t, 3) for i, t in items], "item_id int, text string, rank int")
    rows = lx.search(documents(docs), table, **options).collect()
    return sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in rows], key=key)


def test_equals_a_scan(spark, documents, corpus):
    docs, items = corpus
    assert found(spark, documents, docs, items) == sorted(brute(list(enumerate(docs)), items), key=key)


@pytest.mark.parametrize("trees, leaf, block", [(50, 1, 16), (200, 4, 1), (7, 32, 10_000)])
def test_trees_leaves_and_blocks_do_not_matter(spark, documents, corpus, monkeypatch, trees, leaf, block):
    docs, items = corpus
    monkeypatch.setattr(lx, "TREE_DOCUMENTS", trees)
    monkeypatch.setattr(lx, "LEAF", leaf)
    got = found(spark, documents, docs, items[-12:], top=3, block_terms=block)
    assert got == sorted(brute(list(enumerate(docs)), items[-12:], 3), key=key)


def test_bounds_hold_and_leave_subtrees_out(rng):
    """Every node's bound is at least the score of each document below it."""
    docs = [sorted(rng.sample(range(40), rng.randint(1, 12))) for _ in range(600)]
    ends = np.cumsum([0, *map(len, docs)])
    t = np.concatenate(docs)
    tf = np.array([rng.randint(1, 9) for _ in t])
    m = np.array([rng.randint(10, 500) for _ in docs])
    df = np.bincount(t, minlength=40)
    order = np.empty(40, np.int64)
    order[np.argsort(-df)] = np.arange(40)
    tree = lx.DocumentTree(order, ends, t, tf, m)
    item, w = np.array([3, 8, 21, 30]), np.array([5, 900, 40, 3000])
    assert len(tree.nodes) > 10 and sorted(tree.rows.tolist()) == list(range(600))
    for (lo, hi, _), most, least in zip(tree.nodes, tree.most_of, tree.least_of):
        bound = (w * lx.part_score(most[item], least)).sum()
        for d in range(lo, hi):
            a, b = tree.ends[d], tree.ends[d + 1]
            score = sum(w[item.tolist().index(x)] * lx.part_score(y, tree.m[d])
                        for x, y in zip(tree.t[a:b].tolist(), tree.tf[a:b]) if x in item)
            assert score <= bound
    looked = []
    tree.nodes = [Looked(n, looked) for n in tree.nodes]
    tree.search(item, w, list(range(600)), [], np.full(40, -1))
    assert 0 < len(looked) < len(tree.nodes)


class Looked(tuple):
    def __new__(cls, node, seen):
        made = super().__new__(cls, node)
        made.seen = seen
        return made

    def __iter__(self):
        self.seen.append(self)
        return super().__iter__()


def test_ids_that_are_null_or_repeat(spark, documents):
    docs, ids = ["w1 w2", "w1 w2", "w1 w2", "w3", None], [None, 5, 5, 6, 7]
    table = spark.createDataFrame([(1, "w1")], "item_id int, text string")
    rows = lx.search(documents(docs, ids=ids), table).orderBy("rank").collect()
    assert [(r["rank"], r.doc_id) for r in rows] == [(1, 5), (2, 5), (3, None)]
    assert len({r.score for r in rows}) == 1


def test_empty_tables(spark, documents, corpus):
    empty = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "w1")], "item_id int, text string")
    assert lx.search(empty, items).collect() == []
    assert lx.search(documents(corpus[0]), items.where("false")).collect() == []
    assert lx.search(documents([None, ""]), items).collect() == []
