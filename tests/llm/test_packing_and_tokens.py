import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gatewright.llm import packing as pk
from gatewright.llm import tokens as tk

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_library(texts, rng):
    encoder = tk.Encoder()
    odd = ["".join(rng.choice("ab 's'T'll  \n\t\r12é½²ß÷×ªº.,! ſ　\x85\x1c漢😀AZ") for _ in range(rng.randint(1, 30)))
           for _ in range(500)]
    for text in [*texts, *odd, "a<|endoftext|>b", "x" * 3000, " " * 500]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids(text), repr(text)


def test_pieces_are_placed_without_gaps(documents, texts):
    rows = pk.pack(documents(texts), 64).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(range(len(texts)))
    for i, pieces in by_doc.items():
        all_ids = np.array([*ids(texts[i]), 0], "<u4")
        at = 0
        for k, r in enumerate(sorted(pieces, key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at) and (r.length == 64 or k == 0)
            assert r.ids_crc32 == zlib.crc32(all_ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(all_ids) and (len(pieces) == 1) == (len(all_ids) <= 64)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    assert len(by_sequence) <= math.ceil(sum(r.length for r in rows) / 64) * 1.05 + 1


@pytest.mark.parametrize("shape", ["uniform", "short", "long", "few", "one"])
def test_packed_histograms(shape):
    rng = np.random.default_rng(3)
    sizes = {"uniform": rng.integers(1, 257, 20000), "short": np.minimum(256, 1 + rng.exponential(30, 20000)).astype(int),
             "long": 257 - np.minimum(256, 1 + rng.exponential(20, 5000)).astype(int), "few": np.array([200, 60, 56, 3]),
             "one": np.array([1])}[shape]
    histogram = Counter(sizes.tolist())
    packed = pk.pack_histogram(histogram, 256)
    used = Counter()
    for pattern, count in packed:
        assert sum(pattern) <= 256 and count > 0
        for n in pattern:
            used[n] += count
    assert used == histogram
    best = sum(c for _, c in pk._best_fit(dict(histogram), [], 256))
    assert sum(c for _, c in packed) <= best * 1.01 + 1
    assert pk.pack_histogram({}, 256) == []


def test_fit_reproduces_a_mix_of_patterns():
    columns = pk.patterns(16)
    truth = np.zeros(len(columns))
    truth[[0, 5, 11]] = 40, 7, 21
    target = np.zeros(17)
    for slot in range(3):
        np.add.at(target, columns[:, slot], truth)
    target[0] = 0
    x = pk.fit(columns, target)
    got = np.zeros(17)
    for slot in range(3):
        np.add.at(got, columns[:, slot], x)
    assert (x >= 0).all() and np.allclose(got[1:], target[1:], atol=0.5)


def test_numbering_has_no_gaps(documents, texts):
    docs = documents([*texts, *texts])
    rows = pk.numbered(pk.pieces(docs, 32), chunk=10).collect()
    by_length = {}
    for r in rows:
        by_length.setdefault(r.length, []).append(r["rank"])
    assert all(sorted(v) == list(range(len(v))) for v in by_length.values())


def test_odd_tables(documents):
    assert pk.pack(documents([])).count() == 0
    got = pk.pack(documents(["a", "a", None], ids=[1, 1, None])).collect()
    assert sorted((r.doc_id or 0, r.length) for r in got) == [(0, 1), (1, 2), (1, 2)]


def test_token_counts(documents, texts):
    sizes = [len(ids(t)) for t in texts]
    table = tk.length_histogram(tk.lengths(documents(texts)))
    rows = {r.n_tokens: r for r in table.collect()}
    assert set(rows) == set(sizes)
    for n, r in rows.items():
        assert r.n_docs == sizes.count(n) and r.docs_at_least == sum(s >= n for s in sizes)
        assert r.tokens_at_least == sum(s for s in sizes if s >= n) and r.tokens_total == sum(sizes)
        assert r.truncated_total == sum(min(s, n) for s in sizes) and r.docs_total == len(sizes)
    for r in tk.at_limits(table, [0, 1, 7, 50, 10 ** 6]).collect():
        assert r.truncated_total == sum(min(s, r.context) for s in sizes)
        assert r.docs_cut == sum(s > r.context for s in sizes)
    for r in tk.quantiles(table, [0.1, 0.5, 1.0]).collect():
        assert sum(s <= r.n_tokens for s in sizes) >= r.share * len(sizes)
        assert sum(s < r.n_tokens for s in sizes) < r.share * len(sizes)
    empty = tk.length_histogram(tk.lengths(documents([])))
    assert empty.count() == 0
    assert [tuple(r) for r in tk.at_limits(empty, [5]).collect()] == [(5, 0, 0, 0)]


def test_suffix_sums_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(tk, "BLOCK", 3)
    sizes = [0, 0, 1, 2, 3, 5, 5, 8, 13, 21]
    df = spark.createDataFrame([(s,) for s in sizes], "n_tokens long")
    for r in tk.length_histogram(df).collect():
        assert r.truncated_total == sum(min(s, r.n_tokens) for s in sizes)
        assert r.docs_at_least == sum(s >= r.n_tokens for s in sizes)
