import hashlib
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from gatewright.llm import suffix_array as sa


def brute(texts, width):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + width] for d in data for i in range(len(d) - width + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - width + 1):
            if seen[d[i:i + width]] > 1:
                gone[i:i + width] = b"\1" * width
        kept = bytes(c for c, x in zip(d, gone) if not x)
        spans = sum(1 for i, x in enumerate(gone) if x and not (i and gone[i - 1]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.fixture()
def corpus(rng):
    """Pieces of a few texts put together at random, with runs of one letter."""
    base = ["".join(rng.choice("abcé") for _ in range(rng.randint(0, 200))) for _ in range(30)]
    out = []
    for _ in range(150):
        text = ""
        for _ in range(rng.randint(0, 4)):
            piece = rng.choice(base)
            at = rng.randint(0, len(piece))
            text += piece[at:at + rng.randint(0, 120)]
            if rng.random() < 0.3:
                text += rng.choice("ab") * rng.randint(0, 60)
        out.append(text)
    return [*out, *out[:8], "", None, "a" * 500, "ab" * 300, "a" * 501, "abc" * 5]


@pytest.mark.parametrize("width,gram,large", [(16, 4, 10 ** 6), (24, 8, 2), (20, 16, 5), (33, 1, 10 ** 6)])
def test_repeats_equal_brute_force(documents, corpus, width, gram, large):
    """``large`` sends anchors to the hashes of their windows."""
    got = sa.repeat_report(documents(corpus), width=width, gram=gram, large=large).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == brute(corpus, width)


def test_anchors_cover_every_window_once(rng):
    for _ in range(60):
        data = bytes(rng.choices(b"ab" if rng.random() < 0.5 else range(256), k=rng.randint(0, 300)))
        places, tied = sa.anchors_of(data, 20, 4)
        starts = [s for _, lo, hi, _ in places for s in range(lo, hi + 1)] + list(tied)
        assert sorted(starts) == list(range(max(0, len(data) - 19)))
        assert all(lo <= lo + off <= lo + 16 for _, lo, hi, off in places)


def test_column_rounds_in_batches(rng):
    """Several collections in one set of rounds don't mix."""
    for _ in range(20):
        group, off, texts = [], [], []
        for g in range(rng.randint(1, 4)):
            for _ in range(rng.randint(1, 12)):
                group.append(g)
                off.append(rng.randint(0, 10))
                texts.append(bytes(rng.choices(b"ab", k=off[-1] + rng.randint(8, 20))))
        rows, first, last = sa.column_rounds(np.array(group), np.array(off), texts, 8)
        got = {(r, s) for r, a, b in zip(rows.tolist(), first.tolist(), last.tolist()) for s in range(a, b + 1)}
        windows = {}
        for i, text in enumerate(texts):
            for s in range(min(off[i], len(text) - 8) + 1):
                windows.setdefault((group[i], s - off[i], text[s:s + 8]), []).append((i, s))
        assert got == {x for same in windows.values() if len(same) > 1 for x in same}


def test_removal(documents, corpus):
    docs = documents(corpus)
    got = sa.remove(docs, width=24, gram=8)
    assert got.columns == docs.columns
    after = {r.doc_id: r for r in got.collect()}
    for i, (text, want) in enumerate(zip(corpus, brute(corpus, 24))):
        if not want[1]:
            assert after[i].text == text and after[i].n_chars == (None if text is None else len(text))
        else:
            # whole characters stay, so at most a few bytes more than cut
            assert 0 <= len(after[i].text.encode()) - (want[0] - want[1]) <= 2 * want[2]
            assert after[i].n_chars == len(after[i].text)


def test_empty_table_and_missing_ids(documents):
    assert sa.repeat_report(documents([])).count() == 0
    long = "0123456789" * 3
    got = sa.repeat_report(documents([long, long, long + "x", None], ids=[None, None, 1, 1]), width=20, gram=4).collect()
    assert sorted((r.n_bytes, r.n_removed) for r in got) == [(0, 0), (30, 30), (30, 30), (31, 30)]


def test_cuts_keep_whole_characters():
    data = "aéb".encode()
    assert sa.cut_text(data, [{"first": 2, "past": 3}]) == "aéb"
    assert sa.cut_text(data, [{"first": 0, "past": 3}]) == "b"


def test_column_rounds_keep_more_collections_than_16_bits_apart():
    """Numbers 65,536 apart are different collections."""
    group = np.array([0, 1, 65_536])
    rows, _, _ = sa.column_rounds(group, np.zeros(3, np.int64), [b"abcdefgh", b"x" * 8, b"abcdefgh"], 8)
    assert len(rows) == 0
    rows, first, last = sa.column_rounds(
        np.array([0, 65_535, 65_536, 65_536]), np.zeros(4, np.int64), [b"abcdefgh", b"x" * 8, b"hgfedcba", b"hgfedcba"], 8)
    assert list(zip(rows.tolist(), first.tolist(), last.tolist())) == [(2, 0, 0), (3, 0, 0)]


def passage_brute(texts, words, most, width):
    """Bytes of the passages and strings of ``width`` bytes that stand at more than one place."""
    data = [(t or "").encode() for t in texts]

    def windows(d):
        places = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", d)]
        yield from ((a[0], b[1]) for a, b in zip(places, places[words - 1:]) if b[1] - a[0] <= most)
        yield from ((i, i + width) for i in range(len(d) - width + 1))

    seen = Counter(d[a:b] for d in data for a, b in set(windows(d)))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for a, b in windows(d):
            if seen[d[a:b]] > 1:
                gone[a:b] = b"\1" * (b - a)
        whole = data.count(d) > 1 and (len(d) >= width or len(d.split()) >= words)
        out.append(len(d) if whole else sum(gone))
    return out


@pytest.mark.parametrize("words, most, gram, large", [(4, 60, 4, 10 ** 6), (6, 40, 8, 2), (3, 25, 2, 10 ** 6)])
def test_passages_equal_brute_force(documents, rng, words, most, gram, large):
    vocabulary = ["a", "bb", "ccc", "é", "dddd", "eeeee"]
    base = [rng.choices(vocabulary, k=rng.randint(2, 14)) for _ in range(25)]
    texts = ["".join(w + rng.choice([" ", " ", "\n", "  "]) for _ in range(rng.randint(0, 4)) for w in rng.choice(base))
             for _ in range(150)]
    texts += [*texts[:5], None, "", "a " * 60, "a " * 61, " a bb", "ccc"]
    got = sa.passage_report(documents(texts), words=words, width=most, gram=16, word_gram=gram, large=large)
    assert [r.n_with_passages for r in got.orderBy("doc_id").collect()] == passage_brute(texts, words, most, most)


def test_anchors_of_many_texts_stay_in_cache():
    rng = random.Random(3)
    texts = [bytes(rng.choices(range(97, 107), k=4000)) + b" " for _ in range(100)] + [b"", b"a", b"ab" * 300]
    windows = sa.Windows(400, 128)
    windows.anchors(texts)
    tracemalloc.start()
    got = windows.anchors(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 << 20
    for text, (places, tied) in zip(texts, got):
        alone, alone_tied = sa.anchors_of(text, 400, 128)
        assert (places[:, 1:] == alone[:, 1:]).all() and (places[:, 0] == alone[:, 0]).all() and tied == alone_tied


def test_rounds_take_little_more_than_their_texts(rng):
    """Thousands of texts around one anchor, where every passage repeats: what is told of them at once is bounded."""
    text = " ".join(rng.choice(["a", "bc", "d"]) for _ in range(400)).encode()
    text = text[:sa.passages(text, 50, 400)[1][90]]
    tracemalloc.start()
    rows, first, past = sa.column_rounds(
        np.zeros(4096, np.int64), np.full(4096, 272), [text] * 4096, 400, sa.Windows(400, 64, 50))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows.tolist() == list(range(4096)) and not first.any() and (past == len(text)).all()
    assert peak < 6000 * 4096


def test_few_rows_of_a_batch_are_python_objects():
    """A batch of 10,000 rows with long lists goes through in pieces, each told before the next is read."""
    batch = sa.pa.RecordBatch.from_arrays([sa.pa.array([[1] * 50] * 10_000)], ["x"])
    sizes = [b.num_rows for b in sa.pieces([batch, batch.slice(0, 3)])]
    assert sum(sizes) == 10_003 and max(sizes) <= sa.PIECE


def test_workers_get_few_bytes_at_once(spark, monkeypatch):
    """Long texts come to Python in small batches; the session's own limit is back behind it."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    own = spark.conf.get(key)
    docs = spark.range(0, 4000, 1, 1).select(
        "id", sa.F.concat(sa.F.col("id").cast("string"), sa.F.repeat(sa.F.lit("x"), 4000)).alias("text"))
    sizes, anchored = spark.sparkContext.accumulator(0), sa.anchored

    def each(batches):
        for batch in batches:
            sizes.add(batch.nbytes >> 23)
            yield batch

    monkeypatch.setattr(sa, "anchored", lambda docs, windows: anchored(
        docs.mapInArrow(each, docs.schema), windows))
    found = sa.Repeats(docs.withColumnRenamed("id", "doc_id"), words=50)
    assert found.rows.count() == 4000 and sizes.value == 0 and spark.conf.get(key) == own


def test_spans_are_merged_in_numbers(rng):
    """Equal to one after the other, on lists with gaps, overlaps, touching and nested spans, and none; no Python
    object for each span."""
    kind = sa.pa.list_(sa.pa.struct([("first", sa.pa.int32()), ("past", sa.pa.int32())]))

    def spans(n, most):
        starts = [rng.randrange(most) for _ in range(n)]
        return sorted(({"first": s, "past": s + rng.randint(1, 12)} for s in starts), key=lambda s: (s["first"], s["past"]))

    lists = [spans(rng.randint(0, 9), 60) for _ in range(400)]
    want = []
    for one in lists:
        done = []
        for s in one:
            if done and s["first"] <= done[-1]["past"]:
                done[-1]["past"] = max(done[-1]["past"], s["past"])
            else:
                done.append(dict(s))
        want.append(done)
    assert sa._merged(sa.pa.array(lists, kind)).to_pylist() == want
    assert sa._merged(sa.pa.array(lists, kind).slice(7, 20)).to_pylist() == want[7:27]
    assert sa._merged(sa.pa.array([], kind)).to_pylist() == []
    many = sa.pa.array([spans(60, 100_000)] * 5000, kind)
    tracemalloc.start()
    sa._merged(many)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 * 60 * 5000
