"""Cross-tokenizer alignment against a brute-force version over whole texts."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from gatewright.llm import alignment as al

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def byte_letters():
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(rest)}


LETTERS = byte_letters()


def tokens(text):
    """``(ids, bytes)`` of both tokenizers, or None."""
    if not text:
        return None
    a = A.encode(" " + text, add_special_tokens=False).ids
    b = B.encode(text)
    a_bytes = [bytes(LETTERS[c] for c in A.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode()
               for i in b]
    line = (" " + text).encode()
    return (a, a_bytes, b, b_bytes) if b"".join(a_bytes) == line == b"".join(b_bytes) else None


def spans(parts):
    ends = np.cumsum([len(p) for p in parts]).tolist()
    return list(zip([0, *ends[:-1]], ends))


def brute(texts):
    links, groups = [], []
    for text in texts:
        found = tokens(text)
        if found is None:
            links.append(None)
            groups.append(None)
            continue
        a, a_bytes, b, b_bytes = found
        sa, sb = spans(a_bytes), spans(b_bytes)
        links.append([(x, y) for x, (s, e) in zip(a, sa) for y, (t, f) in zip(b, sb) if s < f and t < e])
        shared = sorted({e for _, e in sa} & {e for _, e in sb})
        begin, lines = 0, []
        for end in shared:
            lines.append(",".join(str(x) for x, (s, e) in zip(a, sa) if begin <= s and e <= end) + "|"
                         + ",".join(str(y) for y, (s, e) in zip(b, sb) if begin <= s and e <= end))
            begin = end
        groups.append((len(a), len(b), lines))
    count = Counter(pair for ls in links if ls for pair in ls)
    highest = {}
    for (_, y), n in count.items():
        highest[y] = max(n, highest.get(y, 0))
    rows = []
    for ls, g in zip(links, groups):
        if ls is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
        else:
            rows.append((g[0], g[1], len(g[2]), len(ls), sum(count[p] == highest[p[1]] for p in ls),
                         sum(count[p] for p in ls), hashlib.sha256(";".join(g[2]).encode()).hexdigest()))
    return rows, count, links


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.fixture()
def odd(texts, rng):
    more = ["".join(rng.choice(["ab", " ", "  ", "\n", "\t", "é", "漢字", "😀", "▁", "'s", "12", "<s>", "<0x41>", "\x00",
                                "<|endoftext|>", "　", "the", "Ing"]) for _ in range(rng.randint(1, 40)))
            for _ in range(150)]
    return [*texts, *more, "▁", " ▁a", "x" * 700, " " * 90, "a b" * 300, "  a", "a\x85 b", "a \x1c b"]


def test_equals_brute_force(documents, odd):
    rows = al.align(documents(odd)).collect()
    expected, _, _ = brute(odd)
    assert len(rows) == len(odd)
    for r in rows:
        assert tuple(r[c] for c in COLUMNS) == expected[r.doc_id], repr(odd[r.doc_id])


def test_pairs_count_documents_and_links(documents, odd):
    _, count, links = brute(odd)
    held = Counter(pair for ls in links if ls for pair in set(ls))
    got = {(r.a, r.b): (r.n_docs, r["count"]) for r in al.Alignment(documents(odd)).pairs.collect()}
    assert got == {p: (held[p], n) for p, n in count.items()}


def test_blocks_and_forgetting_do_not_matter(documents, odd, monkeypatch):
    expected = {r.doc_id: r for r in al.align(documents(odd)).collect()}
    monkeypatch.setattr(al, "BLOCK_CHARACTERS", 50)
    monkeypatch.setattr(al, "REMEMBERED", 20)
    assert {r.doc_id: r for r in al.align(documents(odd)).collect()} == expected


def test_common_pairs_have_plain_bitmaps(documents):
    """More documents than a list of numbers holds, and many links in one document."""
    texts = ["the same words"] * 700 + ["the " * 1000, "other", None]
    rows = {r.doc_id: r for r in al.align(documents(texts)).collect()}
    expected, _, _ = brute(texts)
    assert all(tuple(rows[i][c] for c in COLUMNS) == expected[i] for i in range(len(texts)))


def test_bitmaps_come_back():
    slots = [np.arange(n) * 3 % 4096 for n in (1, 255, 256, 1000)]
    slots = [np.unique(s) for s in slots]
    packed = al.containers(np.concatenate(slots), np.array([len(s) for s in slots]))
    row, slot = al.members(packed)
    for i, s in enumerate(slots):
        assert sorted(slot[row == i].tolist()) == s.tolist()
    assert al.population(packed).tolist() == [len(s) for s in slots]


def test_tables_without_tokens(documents, spark):
    assert al.align(documents([None, ""])).count() == 2
    assert al.align(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    rows = al.align(documents(["a b", "a b"], ids=[None, None])).collect()
    assert [r.doc_id for r in rows] == [None, None] and rows[0] == rows[1]
