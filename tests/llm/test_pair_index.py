"""The pair index against the tokenizers library."""

import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gatewright.llm import pair_index as px

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def coder():
    return px.PairIndexCoder()


@pytest.fixture()
def odd(texts, rng):
    more = ["".join(rng.choice("ab 's'T'll  \n\t\r12é½²ß÷×ªº.,! ſ　\x85\x1c漢😀AZ") for _ in range(rng.randint(1, 60)))
            for _ in range(400)]
    return [*texts, *more, "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "x" * 3001, "a" * 5000, "ab" * 2000,
            " " * 500, "\n" * 50 + "q", "ééé" * 300]


def test_ids_and_texts_equal_the_library(coder, odd):
    for text, ids in zip(odd, coder.encode(odd)):
        expected = LIBRARY.encode(text or "", add_special_tokens=False).ids
        assert ids.tolist() == expected, repr(text)
        assert coder.decode(ids) == LIBRARY.decode(expected, skip_special_tokens=False)


def test_code_points_are_split_alike(coder):
    """A letter, a number or a blank to one library is one to the other."""
    points = [chr(i) for i in range(0x3400) if not 0xD800 <= i <= 0xDFFF] + [chr(i) for i in range(0x10000, 0x1FB00, 7)]
    texts = [f"a{c}b 1{c}1 .{c}. {c} {c}{c}" for c in points]
    for ids, expected in zip(coder.encode(texts), LIBRARY.encode_batch(texts, add_special_tokens=False)):
        assert ids.tolist() == expected.ids


def test_broken_ids_decode_as_the_library_does(coder, rng):
    for _ in range(200):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 12))]
        assert coder.decode(ids) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_stretches_and_forgetting_do_not_matter(odd, monkeypatch):
    expected = [x.tolist() for x in px.PairIndexCoder().encode(odd)]
    monkeypatch.setattr(px, "STRETCH", 100)
    monkeypatch.setattr(px, "REMEMBERED", 5)
    assert [x.tolist() for x in px.PairIndexCoder().encode(odd)] == expected


def test_one_very_long_word(coder):
    ids = coder.encode(["ab" * 300_000])[0]
    assert coder.decode(ids) == "ab" * 300_000
    assert ids[:50].tolist() == LIBRARY.encode("ab" * 300, add_special_tokens=False).ids[:50]


def test_rows(documents, odd, spark):
    rows = {r.doc_id: r for r in px.round_trip(documents(odd)).collect()}
    coded = {r.doc_id: r.ids for r in px.encode(documents(odd)).collect()}
    back = {r.doc_id: r.text for r in px.decode(px.encode(documents(odd))).collect()}
    for i, text in enumerate(odd):
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        assert coded[i] == ids and back[i] == (text or "")
        assert rows[i].n_tokens == len(ids)
        assert rows[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert rows[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert px.round_trip(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    assert [r.n_tokens for r in px.round_trip(documents(["a", "a", None], ids=[None, None, 3])).collect()] == [1, 1, 0]
