import random

import corpus_pipeline


def test_passages_of_fifty_words_go(spark, documents):
    """Under 400 bytes, with words of any length; a shorter repeat stays."""
    rng = random.Random(8)

    def some(n, letters=6):
        return " ".join("".join(rng.choices("abcdefghijklmnop", k=letters)) for _ in range(n))

    planted, short, tiny = some(55, 5), some(30, 5), some(50, 1)
    assert len(tiny) == 99 and len(planted) < 400
    texts = [f"{some(40)} {p} {some(40)}" for p in (planted, planted, short, short, tiny, tiny)]
    out = corpus_pipeline.cut_repeats(spark, documents(texts), "").orderBy("doc_id").collect()
    for text, row, passage in zip(texts, out, [planted, planted, None, None, tiny, tiny]):
        if passage is None:
            assert row.text == text
        else:  # a few letters around it may be equal as well
            assert passage not in row.text and len(passage) <= len(text) - len(row.text) <= len(passage) + 8


def test_neighbouring_shorter_repeats_stay(spark, documents):
    """Two passages of 40 words, side by side, each of which stands in another text too."""
    rng = random.Random(9)

    def some(n):
        return " ".join("".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(n))

    one, two, planted = some(40), some(40), some(55)
    texts = [f"{some(60)} {one} {two} {some(60)}", f"{some(60)} {one} {some(60)}", f"{some(60)} {two} {some(60)}",
             f"{some(60)} {planted} {some(60)}", f"{some(60)} {planted} {some(60)}"]
    out = {r.doc_id: r.text for r in corpus_pipeline.cut_repeats(spark, documents(texts), "").collect()}
    assert [out[i] for i in range(3)] == texts[:3]
    for i in (3, 4):
        assert planted not in out[i] and len(planted) <= len(texts[i]) - len(out[i]) <= len(planted) + 4
