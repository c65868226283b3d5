import random

import pytest


@pytest.fixture()
def rng():
    return random.Random(11)


@pytest.fixture()
def texts(rng):
    """Texts with copies, shared passages, odd blanks, nulls and empty ones."""
    words = ["the", "Of", "añb", "x1", "##", "long|er", "zz.", "É", "42", "a"]
    passage = " ".join(rng.choices(words, k=30))
    out = []
    for i in range(60):
        parts = rng.choices(words, k=rng.randint(0, 50))
        text = "".join(w + rng.choice([" ", " ", "\n", "\t ", "  ", "\x0b"]) for w in parts)
        if i % 5 == 0:
            text += passage
        out.append(text)
    return [*out, *out[:6], None, "", " ", "one", "one two", passage, " ".join(["w"] * 400)]


@pytest.fixture()
def documents(spark):
    """Rows of ``documents`` from texts, with columns whose names clash with working ones."""

    def build(texts, ids=None, **more):
        rows = [(i if ids is None else ids[i], t, "en" if i % 2 else None, "s", len(t) if t is not None else None,
                 "x", 7) for i, t in enumerate(texts)]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, words string, fp int")

    return build
