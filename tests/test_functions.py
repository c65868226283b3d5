import json
import random
import re

import pytest
from pyspark.sql import functions as F

from gatewright.functions import jsonpath, patterns, text, unescape
from gatewright.functions.similarity import cosine, cosine_to_rules

# Java's \s and the characters that its trim removes.
SPACE = " \t\n\x0b\f\r"
TRIMMED = "".join(map(chr, range(33)))


def strip_quotes(value):
    breaks = "".join(map(chr, (10, 13, 0x85, 0x2028, 0x2029)))
    ends = f"(?=(?:{chr(13)}{chr(10)}|[{breaks}])?{chr(92)}Z)"
    return re.sub(r'\A"|"' + ends, "", value)


def model_words(value):
    return sum(1 for w in re.split(f"[{SPACE}]+", strip_quotes(value)) if w.strip(TRIMMED))


def model_sentences(value):
    return sum(1 for s in re.split("[.!?]", strip_quotes(value)) if s.strip(TRIMMED))


CASES = ["", " ", '"', '""', '" a b "', 'a b', "a\x01 \x01 b", "\x02x y\x03", "3.14", "...",
         "Hi! You? ok.", 'say "x"', '"q"\n', '"q"\r\n', "a\tb\n\nc", "é ü ☃ 😀 x", ".\x01.a. b",
         'x" ', "Kettles boil on Sunday mornings."]


def test_counts_match_the_model(values):
    rnd = random.Random(7)
    alphabet = ' \t\n"\x01.!?ab é'
    texts = CASES + ["".join(rnd.choices(alphabet, k=rnd.randint(0, 30))) for _ in range(800)]
    assert values(texts, text.word_count) == [model_words(t) for t in texts]
    assert values(texts, text.sentence_count) == [model_sentences(t) for t in texts]
    assert values(texts, text.byte_length) == [len(t.encode()) for t in texts]
    assert values(texts, text.clean) == [strip_quotes(t).strip(TRIMMED) for t in texts]


@pytest.mark.parametrize("path,expected", [
    ("$.messages[-1].content", "last"),
    ("$.messages[0].content", "first"),
    ("$['messages'][-2]['content']", "first"),
    ("$.messages[*].content", '["first","last"]'),
    ("$.one[*].v", "[1]"),
    ("$.n", "3"), ("$.d", "1.5"), ("$.b", "true"), ("$.o", '{"k":[1,2]}'),
    ("$.null", None), ("$.missing", None), ("$.messages[7].content", None),
    ("$.messages[-7].content", None), ("$.n.x", None), ("$['a b']", "sp"), ("$.s", ""),
])
def test_jsonpath_read(values, path, expected):
    payload = json.dumps({"messages": [{"content": "first"}, {"content": "last"}], "n": 3,
                          "d": 1.5, "b": True, "o": {"k": [1, 2]}, "null": None, "a b": "sp",
                          "one": [{"v": 1}], "s": ""})
    got = values([payload, "not json", "", None],
                 lambda c: jsonpath.read(jsonpath.document(c), path))
    assert got == [expected, None, None, None]


@pytest.mark.parametrize("path", ["messages", "$..a", "$.a[?(@.b)]", "$.a[1:2]", "$.a b", "$.length()"])
def test_jsonpath_refuses_other_syntax(path):
    with pytest.raises(ValueError):
        jsonpath.parse(path)


@pytest.mark.parametrize("path", ["$.m[-1].c", "$.m[1].c", "$.m[0].c", "$.k", "$.m[*].c"])
def test_jsonpath_replace(values, path):
    payload = {"z": int("9" * 45), "m": [{"c": "x", "r": {"q": [1, None]}}, {"c": "y", "n": int("8" * 50)}], "k": "v"}
    got = values([json.dumps(payload)],
                 lambda c: jsonpath.replace_text(c, jsonpath.document(c), path, F.lit('n"\n')))
    new = 'n"\n'
    if path == "$.k":
        payload["k"] = new
    elif "*" in path:
        payload["m"][0]["c"] = payload["m"][1]["c"] = new
    else:
        payload["m"][0 if "[0]" in path else 1]["c"] = new
    assert json.loads(got[0]) == payload


def test_extract_urls(values):
    got = values(["see http://a.b/c, https://x.y?q=1 and http://a.b/c \"http://z\" ftp://n",
                  "none", r"http://e\n http://f"], patterns.extract_urls)
    assert got == [["http://a.b/c", "https://x.y?q=1", "http://z"], [], ["http://e", "http://f"]]


def test_url_host(values):
    urls = ["http://a.b/c", "https://u:p@h.x:80/p?q", "http://a_b.c?x", "http://h#f"]
    assert values(urls, patterns.url_host) == ["a.b", "h.x", "a_b.c", "h"]


def test_json_candidates(values):
    got = values(['a {"x":1} b {"y":{"z":2}} {\n}'], patterns.json_candidates)
    assert got == [['{"x":1}', '{"y":{"z":2}', "{\n}"]]


U = chr(92) + "u"  # a backslash and the letter u


@pytest.mark.parametrize("source,expected", [
    ("plain", "plain"), (r"a\nb", "a\nb"), (r'\"q\"', '"q"'), (r"\\n", r"\n"), (r"\x", "x"),
    (U + "0041" + U + "00e9", "A" + chr(0xE9)), (U + "d83d" + U + "de00!", chr(0x1F600) + "!"),
    (U + "u0042", "B"), (U + "+0043", "C"), (U + "12", None), (U + "0041" + U + "004z", None),
    (r"\101\7", "A" + chr(7)), (r"\400", " 0"), ("end" + chr(92), "end"), (r"\'\/", "'/"),
    (r"\t\b\f\r", "\t\b\f\r"), (chr(92) + U + "0041", U + "0041"), (chr(92) * 3 + "n", chr(92) + "\n"),
])
def test_unescape_java(values, source, expected):
    assert values([source], unescape.unescape_java) == [expected]


def test_hex_ids_grow(values):
    got = values(["x"], lambda c: F.array(*[patterns.placeholder("E", F.lit(n)) for n in (0, 255, 65536)]))
    assert got == [["E_0000", "E_00ff", "E_10000"]]


def test_check_regex(spark):
    patterns.check_regex(spark, "(?i)abc")
    with pytest.raises(ValueError):
        patterns.check_regex(spark, "(")
    with pytest.raises(ValueError):
        patterns.check_regex(spark, "a*", consuming=True)


def test_cosine(spark):
    rules = [[1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]
    data = [(0, [2.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [1.0]), (4, [1.0, None]), (5, [-1.0, 1.0])]
    df = spark.createDataFrame(data, "i int, v array<float>").coalesce(1)
    got = {r.i: r.s for r in df.select("i", cosine_to_rules(F.col("v"), rules).alias("s")).collect()}
    assert got[0] == pytest.approx([1.0, 0.5 ** 0.5, 0.0])
    assert got[1] == [0.0, 0.0, 0.0]
    assert got[2] is None and got[3] is None and got[4] is None
    assert got[5] == pytest.approx([-(0.5 ** 0.5), 0.0, 0.0])
    native = df.where("i in (0, 1, 5)").select(
        "i", cosine(F.col("v"), F.array(F.lit(1.0), F.lit(1.0))).alias("s")).collect()
    assert {r.i: r.s for r in native} == pytest.approx({0: got[0][1], 1: 0.0, 5: 0.0})


def test_scores_at_the_threshold_match_a_plain_loop(spark):
    """Equal vectors give 1.0 or its neighbours, depending on the order of the sums."""
    rnd = random.Random(5)

    def loop(a, b):
        total = norm_a = norm_b = 0.0
        for x, y in zip(a, b):
            total += x * y
            norm_a += x * x
            norm_b += y * y
        return total / (norm_b ** 0.5 * norm_a ** 0.5)

    rules = [[rnd.gauss(0, 1) for _ in range(33)] for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(rules)), "i int, v array<double>")
    got = df.select("i", cosine_to_rules(F.col("v"), rules, 100.0).alias("s")).collect()
    want = {i: loop(rules[i], rules[i]) * 100 >= 100 for i in range(40)}
    assert {r.i: r.s[r.i] * 100 >= 100 for r in got} == want and len(set(want.values())) == 2
