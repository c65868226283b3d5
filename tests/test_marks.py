import random

import pytest
from pyspark.sql import functions as F

from gatewright.functions import patterns
from gatewright.functions.marks import required_marks


@pytest.mark.parametrize("pattern,marks", [
    (r"[a-z]+@[a-z]+\.[a-z]{2,}", ("@", ".")), (r"\(\d{3}\)-\d", ("(", ")", "-")),
    ("a|@", ()), ("(?:@|b)-", ("-",)), ("@?", ()), ("@*-", ("-",)), ("@{0,3}#", ("#",)), ("@{1,3}", ("@",)),
    ("(?i)@", ()), (r"\Q@\E", ()), ("[@]", ()), ("[[a]@]-", ("-",)), (r"[\]@]#", ("#",)), ("(a(b)@)#", ("#",)),
    ("(?=@)#", ()), ("a.b", ()), ("^@$", ("@",)), ("abc", ()), (r"\p{L}@", ()), ("@++", ("@",)), ("@{0}#", ("#",)),
    (r"\x{40}@", ()), ("[", ()), ("(", ()), ("@\\", ()), ("[]@]", ()), ("@+?#", ("@", "#")), ("(@)+#?", ()),
])
def test_required_marks(pattern, marks):
    assert required_marks(pattern) == marks


def test_marks_never_hide_a_match(spark):
    rnd = random.Random(3)
    atoms = ["a", "@", "[a@]", "(a@)", "(?:a|@)", r"\-", "-", ".", r"\d", "[^@]"]
    counts = ["", "?", "*", "+", "{0,2}", "{2}", "+?", "?+"]
    texts = ["".join(rnd.choices("a@-1b", k=rnd.randint(0, 8))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").cache()
    checks = []
    for _ in range(60):
        pattern = "".join(rnd.choice(atoms) + rnd.choice(counts) for _ in range(rnd.randint(1, 4)))
        checks.append(patterns.regex_find(F.col("t"), pattern) != F.col("t").rlike(pattern))
        checks.append(patterns.find_all(F.col("t"), pattern)
                      != F.regexp_extract_all("t", F.lit(pattern), F.lit(0)))
        checks.append(patterns.redact_rule(F.col("t"), pattern)
                      != F.regexp_replace("t", pattern, "*****"))
    counted = df.select(*[F.sum(c.cast("int")).alias(f"c{i}") for i, c in enumerate(checks)]).first()
    assert sum(counted) == 0
