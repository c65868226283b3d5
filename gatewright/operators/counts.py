"""Word, sentence and byte counts against a range."""

from __future__ import annotations

from pyspark.sql import functions as F

from gatewright.config import ContentLength, CountPolicy, SentenceCount, WordCount
from gatewright.functions import text
from gatewright.operators.stage import Inputs, Stage, Verdict

# Counting function, and whether text taken by a path is cleaned beforehand;
# the word and sentence counts clean what they get in either case.
_COUNTS = {
    WordCount: (text.word_count, False),
    SentenceCount: (text.sentence_count, False),
    ContentLength: (text.byte_length, True),
}

# Fixed wording of the reports.
_DETAILS = {
    WordCount: ("Violation of word count detected. Expected {} words. But found ", " words."),
    SentenceCount: (
        "Violation of sentence count detected: expected {} sentences. But found ",
        " sentences.",
    ),
    ContentLength: ("Expected {} bytes. But found ", "."),
}


def count(stage: Stage, policy: CountPolicy):
    """Count for each message: 0 for an empty payload, NULL for an error."""
    function, cleaned = _COUNTS[type(policy)]
    content = stage.content(policy.json_path, cleaned=cleaned)
    return stage.keep(stage.gate(F.when(stage.empty, 0).otherwise(function(content))))


def check_count(stage: Stage, policy: CountPolicy, inputs: Inputs) -> Verdict:
    number = count(stage, policy)
    inside = number.between(policy.min, policy.max)
    details = None
    if policy.show_assessment:
        before, after = _DETAILS[type(policy)]
        details = F.concat(
            F.lit(before.format(policy.bounds)), number.cast("string"), F.lit(after)
        )
    return Verdict(stage.decide(policy, ~inside if policy.invert else inside, details))
