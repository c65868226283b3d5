"""Allow and deny lists by similarity of embeddings."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewright.config import SemanticGuard
from gatewright.functions.similarity import cosine_to_rules, first_in_blocks, first_reached, vector_blocks
from gatewright.operators.stage import Inputs, Stage, Verdict
from gatewright.session import release, stored, work_folder, work_scope


def check_semantics(stage: Stage, policy: SemanticGuard, inputs: Inputs) -> Verdict:
    """First rule at or above the threshold decides; deny rules come first."""
    if policy.table:
        return _by_table(stage, policy, inputs)
    if not policy.vectors:
        raise ValueError("rule vectors are missing; embed the rules first")
    content = stage.content(policy.json_path, cleaned=True)
    scores = stage.keep(
        cosine_to_rules(F.col(inputs.embedding), policy.vectors, float(policy.threshold))
    )
    reached = F.transform(scores, lambda score: score * 100 >= F.lit(float(policy.threshold)))
    first = stage.keep(F.array_position(reached, True))
    by_rule = F.when(first == 0, policy.mode == "DENY_ONLY").otherwise(first > len(policy.deny))
    details = None
    if policy.show_assessment and policy.mode == "DENY_ONLY":
        rules = F.array(*[F.lit(prompt) for prompt in policy.deny])
        details = _denied(F.get(rules, first.cast("int") - 1))
    elif policy.show_assessment:
        # A deny hit of a mixed policy reports the allowed prompts as well.
        details = F.struct(
            F.lit("None of the allowed prompts are met.").alias("message"),
            F.array(*[F.lit(prompt) for prompt in policy.allow]).alias("allowedRules"),
        )
    return _decided(stage, policy, content, by_rule, details)


def _denied(prompt: Column) -> Column:
    return F.struct(F.lit("One or more semantic rules are violated.").alias("message"), prompt.alias("deniedRule"))


def _decided(stage: Stage, policy: SemanticGuard, content: Column, by_rule: Column, details: Column | None) -> Verdict:
    passed = F.when(stage.empty | (content == ""), True).otherwise(
        F.when(content.isNotNull(), by_rule)
    )
    return Verdict(stage.decide(policy, passed, details))


# --- rules as a table -------------------------------------------------------------


def written(file: str) -> tuple[int, int]:
    """Place of a file among those of a write: its task, and its number there."""
    task, number = re.search(r"part-(\d+)-[^/]*-c(\d+)\.[^/]*$", file).groups()
    return int(task), int(number)


class RuleBlocks:
    """A rule table in the order of its rules.

    ``rule`` numbers the rules: deny before allow, then by ``ord`` and prompt.
    Numbers grow with the files, and by one within a file. All vectors have one
    length, else it is refused. The driver sees the first block of rules, at
    most ``most`` numbers.
    """

    def __init__(self, rules: DataFrame, most: int):
        vector = F.col("embedding").cast("array<double>")
        known = rules.select((F.col("kind") == "ALLOW").alias("allow"), "ord", "prompt", vector.alias("embedding"))
        sizes = known.agg(F.min(F.size("embedding")).alias("a"), F.max(F.size("embedding")).alias("b"),
                          F.count_if(F.col("embedding").isNull() | F.col("allow").isNull()).alias("gaps"),
                          F.count("*").alias("n")).first()
        if sizes.a is None or sizes.a != sizes.b or sizes.a < 1 or sizes.gaps:
            raise ValueError("a rule table needs rules with a kind and vectors of one length")
        self.spark, self.width, self.count = rules.sparkSession, sizes.a, sizes.n
        self.most = max(1, most // self.width)
        self.folder = work_folder(self.spark, "rules")
        ordered = known.orderBy("allow", "ord", "prompt").withColumn("rule", F.monotonically_increasing_id())
        ordered.write.option("maxRecordsPerFile", 0).parquet(self.folder)
        self.table = self.spark.read.schema(ordered.schema).parquet(self.folder)
        self.first_allow = self.table.where("allow").agg(F.min("rule")).first()[0]

    def first(self) -> tuple[np.ndarray, np.ndarray]:
        """``(rule numbers, vectors)`` of the first block, on the driver."""
        rows = self.table
        if self.count > self.most:
            file = min(self.table.inputFiles(), key=written)
            in_file = F.col("rule").bitwiseAND(F.lit((1 << 33) - 1))
            rows = self.spark.read.schema(self.table.schema).parquet(file).where(in_file < self.most)
        found = rows.select("rule", "embedding").toArrow().combine_chunks().sort_by("rule")
        vectors = found.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return found.column("rule").to_numpy(), vectors.reshape(-1, self.width)

    def rounds(self, after: int):
        """Bounds ``(low, high)`` of the rules behind the number ``after``, about twice as many each time."""
        share, shares = self.most / self.count, []
        while share < 1:
            shares.append(share)
            share = 2 * share + self.most / self.count
        rest = self.table.where(F.col("rule") > after)
        marks = rest.agg(F.percentile_approx("rule", shares, 10_000)).first()[0]
        low = after + 1
        for mark in marks or []:
            if mark >= low:
                yield low, mark + 1
                low = mark + 1
        yield low, 1 << 62


def _by_table(stage: Stage, policy: SemanticGuard, inputs: Inputs) -> Verdict:
    """As with rules of the configuration, for a table of any size.

    Rules that fit one block travel with the function, and messages stay where
    they are. Of more rules the first block does; behind it rules and the messages
    that have found none yet meet in the tasks, in rounds of twice as many rules
    each. Only numbers come back to the messages, and no rule but those of the
    first block to the driver.
    Allowed prompts are not listed in the report.
    """
    if inputs.rules is None:
        raise ValueError("a semantic policy with a rule table needs Inputs.rules")
    blocks = RuleBlocks(inputs.rules, inputs.rule_block)
    threshold, vector = float(policy.threshold), F.col(inputs.embedding)
    valid = (F.size(vector) == blocks.width) & ~F.exists(vector, lambda x: x.isNull())
    if blocks.count <= blocks.most:
        rule = stage.named(first_reached(vector, *blocks.first(), threshold))
    else:
        rule = _by_blocks(stage, blocks, inputs.embedding, threshold)
    content = stage.content(policy.json_path, cleaned=True)
    allowed = F.lit(False) if blocks.first_allow is None else F.col(rule) >= blocks.first_allow
    by_rule = F.when(valid, F.when(F.col(rule).isNull(), policy.mode == "DENY_ONLY").otherwise(allowed))
    details = None
    if policy.show_assessment and policy.mode == "DENY_ONLY":
        prompt = stage.reserve()
        prompts = blocks.table.select(F.col("rule").alias(rule), F.col("prompt").alias(prompt))
        stage.df = stage.df.join(prompts, rule, "left")
        details = _denied(F.col(prompt))
    elif policy.show_assessment:
        details = F.struct(F.lit("None of the allowed prompts are met.").alias("message"))
    return _decided(stage, policy, content, by_rule, details)


def _by_blocks(stage: Stage, blocks: RuleBlocks, embedding: str, threshold: float) -> str:
    """Name of the column with each message's first rule."""
    row, rule = stage.named(F.monotonically_increasing_id()), stage.reserve()
    stage.cut(row)
    numbers, vectors = blocks.first()
    after = int(numbers[-1]) if len(numbers) else -1
    with work_scope() as made:
        left = stage.df.select(row, embedding).where(F.col(embedding).isNotNull())
        found = stored(left.withColumn(rule, first_reached(F.col(embedding), numbers, vectors, threshold)), "first-rules")
        hits = found.where(F.col(rule).isNotNull()).select(row, rule)
        left = found.where(F.col(rule).isNull()).select(row, embedding)
        # in ranges, so that the numbers of no two blocks overlap
        rules = blocks.table.where(F.col("rule") > after).repartitionByRange("rule").sortWithinPartitions("rule")
        rules = stored(vector_blocks(rules, "rule", "embedding", blocks.width), "rules")
        for low, high in blocks.rounds(after):
            messages = stored(vector_blocks(left, row, embedding, blocks.width), "messages")
            if messages.isEmpty():
                break
            # a block of rules belongs to the round of its first rule
            some = first_in_blocks(messages, rules.where(F.col("first").between(low, high - 1)), blocks.width, threshold)
            some = stored(some.toDF(row, rule), "first-rules")
            hits = hits.unionByName(some)
            left = stored(left.join(some.select(row), row, "left_anti"), "left")
        hits = stored(hits, "rule-hits")
    release(stage.df.sparkSession, made, but=hits)
    stage.df = stage.df.join(hits, row, "left")
    return rule
