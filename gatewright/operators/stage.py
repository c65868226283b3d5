"""Shared steps of all policies: content extraction, decision, application."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewright import outcome as oc
from gatewright.config import Policy
from gatewright.functions import jsonpath, text
from gatewright.session import stored

PREFIX = "_gw"


class Verdict(NamedTuple):
    """Outcome of one policy, with the new payload if it can change one."""

    outcome: Column
    payload: Column | None = None
    mapping: Column | None = None


@dataclass
class Inputs:
    """Side inputs of the policies that look something up.

    ``status`` and ``responses`` are tables. ``responses`` may also be a function
    that gets the messages the policy asks about, ``(keys, direction, payload)``
    with the payload as changed so far, and returns the answers; it runs while
    the plan is built, and its answers are written, so that each message is asked
    about once, whatever is done with the result. ``keys`` names
    the columns that identify a message; ``embedding``, ``response`` and ``mapping`` name columns
    that the messages carry already. ``rules`` and ``templates`` are policy
    configuration as tables: ``(kind, ord, prompt, embedding)`` with kind DENY or
    ALLOW, and ``(name, prompt)``. ``rule_block`` bounds the numbers of the rules
    that are compared in one pass over the messages.
    """

    status: DataFrame | None = None
    responses: DataFrame | Callable[[DataFrame], DataFrame] | None = None
    rules: DataFrame | None = None
    templates: DataFrame | None = None
    keys: tuple[str, ...] = ("msg_id",)
    embedding: str = "embedding"
    response: str = "response"
    mapping: str = "mapping"
    rule_block: int = 1 << 23


@dataclass
class Stage:
    """Messages that get one working column after another.

    Values that are used more than once become columns of their own, so that
    Catalyst keeps them in separate projections and computes them once. The
    parsed document and the contents already extracted are shared by all
    policies that look at the same payload.
    """

    df: DataFrame
    detailed: bool = True
    payload: str = "payload"
    direction: str = "direction"
    # Messages the policy has to look at; None means all of them.
    active: Column | None = None
    # The only flow the policy is attached to, if there is one.
    flow: str | None = None
    # Working columns that later steps read.
    live: tuple[str, ...] = ()
    _count: int = 0
    _known: dict = field(default_factory=dict)

    def reserve(self) -> str:
        """Name of a working column that is dropped at the end."""
        name = f"{PREFIX}{self._count}"
        self._count += 1
        return name

    def named(self, value: Column) -> str:
        name = self.reserve()
        self.df = self.df.withColumn(name, value)
        return name

    def keep(self, value: Column) -> Column:
        return F.col(self.named(value))

    def cut(self, *keep: str) -> None:
        """Write the messages as they are by now, and go on from what was written.

        For steps that read them twice, as the scorer and the join of its answers.
        Without it everything before such a step, earlier calls included, would
        run once for each of them. Texts and documents that were taken from the
        payload are left out and taken again where they are needed.
        """
        if self.df.isStreaming:
            raise ValueError("a scorer is asked per micro-batch on a stream: see streaming.asking")
        passing = {f"{PREFIX}{i}" for i in range(self._count)} - {*self.live, self.payload, *keep}
        self.df = stored(self.df.drop(*passing), "asking")
        self._known.clear()

    def gate(self, value: Column) -> Column:
        """Leave out costly work for messages that are out of the chain."""
        return value if self.active is None else F.when(self.active, value)

    @property
    def way(self) -> Column:
        return F.col(self.direction)

    @property
    def text(self) -> Column:
        return F.col(self.payload)

    @property
    def empty(self) -> Column:
        return self.text.isNull() | (self.text == "")

    def document(self) -> Column:
        key = ("document", self.payload)
        if key not in self._known:
            self._known[key] = self.keep(jsonpath.document(self.text))
        return self._known[key]

    def content(self, path: str, *, cleaned: bool) -> Column:
        """Inspected text: the raw payload, or the text at ``path``.

        NULL stands for a path that leads nowhere, which is an error. Only text
        taken by a path is cleaned here.
        """
        if jsonpath.is_whole(path):
            return self.text
        key = ("content", self.payload, path, cleaned)
        if key not in self._known:
            if cleaned:
                found = text.clean(self.content(path, cleaned=False))
            else:
                found = jsonpath.read(self.document(), path)
            self._known[key] = self.keep(found)
        return self._known[key]

    def with_text(self, path: str, value: Column) -> Column:
        """Payload after writing ``value`` to the inspected place."""
        if jsonpath.is_whole(path):
            return value
        return jsonpath.replace_text(self.text, self.document(), path, value)

    def decide(
        self, policy: Policy, passed: Column, details: Column | None = None
    ) -> Column:
        """Outcome for a truth value; NULL stands for an exception."""
        message = oc.assessment(policy, self.way, details)
        return (
            F.when(passed, oc.passed())
            .when(passed.isNull(), oc.internal_error(policy))
            .otherwise(oc.violation(policy, message, self.detailed))
        )

    def seal(self, **columns: Column) -> None:
        """Add result columns that later filters cannot be pushed through.

        Catalyst moves a filter below projections by repeating their whole
        expressions, at every level, which would run a policy several times for
        ``where(outcome.passed)``. A generator over a single row stops that;
        filters on columns that the messages came with still reach the scan.
        """
        parts = [value.alias(name) for name, value in columns.items()]
        self.df = self.df.drop(*columns).select("*", F.inline(F.array(F.struct(*parts))))

    def result(self) -> DataFrame:
        return self.df.drop(*[f"{PREFIX}{i}" for i in range(self._count)])


Operator = Callable[[Stage, Policy, Inputs], Verdict]
