"""User functions at the three outside calls: embeddings, scorers, URL checks.

Each is called inside the tasks that hold the rows, in Arrow batches, with an
optional pool of threads for calls that wait. A call may be repeated when a
task is retried, so it must not change anything outside. Write the answers to a
table before they are used more than once.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import pandas as pd
from pyspark import Accumulator, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewright.config import BedrockVerdict, Moderation, SemanticGuard, UrlCheck
from gatewright.functions import scorers
from gatewright.functions.patterns import url_host
from gatewright.operators.stage import Stage
from gatewright.operators.urls import distinct_urls

# The functions below travel to the workers by value, so that no package has to
# be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Embed = Callable[[str], Sequence[float]]


def _attempt(call: Callable, argument):
    """``(answer, error)``: a failing call gives no answer, and says why."""
    if argument is None:
        return None, None
    try:
        return call(argument), None
    except Exception as error:
        return None, f"{type(error).__name__}: {error}"


def _answers(call: Callable, arguments: Sequence, threads: int = 1, batched: bool = False) -> tuple[list, list]:
    """Answers and errors of the arguments, in their order.

    A ``batched`` call gets all arguments of an Arrow batch that are not null, as
    a list, and returns as many answers; if it fails, all of them fail.
    """
    if batched:
        asked = [i for i, argument in enumerate(arguments) if argument is not None]
        found, error = _attempt(call, [arguments[i] for i in asked]) if asked else ([], None)
        if error is None and len(found) != len(asked):
            error = f"{len(found)} answers to {len(asked)} calls"
        answers, errors = [None] * len(arguments), [None] * len(arguments)
        for k, i in enumerate(asked):
            answers[i], errors[i] = (found[k], None) if error is None else (None, error)
        return answers, errors
    if threads <= 1:
        pairs = [_attempt(call, argument) for argument in arguments]
    else:
        with ThreadPoolExecutor(threads) as pool:
            pairs = list(pool.map(lambda argument: _attempt(call, argument), arguments))
    return [p[0] for p in pairs], [p[1] for p in pairs]


def _spread(df: DataFrame, tasks: int | None) -> DataFrame:
    """Even tasks for slow calls."""
    return df.repartition(tasks) if tasks else df


# --- embeddings -----------------------------------------------------------------


def embed(provider: Embed, threads: int = 1, *, batched: bool = False,
          failures: Accumulator | None = None) -> Callable[[Column], Column]:
    """Column function around an embedding provider.

    With ``batched`` the provider gets lists of texts and returns a vector for
    each. A text it fails on gets no vector, which the policy reports as an
    error of that message; ``failures``, an accumulator, counts them (tasks that
    are run again count again).
    """

    def vector(text):
        found = provider(text)
        return [[float(x) for x in v] for v in found] if batched else [float(x) for x in found]

    @F.pandas_udf("array<double>")
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found, errors = _answers(vector, [text or None for text in texts], threads, batched)
            if failures is not None:
                failures.add(sum(error is not None for error in errors))
            yield pd.Series(found, dtype=object)

    return vectors


def embed_rules(policy: SemanticGuard, provider: Embed) -> SemanticGuard:
    """Policy with the vectors of its prompts, deny prompts first.

    The prompts are part of the configuration, so this runs on the driver.
    """
    prompts = (*policy.deny, *policy.allow)
    return replace(policy, vectors=tuple(tuple(provider(prompt)) for prompt in prompts))


# --- scorers ----------------------------------------------------------------------


def requests(messages: DataFrame, policy: BedrockVerdict | Moderation,
             keys: Sequence[str] = ("msg_id", "direction")) -> DataFrame:
    """``(keys, request)`` for a scorer; NULL where the policy asks nothing."""
    stage = Stage(messages)
    content = stage.content(policy.json_path, cleaned=True)
    if isinstance(policy, Moderation):
        request = F.when(~stage.empty, scorers.moderation_request(content, policy.thresholds))
    else:
        asked = content.isNotNull()
        if not policy.redact_pii:  # responses are restored, not checked
            asked = asked & F.coalesce(stage.way != "RESPONSE", F.lit(True))
        request = F.when(asked, scorers.bedrock_request(content, stage.way))
    return stage.df.select(*keys, request.alias("request"))


def call_fields(policy: BedrockVerdict | Moderation) -> dict[str, str]:
    """What a call-out needs besides the request body."""
    if isinstance(policy, Moderation):
        return {"service": scorers.MODERATION_ENDPOINT}
    return scorers.bedrock_call(policy.region, policy.guardrail_id, policy.guardrail_version)


def ask(messages: DataFrame, policy: BedrockVerdict | Moderation,
        call_out: Callable[[dict], str | None], keys: Sequence[str] = ("msg_id", "direction"),
        *, tasks: int | None = None, threads: int = 1, batched: bool = False) -> DataFrame:
    """Answers ``(keys, response, error)`` of a scorer for a policy.

    ``call_out`` gets the call fields with the body as ``request_payload``; with
    ``batched`` it gets lists of them and returns a list.
    """
    fields = call_fields(policy)

    def call(body):
        if batched:
            return call_out([{**fields, "request_payload": one} for one in body])
        return call_out({**fields, "request_payload": body})

    bodies = requests(messages, policy, keys)
    return score(bodies, call, keys, tasks=tasks, threads=threads, batched=batched)


def score(bodies: DataFrame, call_out: Callable[[str], str | None],
          keys: Sequence[str] = ("msg_id",), *, tasks: int | None = None,
          threads: int = 1, batched: bool = False) -> DataFrame:
    """Answers of a scorer: ``(keys, request)`` to ``(keys, response, error)``.

    A call that fails gives a NULL response, the sign of an unreachable scorer,
    and says why in ``error``: a mistake in the function shows there even where
    the policy passes on errors.
    """
    bodies = bodies.select(*keys, "request")
    names = list(keys)
    schema = ", ".join(
        f"`{field.name}` {field.dataType.simpleString()}" for field in bodies.select(*keys).schema
    )

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found, errors = _answers(call_out, batch["request"].tolist(), threads, batched)
            yield batch[names].assign(
                response=pd.Series(found, index=batch.index, dtype=object),
                error=pd.Series(errors, index=batch.index, dtype=object),
            )

    return _spread(bodies, tasks).mapInPandas(run, f"{schema}, response string, error string")


# --- URL checks ---------------------------------------------------------------------


def url_status(messages: DataFrame, policy: UrlCheck, check: Callable,
               *, tasks: int | None = None, threads: int = 1) -> DataFrame:
    """Status table for a URL policy: every distinct URL or host is asked once.

    ``check`` gets a URL (or a host, for DNS) and the time limit of the policy in
    milliseconds.
    """
    stage = Stage(messages)
    content = stage.content(policy.json_path, cleaned=False)
    limit = policy.timeout
    checker = check_hosts if policy.only_dns else check_urls
    return checker(
        stage.df, content, lambda name: check(name, limit), tasks=tasks, threads=threads
    )


def check_urls(messages: DataFrame, text: Column, head: Callable[[str], int | None],
               *, tasks: int | None = None, threads: int = 1) -> DataFrame:
    """Status table by HTTP: ``(url, status, error)``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found, errors = _answers(head, batch["url"].tolist(), threads)
            yield batch.assign(status=pd.array(found, dtype="Int32"),
                               error=pd.Series(errors, index=batch.index, dtype=object))

    return _spread(distinct_urls(messages, text), tasks).mapInPandas(
        run, "url string, status int, error string")


def check_hosts(messages: DataFrame, text: Column,
                resolve: Callable[[str], tuple[int, int] | None],
                *, tasks: int | None = None, threads: int = 1) -> DataFrame:
    """Status table by DNS: ``(host, status, answers, error)``; ``resolve`` gives
    the status and the number of answers."""
    hosts = distinct_urls(messages, text).select(url_host(F.col("url")).alias("host")).distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found, errors = _answers(resolve, batch["host"].tolist(), threads)
            found = [x or (None, None) for x in found]
            yield batch.assign(
                status=pd.array([x[0] for x in found], dtype="Int32"),
                answers=pd.array([x[1] for x in found], dtype="Int32"),
                error=pd.Series(errors, index=batch.index, dtype=object),
            )

    return _spread(hosts, tasks).mapInPandas(run, "host string, status int, answers int, error string")
