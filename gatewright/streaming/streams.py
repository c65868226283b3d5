"""Policies on streams of messages."""

from __future__ import annotations

import datetime
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from gatewright.config import PiiRegex
from gatewright.functions.patterns import MAPPING, empty_mapping
from gatewright.operators.apply import apply
from gatewright.operators.stage import Inputs
from gatewright.streaming.asking import in_batches
from gatewright.streaming.tables import BatchTable


def file_stream(spark, path: str, schema, files: int | None = None) -> DataFrame:
    """A Parquet table, file or folder, as a stream; ``files`` bounds a micro-batch."""
    reader = spark.readStream.schema(schema)
    if files is not None:
        reader = reader.option("maxFilesPerTrigger", files)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if system.getFileStatus(place).isFile():
        # a stream reads folders: the file's own, and in it nothing else
        reader, path = reader.option("pathGlobFilter", place.getName()), place.getParent().toString()
    return reader.parquet(path)


def drain(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Process everything that is there, into a Parquet folder, and stop."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def by_batch(stream: DataFrame, step: Callable[[DataFrame], DataFrame], target: str,
             checkpoint: str) -> StreamingQuery:
    """Everything that is there, micro-batch by micro-batch, through a batch step.

    For policies that look something up in tables: each micro-batch reads them
    anew. A batch that is run again replaces its own folder, so no row is
    written twice. See ``asking`` for steps that ask, and for other triggers.
    """
    return in_batches(stream, lambda batch, _: step(batch), target, checkpoint)


def report_stream(checked: DataFrame, *by: str, time: str = "ts", window: str = "10 minutes",
                  late: str = "10 minutes") -> DataFrame:
    """``policy_report`` by windows of event time, for output mode update.

    A group's row comes again whenever its counts change; ``keep_report`` holds
    the latest. State is dropped when the watermark has passed a window: rows
    that come more than ``late`` behind the newest time are not counted any more.
    """
    timed = checked.withWatermark(time, late)
    parts = (F.window(time, window), "direction", *by, F.col("outcome.error_type").alias("error_type"),
             F.col("outcome.error_code").alias("error_code"))
    counts = timed.groupBy(*parts).agg(
        F.count("*").alias("messages"), F.sum(F.octet_length("payload")).alias("payload_bytes"))
    return counts.select(F.col("window.start").alias("window_start"), *[c for c in counts.columns if c != "window"])


def keep_report(report: DataFrame, path: str, checkpoint: str, *, trigger: dict | None = None,
                merge: int = 64) -> StreamingQuery:
    """Rows of ``report_stream`` in a table that is read by ``read_report``."""
    table = _report_table(report.sparkSession, path, report.schema)

    def keep(batch: DataFrame, number: int) -> None:
        table.once(number, 0, lambda: batch)
        if number % merge == merge - 1:
            table.compact(number)

    query = (
        report.writeStream.foreachBatch(keep)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    if trigger is None:
        query.awaitTermination()
    return query


def _report_table(spark, path: str, schema) -> BatchTable:
    keys = tuple(f.name for f in schema if f.name not in ("messages", "payload_bytes"))
    return BatchTable(spark, path, schema, keys)


def read_report(spark, path: str, schema) -> DataFrame:
    """The latest counts of every window and group."""
    return _report_table(spark, path, schema).current()


def restore_stream(
    requests: DataFrame,
    responses: DataFrame,
    policy: PiiRegex,
    *,
    within: str = "10 minutes",
    late: str = "10 minutes",
) -> DataFrame:
    """Responses restored with the mapping of their request.

    Both streams carry ``msg_id``, ``direction``, ``payload`` and an event time
    ``ts``. A mapping is kept for ``within`` after its request. Requests with
    nothing to mask carry an empty one, so that their responses leave at once
    and unchanged; only a response that comes later, or without a request, waits
    until the watermark has passed it.
    """
    timed = requests.withColumnRenamed("ts", "asked_at").withWatermark("asked_at", late)
    masked = apply(timed, policy, flow="REQUEST")
    stored = masked.select(
        F.col("msg_id").alias("asked_id"), "asked_at",
        F.coalesce("mapping", empty_mapping()).alias("mapping"),
    )
    arrived = responses.withWatermark("ts", late)
    joined = arrived.join(
        stored,
        (F.col("msg_id") == F.col("asked_id"))
        & (F.col("ts") >= F.col("asked_at"))
        & (F.col("ts") <= F.col("asked_at") + F.expr(f"interval {within}")),
        "left",
    ).drop("asked_id", "asked_at")
    return apply(joined, policy, Inputs(mapping="mapping"), flow="RESPONSE")


RESTORING = "mapping string, asked_at timestamp, answers array<struct<payload:string,direction:string,ts:timestamp>>"


def restore_by_timers(
    requests: DataFrame,
    responses: DataFrame,
    policy: PiiRegex,
    *,
    within_seconds: int = 600,
    late: str = "10 minutes",
) -> DataFrame:
    """``restore_stream`` with state and timers by message instead of a join.

    A request leaves its mapping as state, for ``within_seconds``. A response that
    finds it leaves at once; one that comes before it waits until the watermark
    has passed the response's own time, since a request that it answers is not
    later. State goes with its timer. A message that is answered
    or asked twice is restored each time with the mapping that came first; the
    rows of one message are few, so that no state grows with the stream.
    Columns: ``msg_id, direction, ts, payload`` and those of the policy.
    """
    masked = apply(requests, policy, flow="REQUEST")
    mapping = F.to_json(F.coalesce("mapping", empty_mapping()))
    kind = responses.schema["msg_id"].dataType.simpleString()
    both = masked.select("msg_id", "ts", mapping.alias("mapping"), F.lit(None).cast("string").alias("payload"),
                         F.lit(None).cast("string").alias("direction")).unionByName(
        responses.select("msg_id", "ts", F.lit(None).cast("string").alias("mapping"), "payload", "direction"))

    def meet(key, frames, state: GroupState):
        known, asked_at, waiting = (*state.get,) if state.exists else (None, None, [])
        waiting = [tuple(w) for w in waiting or []]
        out = []

        def leave(answer, found):
            out.append((key[0], *answer, found))

        if state.hasTimedOut:
            for answer in waiting:
                leave(answer, None)
            state.remove()
        else:
            # a call has few rows: columns are read as they are, a frame's own iterators cost more than all else here
            rows = [r for f in frames for r in zip(f["mapping"], f["ts"], f["payload"], f["direction"])]
            for mapping, ts, *_ in rows:
                if mapping is not None and (known is None or ts < asked_at):
                    known, asked_at = mapping, ts.to_pydatetime()
            arrived = [(payload, direction, ts.to_pydatetime()) for mapping, ts, payload, direction in rows if mapping is None]
            span = datetime.timedelta(seconds=within_seconds)
            kept = []
            for answer in waiting + arrived:
                if known is None:
                    kept.append(answer)
                else:
                    leave(answer, known if asked_at <= answer[2] <= asked_at + span else None)
            # up to when a partner of what is left can come
            last = max([a[2] for a in kept] if known is None else [asked_at + span])
            state.update((known, asked_at, kept))
            state.setTimeoutTimestamp(max(int(last.timestamp() * 1000), state.getCurrentWatermarkMs()) + 1)
        if out:
            ids, payloads, directions, times, found = zip(*out)
            yield pd.DataFrame({"msg_id": list(ids), "payload": list(payloads), "direction": list(directions),
                                "ts": list(times), "found": pd.Series(found, dtype=object)})

    found = both.withWatermark("ts", late).groupBy("msg_id").applyInPandasWithState(
        meet, f"msg_id {kind}, payload string, direction string, ts timestamp, found string", RESTORING, "append",
        GroupStateTimeout.EventTimeTimeout)
    restored = found.withColumn("mapping", F.from_json("found", MAPPING)).drop("found")
    return apply(restored, policy, Inputs(mapping="mapping"), flow="RESPONSE")
