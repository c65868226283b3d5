"""Steps of a stream that ask something outside or look it up, micro-batch by micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gatewright.operators.urls import distinct_urls
from gatewright.plans.correlate import mapping_table
from gatewright.session import release, work_scope
from gatewright.streaming.tables import BatchTable

Ask = Callable[[DataFrame], DataFrame]


class Answers:
    """The answers of one micro-batch, kept in a table.

    ``answers("moderation", ask)`` is a function for ``Inputs.responses``: the
    first run of a batch asks and keeps the answers, a repeated one reads them.
    Every asking step of a chain needs a name of its own.
    """

    def __init__(self, path: str, batch: int, at: int = 0):
        self.path, self.batch, self.at = path, batch, at

    def __call__(self, name: str, ask: Ask, keys: tuple[str, ...] = ("msg_id",), column: str = "response") -> Ask:
        def answered(messages: DataFrame) -> DataFrame:
            found = ask(messages)
            kept = [c for c in (*keys, "direction", column) if c in found.columns]
            schema = found.select(*dict.fromkeys(kept)).schema
            table = BatchTable(messages.sparkSession, f"{self.path}/{name}", schema, keys)
            return table.once(self.batch, self.at, lambda: found).drop("at", "batch")

        return answered


def in_batches(stream: DataFrame, step: Callable[[DataFrame, int], DataFrame], target: str, checkpoint: str,
               *, trigger: dict | None = None) -> StreamingQuery:
    """Each micro-batch through ``step(batch, number)``, into its own folder of ``target``.

    ``trigger`` as for ``DataStreamWriter.trigger``, for instance
    ``{"processingTime": "10 seconds"}``; without it everything that is there is
    processed and the query ends. A batch that is run again replaces its folder.
    What a batch wrote on its way is deleted behind it.
    """
    def write(batch: DataFrame, number: int) -> None:
        with work_scope() as made:
            step(batch, number).write.mode("overwrite").parquet(f"{target}/batch={number}")
        release(batch.sparkSession, made)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
    if trigger is None:
        query.awaitTermination()
    return query


def latest(batch: DataFrame, time: str) -> int:
    """The newest event time in seconds; 0 without one."""
    return batch.agg(F.floor(F.max(F.unix_micros(time)) / 1_000_000)).first()[0] or 0


class UrlStatuses:
    """URL statuses that are asked for once and hold for ``expiry`` seconds of event time.

    Of a micro-batch the distinct URLs are combined before they move, so that a
    URL in a third of all messages is one row; those with a status that still
    holds are left out, the others are asked in the tasks, each once. ``check``
    takes a frame with ``url`` and returns ``url, status``. Statuses are read by
    time, and old ones are deleted: the table holds what ``expiry`` spans, twice at most.
    """

    def __init__(self, spark: SparkSession, path: str, check: Callable[[DataFrame], DataFrame], expiry: int,
                 merge: int = 64):
        self.table = BatchTable(spark, path, "url string, status int", ("url",))
        self.check, self.expiry, self.merge = check, expiry, merge

    def of(self, messages: DataFrame, text: Column, batch: int, now: int) -> DataFrame:
        """``url, status`` for all URLs of the batch; ``now`` is its event time."""
        since = now - self.expiry + 1
        if batch and batch % self.merge == 0:
            self.table.compact(batch - 1)
        known = self.table.latest(self.table.before(batch, since)).select("url", "status")

        def asked() -> DataFrame:
            fresh = distinct_urls(messages, text).join(known.select("url"), "url", "left_anti")
            return self.check(fresh)

        new = self.table.once(batch, now, asked).select("url", "status")
        # only what no repeated run of this batch can need
        self.table.expire(since - self.expiry)
        return known.unionByName(new)


class Mappings:
    """The mappings of masked requests, kept over runs.

    Every batch adds its own; a request that is sent again replaces its mapping;
    a batch that is run again changes nothing. Mappings older than ``expiry``
    seconds of event time count no more and are deleted. Every ``merge`` batches
    the parts become one.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str = "msg_id string", *, expiry: int, merge: int = 64):
        from gatewright.functions.patterns import MAPPING

        self.keys = tuple(part.split()[0] for part in schema.split(","))
        self.table = BatchTable(spark, path, f"{schema}, mapping {MAPPING}", self.keys)
        self.expiry, self.merge = expiry, merge

    def add(self, masked: DataFrame, batch: int, now: int) -> DataFrame:
        """Keep the mappings of a batch's masked requests; gives those of this batch."""
        if batch and batch % self.merge == 0:
            self.table.compact(batch - 1)
        new = self.table.once(batch, now, lambda: mapping_table(masked, *self.keys))
        self.table.expire(now - self.expiry + 1)
        return new.drop("at", "batch")

    def current(self, now: int | None = None) -> DataFrame:
        """``(keys, mapping)``, one row for each key, for ``with_mapping``."""
        return self.table.current(since=None if now is None else now - self.expiry + 1)
