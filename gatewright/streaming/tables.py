"""Tables that micro-batches add to, and that outlive a run."""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART = re.compile(r"/(part|merged)-(\d+)-at-(-?\d+)$")


class Part(NamedTuple):
    """A folder of rows: of one batch, or ``merged`` of all batches up to it; ``at`` is its latest time."""

    batch: int
    at: int
    merged: bool
    folder: str


class BatchTable:
    """Rows by key, one folder for each micro-batch, with the batch's number and time in seconds.

    A batch that is run again finds what it wrote and changes nothing. The row of
    the latest batch counts for a key. Parts from before a bound are not read and
    can be deleted; parts can be merged into one, so that their number stays small.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType, keys: tuple[str, ...]):
        self.spark, self.path, self.keys = spark, path, keys
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.names = [f.name for f in schema]
        self.schema = T.StructType([*schema, T.StructField("at", T.LongType()), T.StructField("batch", T.LongType())])
        self._files = self._place(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def _place(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def parts(self) -> list[Part]:
        """Everything that was written to its end, by batch."""
        out = []
        for status in self._files.globStatus(self._place(f"{self.path}/*/_SUCCESS")) or []:
            folder = status.getPath().getParent().toString()
            kind, batch, at = PART.search(folder).groups()
            out.append(Part(int(batch), int(at), kind == "merged", folder))
        return sorted(out)

    def once(self, batch: int, at: int, make: Callable[[], DataFrame]) -> DataFrame:
        """What the batch wrote before, else what ``make`` gives, written."""
        if not any(p.batch == batch or p.merged and p.batch > batch for p in self.parts()):
            rows = make().select(*self.names, F.lit(at).cast("long").alias("at"), F.lit(batch).cast("long").alias("batch"))
            rows.write.mode("overwrite").parquet(f"{self.path}/part-{batch}-at-{at}")
        return self.rows(lambda p: p.batch == batch or p.merged and p.batch > batch).where(F.col("batch") == batch)

    def rows(self, wanted: Callable[[Part], bool] = lambda p: True, since: int | None = None) -> DataFrame:
        """Rows as they were written, with ``at`` and ``batch``, from ``since`` on."""
        folders = [p.folder for p in self.parts() if wanted(p) and (since is None or p.at >= since)]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).parquet(*folders)
        return rows if since is None else rows.where(F.col("at") >= since)

    def before(self, batch: int, since: int | None = None) -> DataFrame:
        """Rows of earlier batches."""
        return self.rows(lambda p: True, since).where(F.col("batch") < batch)

    def latest(self, rows: DataFrame) -> DataFrame:
        """One row for each key: that of the latest batch, and there the smallest."""
        values = [n for n in (*self.names, "at", "batch") if n not in self.keys]
        best = F.min(F.struct((-F.col("batch")).alias("newest"), *values)).alias("row")
        return rows.groupBy(*self.keys).agg(best).select(*self.keys, *[F.col(f"row.{v}").alias(v) for v in values])

    def current(self, since: int | None = None) -> DataFrame:
        """The table's rows by key."""
        return self.latest(self.rows(since=since)).select(*self.names)

    def expire(self, before: int) -> None:
        """Delete the parts that hold nothing from this time on."""
        for part in self.parts():
            if part.at < before:
                self._files.delete(self._place(part.folder), True)

    def compact(self, upto: int) -> None:
        """Merge the parts of all batches up to this one.

        The merged part is whole before the others go; a run that ends in between
        leaves rows twice, which count once.
        """
        old = [p for p in self.parts() if p.batch <= upto]
        if len(old) < 2:
            return
        folders = {p.folder for p in old}
        rows = self.latest(self.rows(lambda p: p.folder in folders)).select(*self.schema.names)
        name = f"{self.path}/merged-{old[-1].batch}-at-{max(p.at for p in old)}"
        if any(p.folder.endswith(name.rsplit("/", 1)[1]) for p in old):
            return  # nothing new since the last time
        rows.write.mode("overwrite").parquet(name)
        for part in old:
            self._files.delete(self._place(part.folder), True)
