"""Reading tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table, file or folder.

    Its row groups are its tasks. Nothing is moved here: where a table has fewer
    row groups than there are cores, ``repartition`` is the caller's choice.
    """
    return spark.read.parquet(path)
