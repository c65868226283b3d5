"""Helpers that several operators share."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The letters whose case is folded.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# Words are runs of anything but these blanks.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def ship(module: str) -> None:
    """Send the module's functions to the workers by value, so that nothing has
    to be installed there."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case; other letters stay as they are."""
    return F.translate(text, UPPER, LOWER)


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with more columns that are computed once for each row.

    Catalyst may copy the expression of an ordinary column into each of its
    uses, also into lambda functions, which would repeat it for each element.
    A one-row generator stops that.
    """
    for name, column in columns.items():
        df = df.select("*", F.explode(F.array(column)).alias(name))
    return df


def table(spark, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
