"""Carrying the mapping of a masked request over to its response."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def mapping_table(masked: DataFrame, *keys: str) -> DataFrame:
    """``(keys, mapping)`` of the requests in which something was masked."""
    return masked.where(F.col("mapping").isNotNull()).select(*(keys or ("msg_id",)), "mapping")


def with_mapping(responses: DataFrame, mappings: DataFrame, *keys: str) -> DataFrame:
    """Responses with the mapping of their request, NULL if it had none.

    Of several mappings of one key the smallest counts, so that a repeated
    request doesn't repeat its response.
    Mappings are few next to messages; Spark broadcasts them by their size or
    sorts and merges, and AQE splits a key that many responses share.
    """
    keys = list(keys or ("msg_id",))
    return responses.join(mappings.groupBy(*keys).agg(F.min("mapping").alias("mapping")), keys, "left")
