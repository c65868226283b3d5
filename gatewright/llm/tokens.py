"""Byte-pair encoding of whole texts, and exact token counts for every context limit."""

from __future__ import annotations

import base64
import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from gatewright.llm.common import ship
from gatewright.session import stored

ship(__name__)

VOCABULARY = "byte_bpe_50k"
SPECIAL = "<|endoftext|>"


class Encoder:
    """Ids of texts as little-endian 32-bit numbers, equal to those of the
    ``tokenizers`` library without added special tokens.

    ``tiktoken`` holds the same vocabulary as ranks and is several times faster
    on whole texts; the other library takes the texts that spell out the special
    token, which it alone knows.
    """

    def __init__(self, path: str | None = None):
        import tiktoken
        from tokenizers import Tokenizer

        import public_tokenizers

        path = path or public_tokenizers.path(f"{VOCABULARY}.json")
        self.library = Tokenizer.from_file(path)
        with open(path.removesuffix(".json") + ".tiktoken", "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                      special_tokens={})

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if SPECIAL in text:
            ids = self.library.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()


def worker_encoder(path: str | None = None) -> Encoder:
    """One encoder for each vocabulary and Python worker."""
    kept = sys.modules.setdefault("_gatewright_worker", types.ModuleType("_gatewright_worker"))
    encoders = kept.__dict__.setdefault("encoders", {})
    if path not in encoders:
        encoders[path] = Encoder(path)
    return encoders[path]


def lengths(docs: DataFrame, *, text_col: str = "text", path: str | None = None) -> DataFrame:
    """``n_tokens`` of every row; a null or empty text has none."""

    def each(batches):
        encoder = worker_encoder(path)
        for batch in batches:
            sizes = [len(encoder.encode(t)) // 4 for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64())], ["n_tokens"])

    return docs.select(F.col(text_col).alias("text")).mapInArrow(each, "n_tokens long")


BLOCK = 4096


def length_histogram(sizes: DataFrame) -> DataFrame:
    """One row for each encoded length, with the sums over all longer ones.

    ``n_tokens, n_docs, docs_at_least, tokens_at_least, truncated_total``: the
    last is what is left of all documents if each is cut to ``n_tokens``.
    ``docs_total`` and ``tokens_total`` are those of the whole corpus.

    The histogram is aggregated before the shuffle, so a length that a third of
    all rows share costs no more than others. Suffix sums are taken in blocks of
    lengths, and over the blocks. No rows give no rows.
    """
    # small, used twice, and made of all texts
    hist = stored(sizes.groupBy("n_tokens").agg(F.count("*").alias("n_docs")), "lengths")
    hist = hist.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn(
        "tokens", F.col("n_docs") * F.col("n_tokens"))
    from_here = W.partitionBy("block").orderBy(F.desc("n_tokens"))
    inner = hist.withColumn("docs_in", F.sum("n_docs").over(from_here)).withColumn(
        "tokens_in", F.sum("tokens").over(from_here))
    blocks = hist.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    everything = W.partitionBy(F.lit(1))
    later = everything.orderBy(F.desc("block")).rowsBetween(W.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    blocks = blocks.select(
        "block", F.coalesce(F.sum("d").over(later), none).alias("docs_later"),
        F.coalesce(F.sum("t").over(later), none).alias("tokens_later"),
        F.sum("d").over(everything).alias("docs_total"), F.sum("t").over(everything).alias("tokens_total"))
    out = inner.join(blocks, "block").select(
        "n_tokens", "n_docs", (F.col("docs_in") + F.col("docs_later")).alias("docs_at_least"),
        (F.col("tokens_in") + F.col("tokens_later")).alias("tokens_at_least"), "docs_total", "tokens_total")
    return out.withColumn("truncated_total", F.col("tokens_total") - F.col("tokens_at_least")
                          + F.col("n_tokens") * F.col("docs_at_least"))


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """``context, truncated_total, docs_cut, kept_whole`` for any context limits:
    those between two lengths follow from the sums at the next longer one."""
    if not limits:
        return histogram.sparkSession.createDataFrame(
            [], "context long, truncated_total long, docs_cut long, kept_whole long")
    # one look-up for each limit: the suffix sums at the next longer length
    next_longer = [F.min(F.when(F.col("n_tokens") > x, F.struct("n_tokens", "docs_at_least", "tokens_at_least")))
                   for x in limits]
    found = histogram.agg(F.max("tokens_total").alias("total"), F.max("docs_total").alias("docs"), F.array(*[
        F.struct(F.lit(int(x)).cast("long").alias("context"), longer.alias("sums"))
        for x, longer in zip(limits, next_longer)]).alias("limits"))
    none = F.lit(0).cast("long")
    cut, lost = (F.coalesce(F.col(f"sums.{c}"), none) for c in ("docs_at_least", "tokens_at_least"))
    rows = found.select(F.coalesce("total", none).alias("total"), F.coalesce("docs", none).alias("docs"), F.inline("limits"))
    return rows.select(
        "context", (F.col("total") - lost + F.col("context") * cut).alias("truncated_total"),
        cut.alias("docs_cut"), (F.col("docs") - cut).alias("kept_whole"))


def quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """``share, n_tokens``: the smallest length that at least the share of documents doesn't exceed."""
    below = F.col("docs_total") - F.col("docs_at_least") + F.col("n_docs")
    each = histogram.select("n_tokens", (below / F.col("docs_total")).alias("reach"),
                            F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share"))
    return each.where(F.col("reach") >= F.col("share")).groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))


def op4_token_counts(spark, sf_dir: str) -> DataFrame:
    return length_histogram(lengths(spark.read.parquet(f"{sf_dir}/documents.parquet")))
