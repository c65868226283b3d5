"""Connected components by rounds of contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatewright.session import stored


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``; root is the smallest
    node of the component. Nodes without edges don't appear.

    Each round hooks every node to its smallest neighbour, follows the hooks to
    their ends and replaces nodes by these ends; edges inside a star vanish. In
    each round every node with a smaller neighbour is merged away. A hub costs
    one row for each of its edges: minima are partly aggregated before the
    shuffle, and labels join on a side that has one row for each node, so that
    AQE can split the other. Every round starts from written tables.

    Nulls and self loops are ignored; repeated edges count once; no edges give
    no rows.
    """
    named = edges.select(F.col("a").alias("a"), F.col("b").alias("b"))
    named = named.where("a is not null and b is not null")
    both = named.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left = stored(both, "edges")
    # a node whose only edges are self loops is its own component
    labels = None
    alone = left.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("root"))
    left = left.where("a <> b")
    while not left.isEmpty():
        hooks = _follow(stored(_hooks(left), "hooks"))
        labels = hooks if labels is None else stored(_relabel(labels, hooks), "labels")
        left = stored(_contract(left, hooks), "edges")
    if labels is None:
        return alone
    return labels.unionByName(alone.join(labels, "node", "left_anti"))


def _hooks(edges: DataFrame) -> DataFrame:
    """Each node with the smallest of itself and its neighbours."""
    ends = edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.col("a").alias("root")),
        F.struct(F.col("b").alias("node"), F.col("a").alias("root")))).alias("e")).select("e.*")
    return ends.groupBy("node").agg(F.min("root").alias("root"))


def _follow(hooks: DataFrame) -> DataFrame:
    """Every hook replaced by the end of its chain; chains halve each time."""
    while True:
        to = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
        moved = hooks.join(to, "root").select(
            "node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved"))
        moved = stored(moved, "hooks")
        if moved.where("moved").isEmpty():
            return moved.select("node", "root")
        hooks = moved.select("node", "root")


def _relabel(labels: DataFrame, hooks: DataFrame) -> DataFrame:
    """Old labels carried to the new roots. Nodes that meet later than the first round are roots by then, so none is new."""
    to = hooks.select(F.col("node").alias("root"), F.col("root").alias("new"))
    return labels.join(to, "root", "left").select("node", F.coalesce("new", "root").alias("root"))


def _contract(edges: DataFrame, hooks: DataFrame) -> DataFrame:
    ra = hooks.select(F.col("node").alias("a"), F.col("root").alias("ra"))
    rb = hooks.select(F.col("node").alias("b"), F.col("root").alias("rb"))
    ends = edges.join(ra, "a").join(rb, "b").where("ra <> rb")
    return ends.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
