"""Connected components of a stored edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialize


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) of every node of the edges ``a``, ``b``.

    In each round a node takes the smallest label among its neighbours, then the label of its label, so paths are
    halved while labels spread. Every round is stored, which cuts the lineage. Minima are partially aggregated, so a
    node with very many edges gathers nowhere. No edges give no rows.
    """
    both = materialize(edges.where("a <> b").select("a", "b").unionByName(
        edges.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node"))
                         .agg(F.least(F.min("b"), F.col("a")).alias("root")), "labels")
    while True:
        offered = (both.join(labels.select(F.col("node").alias("b"), "root"), "b")
                   .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("offered")))
        lower = labels.join(offered, "node").select("node", F.least("root", "offered").alias("step"),
                                                    F.col("root").alias("old"))
        lower = materialize(lower, "labels")
        jumped = lower.join(lower.select(F.col("node").alias("step"), F.col("step").alias("jump")), "step").select(
            "node", F.least("step", "jump").alias("root"), "old")
        stored = materialize(jumped, "labels")
        labels = stored.select("node", "root")
        if stored.where("root <> old").isEmpty():
            return labels
