"""Connected components of an edge table by label propagation with shortcuts, all on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label`` (the smallest node of its component) for every node of the edges (x, y).

    A round gives each node the smallest label among its neighbours (a partial aggregate, so a hub costs a row per
    task) and then that label's own label, so rounds grow with the logarithm of a path's length.  Each round is a
    checkpoint; it ends when no label changes.
    """
    both = settle(edges.select("x", "y").unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct())
    labels = settle(both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("least")).select("node", F.least("node", "least").alias("label")))
    while True:
        of = labels.select(F.col("node").alias("y"), F.col("label").alias("their"))
        near = both.join(of, "y").groupBy(F.col("x").alias("node")).agg(F.min("their").alias("near"))
        step = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = settle(step.join(jump, "label").select("node", "old", F.least("label", "next").alias("label")))
        if new.where("label <> old").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")
