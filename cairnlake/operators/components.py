"""Connected components by minimum label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairnlake.session import shared_dir


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node of an edge list.

    Each round takes the smallest label among a node's neighbours (a map-side
    combined aggregate) and then the label of that label, so chains of length
    n take about log n rounds. Lineage is cut by a checkpoint in the shared
    folder. Null ends and loops are fine: a null end is no node, a loop is a
    node by itself. An edge list without rows has no nodes.
    """
    shared_dir(edges.sparkSession)
    e = edges.select(F.col(a).alias("x"), F.col(b).alias("y"))
    both = e.unionByName(e.select(F.col("y").alias("x"), F.col("x").alias("y"))).where("x is not null").distinct().checkpoint()
    labels = both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("label")).checkpoint()
    while True:  # labels only get smaller, so this ends; never before all have settled
        near = both.where("y is not null").join(labels.withColumnRenamed("x", "y"), "y").groupBy("x").agg(F.min("label").alias("near"))
        step = labels.join(near, "x", "left").select("x", F.least("label", F.coalesce("near", "label")).alias("label"), F.col("label").alias("old"))
        jump = step.select(F.col("x").alias("label"), F.col("label").alias("top"))
        new = step.join(jump, "label", "left").select("x", F.least("label", F.coalesce("top", "label")).alias("label"), "old").checkpoint()
        labels = new.select("x", "label")
        if new.where(F.col("label") != F.col("old")).isEmpty():
            break
    return labels.select(F.col("x").alias("node"), F.col("label").alias("component"))
