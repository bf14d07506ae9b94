"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import stored

#: Edges that one task takes at least; small graphs aren't spread over hundreds of tasks.
EDGES_PER_TASK = 100_000


def components(edges: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, label): the smallest node each node of ``edges`` (a, b) can reach.

    Each round every component of labels so far takes the smallest label that any of
    its nodes sees at a neighbour, and then the label which that one takes. So whole
    components move, and what remains at least halves on chains. All steps are joins
    and partially aggregated minima: a node with many edges, or a component with many
    nodes, costs one row per task. ``known`` are labels of some of the same edges.
    """
    both = edges.where("a <> b").select("a", "b")
    both = stored(both.union(both.select("b", "a")).distinct(), "edges")
    tasks = 4 + both.count() // EDGES_PER_TASK
    both = both.coalesce(tasks)
    labels = both.select(F.col("a").alias("node")).distinct()
    if known is None:
        labels = labels.withColumn("label", F.col("node"))
    else:
        labels = labels.join(known, "node", "left").withColumn("label", F.coalesce("label", "node"))
    labels = stored(labels.coalesce(tasks), "labels")
    while True:
        seen = both.join(labels, both["b"] == labels["node"]).select(F.col("a").alias("node"), "label", F.lit(None).cast("long").alias("own"))
        own = labels.select("node", "label", F.col("label").alias("own"))
        near = seen.union(own).groupBy("node").agg(F.min("label").alias("near"), F.min("own").alias("own")).coalesce(tasks)
        moves = stored(near.groupBy("own").agg(F.min("near").alias("to")).where("to < own").coalesce(tasks), "moves")
        if moves.isEmpty():
            return labels
        again = moves.select(F.col("own").alias("to"), F.col("to").alias("on"))
        jumped = moves.join(again, "to", "left").select(F.col("own").alias("label"), F.coalesce("on", "to").alias("now"))
        labels = labels.join(jumped, "label", "left").select("node", F.coalesce("now", "label").alias("label"))
        labels = stored(labels.coalesce(tasks), "labels")
