"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partyfold.llm.storage import Workspace


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def components(edges: DataFrame, space: Workspace) -> DataFrame:
    """`node, label` for every node of the `a, b` edges; the label is a node of the component.

    In each round every node moves to the smallest node around it, and edges are drawn
    anew between the nodes moved to. Edges within a component vanish and the rest get fewer,
    a star at once, so that all rounds together handle little more than the first. With
    node numbers that are hashes the rounds grow with the logarithm of the longest path.
    Groups are combined before the shuffle, joins are equi-joins that adaptive execution can split,
    and every round is written to `space`. An empty table gives an empty one.
    """
    left = space.written(edges.select(*_ordered("a", "b")).where("a <> b").distinct(), "edges")
    labels = None
    while True:
        both = left.select("a", "b").unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moved = space.written(
            both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
            .select("node", F.least("node", "near").alias("label")),
            "moved",
        )
        if labels is None:
            labels = moved
        else:
            onward = moved.select(F.col("node").alias("label"), F.col("label").alias("next"))
            labels = labels.join(onward, "label", "left").select(
                "node", F.coalesce("next", "label").alias("label")
            )
        of_a = moved.select(F.col("node").alias("a"), F.col("label").alias("to_a"))
        of_b = moved.select(F.col("node").alias("b"), F.col("label").alias("to_b"))
        left = space.written(
            left.join(of_a, "a").join(of_b, "b").where("to_a <> to_b")
            .select(*_ordered("to_a", "to_b")).distinct(),
            "edges",
        )
        if left.isEmpty():
            return labels
