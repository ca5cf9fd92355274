"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklet.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the least node that can be reached, for each node of ``u``, ``v``.

    Rounds of contraction: every node moves to its least neighbour, if that is less, and edges
    become edges between where their ends have moved. The least node of a component never moves,
    so it is what remains. Nodes that are no local minimum vanish in each round, so there are few;
    each round is written down. Minima are combined before the shuffle, so a node with very many
    neighbours is no burden; joins may be split by adaptive execution.
    """
    spark = edges.sparkSession
    ends = edges.select("u", "v").filter("u <> v")
    current = written(ends.unionAll(ends.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = None
    while not current.isEmpty():
        moves = written(current.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("to")), "moves")
        if labels is None:
            labels = moves.select("node", F.col("to").alias("component"))
        else:
            labels = labels.join(moves.withColumnRenamed("node", "at"), F.col("component") == F.col("at"), "left").select(
                "node", F.coalesce("to", "component").alias("component"))
        labels = written(labels, "labels")
        moved = current.join(moves, F.col("u") == F.col("node")).select(F.col("to").alias("u"), "v")
        moved = moved.join(moves, F.col("v") == F.col("node")).select("u", F.col("to").alias("v"))
        current = written(moved.filter("u <> v").distinct(), "edges")
    if labels is None:
        return spark.createDataFrame([], "node long, component long")
    return labels
