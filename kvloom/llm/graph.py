"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kvloom.llm.common import discard, kept_table


def components(edges: DataFrame) -> DataFrame:
    """id, component (smallest id reachable) for every id that has an edge.

    `edges` has a and b. In each round every node moves to the smallest of itself and its
    neighbours, and to where that one moves; edges are drawn anew between what is left and those
    within one node go. A node that is not the smallest around it always moves, so the number of
    nodes with edges at least halves. Every round is written, so that no lineage grows, and deleted
    when the next one is there.
    """
    edges = kept_table(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    labels = None
    while edges.limit(1).count():
        before = [edges] if labels is None else [edges, labels]
        both = edges.union(edges.select("b", "a"))
        least = kept_table(
            both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least"
        )
        further = least.select(F.col("a").alias("m"), F.col("m").alias("mm"))
        moves = kept_table(least.join(further, "m").select("a", F.col("mm").alias("to")), "moves")
        if labels is None:
            labels = moves.select(F.col("a").alias("id"), F.col("to").alias("component"))
        else:
            moved = moves.withColumnRenamed("a", "component")
            labels = labels.join(moved, "component", "left").select(
                "id", F.coalesce("to", "component").alias("component")
            )
        labels = kept_table(labels, "labels")
        to_a = moves.select("a", F.col("to").alias("ta"))
        to_b = moves.select(F.col("a").alias("b"), F.col("to").alias("tb"))
        edges = kept_table(
            edges.join(to_a, "a")
            .join(to_b, "b")
            .filter("ta <> tb")
            .select(F.col("ta").alias("a"), F.col("tb").alias("b"))
            .distinct(),
            "edges",
        )
        discard(least, moves, *before)
    if labels is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return labels
