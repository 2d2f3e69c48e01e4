"""Connected components of a graph given as edges, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfrank.session import write_table


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a long, b long); component is the smallest node reachable.

    Each round every node points to its smallest neighbour or itself, pointers are followed to their
    roots by doubling, nodes are renamed by their roots and equal edges merged, until no edge is left.  Every
    node with an edge ends in a tree of two or more, so a round at least halves them.  The
    smallest neighbour is a partial aggregate: a node with very many edges is no hot key.
    Rounds are written to the shared folder; nothing is collected but whether something is left.
    """
    left = write_table(
        edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "edges"
    )
    names = None
    while not left.isEmpty():
        both = left.select(F.col("a").alias("node"), F.col("b").alias("to")).union(
            left.select(F.col("b").alias("node"), F.col("a").alias("to"))
        )
        root = _roots(both.groupBy("node").agg(F.least(F.min("to"), F.col("node")).alias("to")))
        moved = (
            left.join(root.select(F.col("node").alias("a"), F.col("to").alias("to_a")), "a")
            .join(root.select(F.col("node").alias("b"), F.col("to").alias("to_b")), "b")
            .select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
            .where("a <> b")
            .distinct()
        )
        left = write_table(moved, "edges")
        if names is None:
            names = root.withColumnRenamed("to", "component")
        else:
            step = root.select(F.col("node").alias("component"), "to")
            names = names.join(step, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
            names = write_table(names, "components")
    if names is None:
        return edges.sparkSession.createDataFrame([], "node long, component long")
    return names


def _roots(pointer: DataFrame) -> DataFrame:
    """(node, to) with every pointer followed to its end; each pass doubles the steps followed."""
    pointer = write_table(pointer.withColumn("moved", F.lit(True)), "pointers")
    while not pointer.where("moved").isEmpty():
        onward = pointer.select(F.col("node").alias("to"), F.col("to").alias("next"))
        jumped = pointer.select("node", "to").join(onward, "to")
        pointer = write_table(
            jumped.select("node", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved")), "pointers"
        )
    return pointer.select("node", "to")
