"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.sources.scratch import materialize


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id that can be reached from each end of ``edges`` (a, b).

    Each round moves every node to its smallest neighbour, if that is smaller, and the edges with their ends; edges
    within one node go. An edge from a node to the neighbour it moved to becomes one from there to where that neighbour
    moved, so no connection is lost, and the graph shrinks until no edge is left. Only that fact reaches the driver.
    Minima are taken before the shuffle, so a node with very many edges leaves each task as one row.
    """
    pairs = materialize(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("component", F.col("id"))
    while not pairs.isEmpty():
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        moved = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("smallest"))
        moved = materialize(moved.select("node", F.least("node", "smallest").alias("target")), "moved")
        ends = {end: moved.select(F.col("node").alias(end), F.col("target").alias(f"to_{end}")) for end in ("a", "b", "component")}
        labels = labels.join(ends["component"], "component", "left")
        labels = materialize(labels.select("id", F.coalesce("to_component", "component").alias("component")), "labels")
        shrunk = pairs.join(ends["a"], "a").join(ends["b"], "b").where("to_a <> to_b")
        pairs = materialize(shrunk.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "edges")
    return labels
