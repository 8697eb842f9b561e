"""Connected components of a graph of any size, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwarden.session import materialise


def components(edges: DataFrame) -> DataFrame:
    """node, root for all nodes of ``edges`` (columns a, b); root is the least node of the component.

    Each round every node points to its least neighbour (or itself) and the edges are rewritten
    between the nodes pointed to, which at least halves the nodes of each component. Rounds are
    written to the shared folder, so the plan does not grow and a lost executor costs little.
    """
    edges = materialise(edges.filter("a <> b").distinct())
    mapping = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")))
        edges = (
            edges.join(step.select(F.col("node").alias("a"), F.col("root").alias("x")), "a")
            .join(step.select(F.col("node").alias("b"), F.col("root").alias("y")), "b")
            .filter("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct()
        )
        edges = materialise(edges)
        if mapping is None:
            mapping = step
        else:
            onward = step.select(F.col("node").alias("root"), F.col("root").alias("_next"))
            mapping = materialise(mapping.join(onward, "root", "left").select("node", F.coalesce("_next", "root").alias("root")))
    if mapping is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    # A root that pointed on within the same round is followed by the later rounds, except for
    # chains that closed in the last one.
    while True:
        onward = mapping.select(F.col("node").alias("root"), F.col("root").alias("_next"))
        moved = materialise(mapping.join(onward, "root", "left").select("node", F.coalesce("_next", "root").alias("root"), (F.coalesce("_next", "root") != F.col("root")).alias("_moved")))
        mapping = moved.select("node", "root")
        if moved.filter("_moved").isEmpty():
            return mapping
