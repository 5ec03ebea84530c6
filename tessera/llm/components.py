"""Connected components by contraction, for edges of any number and shape."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import join_hot, materialise


def components(edges: DataFrame) -> DataFrame:
    """node, comp (the smallest node reachable) for the nodes of edges(a, b).

    In each round every component hooks to its smallest neighbour and pointers are halved twice; the
    edges between what is left, made distinct, are the next round's. The number of rounds grows with
    the logarithm of the longest path; each round's table is written, so a lost executor costs a stage.
    A component or a node may have any share of the rows.
    """
    left = materialise(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        up = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("comp"))
        up = _halved(_halved(materialise(up, "parents")))
        if labels is None:
            labels = up
        else:
            moved = up.select(F.col("node").alias("comp"), F.col("comp").alias("to"))
            labels = materialise(join_hot(labels, moved, "comp", "left").select("node", F.coalesce("to", "comp").alias("comp")), "labels")
        a, b = (up.select(F.col("node").alias(x), F.col("comp").alias(f"{x}_up")) for x in ("a", "b"))
        left = materialise(join_hot(materialise(join_hot(left, a, "a"), "half"), b, "b").select(F.least("a_up", "b_up").alias("a"), F.greatest("a_up", "b_up").alias("b")).where("a <> b").distinct(), "edges")
    return labels if labels is not None else left.select(F.col("a").alias("node"), F.col("b").alias("comp"))


def _halved(up: DataFrame) -> DataFrame:
    above = up.select(F.col("node").alias("comp"), F.col("comp").alias("above"))
    return materialise(join_hot(up, above, "comp", "left").select("node", F.coalesce("above", "comp").alias("comp")), "parents")
