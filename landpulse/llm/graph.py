"""Connected components by DataFrame rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(v, label): for each end of an edge (a, b), a label that all of its component share.

    Each round hangs every vertex on its least neighbour, if that is less,
    follows those to their roots, and puts roots in the place of vertices:
    edges inside one root's tree are done with and never joined again, so
    rounds get smaller; they end when no edge is left. Each round is a written table:
    memory and lineage stay bounded, and what a lost executor held is read
    again. Empty edges give no rows. A vertex of many edges is a skewed key of
    a join with unique keys, which adaptive execution splits.
    """
    left = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-edges")
    labels = edges.select(F.explode(F.array("a", "b")).alias("v")).distinct().select("v", F.col("v").alias("label"))
    while not left.isEmpty():
        ends = left.select("a", "b").unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = written(ends.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.first("a")).alias("up")), f"{name}-up")
        while True:
            far = up.select(F.col("v").alias("up"), F.col("up").alias("root"))
            new = written(up.join(far, "up").select("v", F.col("up").alias("was"), F.col("root").alias("up")), f"{name}-up")
            up = new.select("v", "up")
            if new.where("up <> was").isEmpty():
                break
        side = lambda c: up.select(F.col("v").alias(c), F.col("up").alias(f"up_{c}"))  # noqa: B023, E731
        moved = left.join(side("a"), "a").join(side("b"), "b").where("up_a <> up_b")
        left = written(moved.select(F.least("up_a", "up_b").alias("a"), F.greatest("up_a", "up_b").alias("b")).distinct(), f"{name}-edges")
        to = up.select(F.col("v").alias("label"), "up")
        labels = written(labels.join(to, "label", "left").select("v", F.coalesce("up", "label").alias("label")), f"{name}-labels")
    return labels
