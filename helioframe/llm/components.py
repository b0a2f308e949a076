"""Connected components by repeated contraction, all on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.session import stage


def components(edges: DataFrame) -> DataFrame:
    """``v``, ``c`` (smallest vertex of its component) for every vertex of ``edges`` (a, b).

    Each round hooks every vertex of the contracted graph to its smallest neighbour
    and follows two hooks; a component at least halves, so rounds grow with the log of
    its size. Tables are written each round, so a lost executor costs one round.
    """
    both = edges.select(F.col("a").alias("v"), F.col("b").alias("w")).union(edges.select("b", "a"))
    left = stage(both.where("v <> w").distinct(), "edges")
    labels = stage(left.select("v").distinct().select("v", F.col("v").alias("c")), "labels")
    while not left.isEmpty():
        hook = left.groupBy("v").agg(F.min("w").alias("w")).select("v", F.least("v", "w").alias("to"))
        hook = stage(hook, "hooks")
        further = hook.select(F.col("v").alias("to"), F.col("to").alias("further"))
        hook = stage(hook.join(further, "to", "left").select("v", F.coalesce("further", "to").alias("to")), "hooks")
        at = hook.select(F.col("v").alias("c"), "to")
        labels = stage(labels.join(at, "c", "left").select("v", F.coalesce("to", "c").alias("c")), "labels")
        ends = hook.select(F.col("v").alias("w"), F.col("to").alias("to_w"))
        left = left.join(hook, "v").join(ends, "w").select(F.col("to").alias("v"), F.col("to_w").alias("w"))
        left = stage(left.where("v <> w").distinct(), "edges")
    return labels
