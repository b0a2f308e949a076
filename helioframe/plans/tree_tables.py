"""Fitted trees as rows, and scoring by joins over those rows.

A node row says which feature it asks, the threshold or the categories that lead left,
its two children, and what a leaf adds. The table is small (rounds times nodes of a
tree) and is written with a saved model, so that other engines can read and check it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NODE_SCHEMA = (
    "tree int, weight double, node int, feature int, threshold double, categories array<double>, "
    "left int, right int, value double"
)
_ASK = re.compile(r"^(\s*)If \(feature (\d+) (?:<= (\S+)|in \{([^}]*)\})\)$")
_LEAF = re.compile(r"^(\s*)Predict: (\S+)$")


def tree_nodes(text: str) -> list[tuple]:
    """(node, feature, threshold, categories, left, right, value) rows of a tree's description, root first."""
    rows: list[list] = []
    open_nodes: list[tuple[int, int]] = []  # (indent, row) of questions whose right child is missing
    for line in text.split("\n")[1:]:
        ask, leaf = _ASK.match(line), _LEAF.match(line)
        if not ask and not leaf:
            continue  # "Else" repeats the question
        at = len(rows)
        indent = len((ask or leaf).group(1))
        while open_nodes and open_nodes[-1][0] >= indent:
            open_nodes.pop()
        if open_nodes:
            parent = rows[open_nodes[-1][1]]
            parent[4 if parent[4] is None else 5] = at
        if ask:
            codes = ask.group(4)
            rows.append([at, int(ask.group(2)), None if ask.group(3) is None else float(ask.group(3)),
                         None if codes is None else [float(c) for c in codes.split(",")], None, None, None])
            open_nodes.append((indent, at))
        else:
            rows.append([at, None, None, None, None, None, float(leaf.group(2))])
    return [tuple(r) for r in rows]


def forest_rows(spark: SparkSession, model) -> DataFrame:
    """Node rows of a Spark ML boosted model."""
    rows = [
        (i, float(weight), *node)
        for i, (tree, weight) in enumerate(zip(model.trees, model.treeWeights))
        for node in tree_nodes(tree.toDebugString)
    ]
    return spark.createDataFrame(rows, NODE_SCHEMA)


def _mask(categories: str) -> Column:
    """Text whose character ``i`` is 1 if category ``i`` is listed.

    Looking a category up there is one call, a search of the list is a loop inside the
    generated code of all levels, which is too long to be compiled by the JVM.
    """
    every = F.sequence(F.lit(0), F.array_max(categories).cast("int"))
    return F.concat_ws("", F.transform(every, lambda i: F.array_contains(categories, i.cast("double")).cast("int").cast("string")))


def score_nodes(df: DataFrame, keys: list[str], features: str, nodes: DataFrame, name: str = "margin") -> DataFrame:
    """``keys`` and the weighted sum of all trees, by walking the node rows with joins.

    ``features`` is an array of doubles. One row a tree and input row walks down a level
    a join, so this is for checks and for engines without the model, not for large tables.
    """
    depth = 0
    level = nodes.where("node = 0").select("tree", "left", "right")
    while not (level := level.where("left IS NOT NULL")).isEmpty():
        depth += 1
        child = level.select("tree", F.explode(F.array("left", "right")).alias("node"))
        level = child.join(nodes, ["tree", "node"]).select("tree", "left", "right")
    trees = nodes.agg(F.max("tree").alias("last")).first()["last"]
    state = df.select(*keys, F.col(features).alias("_at"), F.explode(F.sequence(F.lit(0), F.lit(trees))).alias("tree"))
    state = state.withColumn("node", F.lit(0))
    known = F.broadcast(nodes.withColumn("_mask", _mask("categories")).drop("categories"))
    for _ in range(depth):
        met = state.join(known, ["tree", "node"])
        asked = F.get("_at", F.col("feature"))
        code = asked.try_cast("int")  # null for NaN
        listed = (code >= 0) & (code == asked) & (F.substring(F.col("_mask"), code + 1, F.lit(1)) == "1")
        left = F.when(F.col("threshold").isNotNull(), (asked <= F.col("threshold")) & ~F.isnan(asked)).otherwise(listed)
        to = F.when(F.col("left").isNull(), F.col("node")).when(left, F.col("left")).otherwise(F.col("right"))
        state = met.select(*keys, "_at", "tree", to.alias("node"))
    leaves = state.join(known, ["tree", "node"])
    return leaves.groupBy(*keys).agg(F.sum(F.col("value") * F.col("weight")).alias(name))
