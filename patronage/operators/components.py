"""Connected groups of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .skew import join_back
from .staging import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b): root is the smallest node that it reaches.

    Each round hooks a root onto the smallest root next to it and then halves the way of every
    node to its root (its label's label). Labels only fall, and the rounds grow with the
    logarithm of the longest chain. Edges whose ends have one label leave the work. Only pairs
    of keys move; minima are combined before their shuffle, and joins to a node with very many
    edges can be split. Rounds end in written tables. Null ends and loops are left out.
    """
    edges = stage(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct())
    labels = stage(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("root", F.col("node")))
    while True:
        label = lambda end: labels.select(F.col("node").alias(end), F.col("root").alias(f"r{end}"))
        met = join_back(join_back(edges, label("a"), ["a"]), label("b"), ["b"])
        edges = stage(met.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).filter("a <> b").distinct())
        hooks = stage(edges.groupBy(F.col("b").alias("root")).agg(F.min("a").alias("_to")))
        if hooks.isEmpty():
            return labels
        # roots that were hooked point further up until each way ends
        ways = _ends(hooks)
        labels = stage(join_back(labels, ways, ["root"], "left").select("node", F.coalesce("_to", "root").alias("root")))


def _ends(hooks: DataFrame) -> DataFrame:
    """(root, _to) with _to followed to its end; every step goes to a smaller key."""
    while True:
        further = hooks.select(F.col("root").alias("_to"), F.col("_to").alias("_next"))
        longer = stage(join_back(hooks, further, ["_to"], "left"))
        hooks = longer.select("root", F.coalesce("_next", "_to").alias("_to"))
        if longer.filter("_next is not null").isEmpty():
            return hooks
