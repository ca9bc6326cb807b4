"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.skew import join_back
from .staging import staged


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node that the node reaches over edges (a, b).

    Each round links every node to the smallest of its neighbours, first from the side of the
    larger nodes, then from that of the smaller ones; components shrink to stars in about
    log(longest chain) rounds. Only pairs of numbers move, minima are combined before each
    shuffle, joins with a node that has very many neighbours can be split, and every round
    ends in a written table. Nodes without an edge (or with edges to themselves only) have no
    row. Nulls are no nodes; repeated edges change nothing.
    """
    now = staged(edges.select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u"))
                 .filter("u <> v").distinct(), "edges")
    seen = _mark(now)
    while True:
        both = now.unionByName(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        # large star: neighbours above the node move to its smallest neighbour
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = (join_back(both, least, ["u"]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        # small star: neighbours below the node, and the node, move to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (join_back(large, low, ["u"]).select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        now = staged(small, "stars")
        mark = _mark(now)
        if mark == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark


def _mark(pairs: DataFrame) -> tuple:
    """One row that tells two pair tables apart."""
    h = F.xxhash64("u", "v")
    return tuple(pairs.agg(F.count("u"), F.bit_xor(h), F.sum(F.hash("u", "v").cast("long"))).first())
