"""Unions, duplicates and differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import null_safe_hash
from .ranking import latest_per_key


def union_all(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def except_distinct(df: DataFrame, other: DataFrame) -> DataFrame:
    return df.subtract(other)


def dedup_rowhash(df: DataFrame, names: list[str], order: list[Column]) -> tuple[DataFrame, DataFrame]:
    """(first row per row hash, the further copies of it)."""
    hashed = df.withColumn("row_hash", null_safe_hash([F.col(n) for n in names]))
    firsts = latest_per_key(hashed, "row_hash", order)
    # the copies are found by a join on the kept row, so a hash with very many copies is
    # split by adaptive execution instead of being ranked in one task
    marks = firsts.select(F.col("row_hash").alias("_h"), F.struct(*order).alias("_first"))
    copies = (hashed.withColumn("_me", F.struct(*order)).join(marks, F.col("row_hash") == F.col("_h"))
              .filter(~F.col("_me").eqNullSafe(F.col("_first"))).drop("_h", "_first", "_me"))
    return firsts, copies
