"""Joining per-key results back to rows when a key may hold a large share of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def join_back(df: DataFrame, per_key: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join rows to a frame with one row per key (nulls equal).

    The frame usually comes out of an aggregate on the same keys and is then already
    partitioned by them, and a join that reuses that partitioning has no exchange of its own
    for adaptive execution to split. A hash of the keys as a further join column makes the
    join shuffle both sides, so a hot key of the large side is split over many tasks. The
    extra shuffle carries only one row per key.
    """
    right = per_key.withColumnsRenamed({k: f"_k_{k}" for k in keys}).withColumn(
        "_kh", F.xxhash64(*[f"_k_{k}" for k in keys]))
    left = df.withColumn("_h", F.xxhash64(*keys))
    cond = F.col("_h") == F.col("_kh")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return left.join(right, cond, how).drop("_h", "_kh", *[f"_k_{k}" for k in keys])


def left_join_known(df: DataFrame, per_key: DataFrame, keys: list[str], known: Column, spread: list[str]) -> DataFrame:
    """Left join of rows to a frame with at most one row per key, where many rows may have no key
    to look up (null, or a code for unknown; `known` says which have one).

    Such rows can match nothing and need not meet: a hash of their `spread` columns deals them
    over all tasks, whatever their share. Rows with a key shuffle on it, and as the frame
    shuffles on the same columns anew, a hot key can still be split.
    """
    left = df.withColumn("_deal", F.when(known, F.lit(0)).otherwise(F.xxhash64(*spread).bitwiseOR(F.lit(1))).cast("long"))
    return left.join(per_key.withColumn("_deal", F.lit(0).cast("long")), [*keys, "_deal"], "left").drop("_deal")
