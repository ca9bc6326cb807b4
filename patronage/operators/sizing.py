"""Broadcast only what is measured to be small; otherwise let the engine shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# of files or planned rows; in memory it may be several times as much
DEFAULT_LIMIT = 10 * 1024 * 1024


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's own size estimate for the optimized plan (file sizes, no job)."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def broadcast_if_small(df: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """Hint a broadcast when the planned size is under the limit. Beyond it the side is
    returned unhinted: the join is then a shuffle join that adaptive execution can split."""
    return F.broadcast(df) if plan_bytes(df) <= limit else df
