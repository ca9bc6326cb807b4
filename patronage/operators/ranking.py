"""Per-key picks. None of them gathers a whole key in one task:

* a filter rank = 1 on row_number is planned as a partial limit before the shuffle
  (WindowGroupLimit), so each map task sends one row per key;
* picks that keep ties and counts per key are a partial aggregate joined back, and the
  join on a hot key is one that adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .skew import join_back


def _cols(keys):
    return [F.col(k) if isinstance(k, str) else k for k in ([keys] if isinstance(keys, str) else keys)]


def latest_per_key(df: DataFrame, keys, order: list[Column], n: int = 1, rank_col: str | None = None) -> DataFrame:
    """First n rows per key in the given total order."""
    name = rank_col or "_rn"
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    out = df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def keep_best_ties(df: DataFrame, keys: list[str], best: Column) -> DataFrame:
    """All rows that share the smallest value of `best` in their key (rank() = 1)."""
    tagged = df.withColumn("_best", best)
    top = tagged.groupBy(*keys).agg(F.min("_best").alias("_top"))
    return (join_back(tagged, top, keys)
            .filter(F.col("_best").eqNullSafe(F.col("_top"))).select(*df.columns))


def with_key_aggregates(df: DataFrame, keys: list[str], **aggs: Column) -> DataFrame:
    """Add per-key aggregates (count, min, max …) to every row."""
    grouped = df.groupBy(*keys).agg(*[v.alias(k) for k, v in aggs.items()])
    return join_back(df, grouped, keys).select(*df.columns, *aggs.keys())


def mark_best(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """Flag the first row per key in a total order, keeping all rows (row_number() = 1 as a
    column): the smallest order struct per key is joined back and compared."""
    tagged = df.withColumn("_o", F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]))
    top = tagged.groupBy(*keys).agg(F.min("_o").alias("_top"))
    return join_back(tagged, top, keys).withColumn(name, F.col("_o").eqNullSafe(F.col("_top"))).drop("_o", "_top")


def newest(c: str) -> Column:
    """Order part for a date: later first, missing last."""
    return F.coalesce(-F.unix_date(F.col(c).cast("date")), F.lit(2147483647))


def yes_first(c: str) -> Column:
    """Order part for a flag: YES before anything else."""
    return F.when(F.col(c) == "YES", 0).otherwise(1)


def largest(c: str) -> Column:
    """Order part for a number: larger first, missing last."""
    return F.coalesce(-F.col(c).cast("decimal(20,4)"), F.lit(10 ** 15).cast("decimal(20,4)"))
