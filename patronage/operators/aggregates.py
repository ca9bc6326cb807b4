"""Aggregations beyond the built-in ones; all have a map-side partial step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..codes import UNKNOWN_KEY
from ..functions.text import is_not_empty
from .sequence import place_within
from .skew import join_back


def max_key(df: DataFrame, name: str) -> DataFrame:
    """One row: the largest key, 0 for an empty table."""
    return df.agg(F.coalesce(F.max(name), F.lit(0)).cast("bigint").alias("max_key"))


def max_key_value(df: DataFrame, name: str) -> int:
    return max_key(df, name).first()[0]


def count_distinct_per_key(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Distinct count in two combinable steps, so a hot key is spread over its values."""
    return df.select(*keys, value).distinct().groupBy(*keys).agg(F.count(value).alias(name))


def group_by_as_list(df: DataFrame, keys: list[str], cols: list[str], order: list[str],
                     chunks: int = 16, limit: int = 10_000) -> DataFrame:
    """Rows of a key as array<struct> with the key's full count.

    Every key is dealt over the same number of chunks by a hash of the row's order columns,
    so the shape of the result does not depend on the size of a key, and no row is lost. The
    number is `chunks`, or as many as the table's largest key needs for `limit` rows in a chunk
    on average; rows with equal order columns share a chunk. A chunk without rows has no row.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("grouped_count"))
    most = counts.agg(F.greatest(F.lit(chunks).cast("long"), F.ceil(F.max("grouped_count") / limit)).alias("_chunks"))
    chunk = F.pmod(F.xxhash64(*order), F.col("_chunks")).cast("int")
    return (join_back(df, counts, keys).crossJoin(F.broadcast(most)).withColumn("chunk", chunk)
            .groupBy(*keys, "chunk", "grouped_count")
            .agg(F.array_sort(F.collect_list(F.struct(*order, *[c for c in cols if c not in order])))
                 .alias("grouped_data")))


def lists_by_place(df: DataFrame, keys: list[str], cols: list[str], order: list[str], length: int = 10_000) -> DataFrame:
    """Rows of a key as array<struct> of a fixed length, with the key's full count.

    A row's place in its key, by the order columns and then the others, says which list it is
    in: list 0 holds the first `length` rows, and only a key's last list is shorter. What one
    key holds changes nothing for another, no array grows with the data, and no row is lost.
    """
    cols = [c for c in cols if c not in order]
    placed = place_within(df.select(*keys, *order, *cols), keys, [F.col(c) for c in [*order, *cols]], "_at")
    lists = (placed.groupBy(*keys, F.floor(F.col("_at") / length).alias("list_no"))
             .agg(F.array_sort(F.collect_list(F.struct("_at", *order, *cols))).alias("_rows"), F.count(F.lit(1)).alias("_size")))
    counts = lists.groupBy(*keys).agg(F.sum("_size").alias("grouped_count"))
    row = F.transform("_rows", lambda r: F.struct(*[r[c].alias(c) for c in [*order, *cols]]))
    return join_back(lists, counts, keys).select(*keys, "list_no", "grouped_count", row.alias("grouped_data"))


def first_non_empty(name: str, order: list[Column]) -> Column:
    """Aggregate: the value of the first row, in the order, whose value is not empty."""
    c = F.col(name)
    keep = F.when(c.isNotNull() & (F.length(c.cast("string")) > 0), F.struct(*order, c.alias("v")))
    return F.min(keep)["v"].alias(name)


def earliest_key(key: str, date: str) -> Column:
    """Aggregate: the key with the earliest date, smallest key on ties; no dated key gives -1."""
    dated = F.when(F.col(date).isNotNull(), F.struct(F.col(date).alias("d"), F.col(key).alias("k")))
    return F.coalesce(F.min(dated)["k"], F.lit(UNKNOWN_KEY))


def latest_pair(date: str, time: str, independent: bool = False) -> list[Column]:
    """Aggregates: newest (date, time) of one row, or both maxima on their own."""
    if independent:
        return [F.max(date).alias(date), F.max(time).alias(time)]
    newest = F.max(F.struct(F.col(date).alias("d"), F.col(time).alias("t")))
    return [newest["d"].alias(date), newest["t"].alias(time)]


def any_flag(name: str) -> Column:
    """Aggregate: YES if any, else NO if any, else UNKNOWN."""
    return (F.when(F.max(F.col(name) == "YES"), "YES")
            .when(F.max(F.col(name) == "NO"), "NO").otherwise("UNKNOWN"))


def non_empty_set(name: str) -> Column:
    """Aggregate: sorted distinct non-blank values."""
    return F.array_sort(F.collect_set(F.when(is_not_empty(F.col(name)), F.col(name))))
