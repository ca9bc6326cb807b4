"""Dense surrogate keys and places within a key, without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .skew import join_back
from .staging import stage

PLACE_BITS = 33  # of monotonically_increasing_id, below the number of the partition


def _placed(df: DataFrame) -> DataFrame:
    """The rows as they lie, written with their partition and their place in it, so that both stay."""
    return stage(df.withColumn("_place", F.monotonically_increasing_id())).withColumn("_part", F.shiftright("_place", PLACE_BITS))


def _dense(placed: DataFrame, key: str, start) -> DataFrame:
    """Number written rows partition after partition from the sizes of those before. Only one
    row for each partition goes through the offset window."""
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_from"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = start if isinstance(start, DataFrame) else placed.sparkSession.range(1).select(F.lit(start).alias("max_key"))
    offsets = sizes.select("_part", "_from", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")).crossJoin(
        F.broadcast(first.select(F.col("max_key").alias("_start"))))  # one row
    number = F.col("_start") + F.col("_before") + F.col("_place") - F.col("_from") + 1
    # one row per partition: its size is bounded by the partition count
    return (placed.join(F.broadcast(offsets), "_part")
            .withColumn(key, number.cast("bigint")).drop("_part", "_place", "_from", "_before", "_start"))


def generate_sequence(df: DataFrame, key: str, order: list[Column], start=0) -> DataFrame:
    """Append start+1, start+2, … in the given order. Rows are range-partitioned, sorted and
    written before they are numbered. `start` is a number or a one-row frame with a column max_key.
    """
    return _dense(_placed(df.repartitionByRange(*order).sortWithinPartitions(*order)), key, start)


def number_rows(df: DataFrame, key: str, start=0) -> DataFrame:
    """Append start+1, start+2, … in no promised order: rows are written where they lie and
    numbered there, so none is moved or sorted. The keys are dense and, once given, stay."""
    return _dense(_placed(df), key, start)


def place_within(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """Append each row's place from 0 within its key, in the given order.

    Two levels of counts: rows of a range partition are placed by where they lie in it, and a
    key that runs over several partitions adds its rows in those before. No task holds a whole
    key; the window sees one row for each partition of a key. Null is a key like any other.
    """
    sort = [*[F.col(k) for k in keys], *order]
    placed = _placed(df.repartitionByRange(*sort).sortWithinPartitions(*sort))
    sizes = placed.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_from"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*keys, "_part", "_from", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_place") - F.col("_from")
    return join_back(placed, offsets, [*keys, "_part"]).withColumn(name, place).drop("_part", "_place", "_from", "_before")


def sort_key(names: list[str]) -> list[Column]:
    """Stable order for new keys: missing values sort as NA."""
    return [F.coalesce(F.col(n).cast("string"), F.lit("NA")) for n in names]
