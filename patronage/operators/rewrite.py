"""Tables stored in parts by a hash of their key, of which only touched parts are rewritten."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .staging import stage

PART = "key_part"


def part_of(key: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(parts)).cast("int")


def store_by_key(df: DataFrame, key: str, path: str, parts: int = 512) -> None:
    """Write a table in folders by a hash of a whole-number key; null is a key of its own."""
    rows = df.withColumn(PART, part_of(key, parts))
    rows.hint("rebalance", PART).write.mode("overwrite").partitionBy(PART).parquet(path)


def read_by_key(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The stored table; a schema is needed only where it may have no rows."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path).drop(PART)


def rewrite_keys(spark: SparkSession, path: str, key: str, touched: DataFrame, change: Callable[[DataFrame], DataFrame], parts: int = 512) -> list[int]:
    """Change the rows of some keys of a stored table and write only the parts that hold them.

    `touched` has one column, all keys whose rows change and all keys that rows get; `change`
    maps all rows of the touched parts to their new rows and must leave rows of other keys in
    their part as they are. The other files stay what they are. Returns the numbers of
    the rewritten parts.
    New rows are written aside first, as the old ones are read until then; of a part that is left
    without rows the folder is deleted.
    """
    touched = touched.select(F.col(touched.columns[0]).cast("long").alias(key))
    # numbers of parts, at most `parts` of them: folders are pruned by them
    open_parts = sorted(r[0] for r in touched.select(part_of(key, parts).alias(PART)).distinct().collect())
    if not open_parts:
        return open_parts
    fresh = stage(change(spark.read.parquet(path).filter(F.col(PART).isin(open_parts)).drop(PART)).withColumn(PART, part_of(key, parts)))
    fresh.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)
    full = {r[0] for r in fresh.select(PART).distinct().collect()}
    for part in set(open_parts) - full:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{PART}={part}")
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    return open_parts
