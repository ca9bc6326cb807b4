"""Mixing sources to target weights, in DataFrame functions only.

The words of all sources are shared out by weight; no source may be repeated more than a
given number of times, and what a source cannot take goes to the others by weight. Every
document is then taken floor(rate) times, and once more with the remaining fraction as its
chance, by a hash of its id, so that reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.sizing import broadcast_if_small
from ..operators.skew import join_back
from .staging import staged

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)   # by place of the source in code point order, repeating
MOST_REPEATS = 3
COIN_DIGITS = 13      # hex digits of the hash that make the coin


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def coin(key: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the key and the seed alone."""
    digits = F.substring(F.md5(F.concat(F.lit(seed + ":"), key)), 1, COIN_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16 ** COIN_DIGITS))


def source_targets(sizes: DataFrame, weights=WEIGHTS, most=MOST_REPEATS) -> DataFrame:
    """(source, source_size, target, rate) from rows (source, size).

    Targets fill up like water: with sources ordered by cap over weight, the level is the
    share per weight that is left once all sources with lower caps are full. One row per
    source goes through a window; documents are summed before. Null sorts last and is a
    source; a source without words has target and rate 0.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(in_order) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int")))
    per = staged(per.withColumn("cap", most * F.col("source_size").cast("double")), "sources")
    full = per.withColumn("ratio", F.col("cap") / F.col("weight"))
    before = Window.orderBy("ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    whole = per.agg(F.sum("source_size").cast("double").alias("all_size"), F.sum("weight").alias("all_weight"))
    level = (full.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
             .withColumn("weight_before", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
             .join(F.broadcast(whole))  # one row
             .withColumn("level", (F.col("all_size") - F.col("cap_before")) / (F.col("all_weight") - F.col("weight_before")))
             .filter("level <= ratio").agg(F.min_by("level", "ratio").alias("level")))
    target = F.least(F.col("cap"), F.col("level") * F.col("weight"))
    return (per.join(F.broadcast(level))  # one row
            .select("source", F.col("source_size").cast("long").alias("source_size"), target.alias("target"))
            .withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)))


def with_copies(docs: DataFrame, weights=WEIGHTS, most=MOST_REPEATS, seed: str = "mix", id_col: str = "doc_id",
                text_col: str = "text", source_col: str = "source") -> DataFrame:
    """docs with _size, _source_size, _target, _copies.

    A null or blank text has size 0. A null id throws its coin by the text. Rows with the same
    id throw the same coin. No row is copied more than `most` times; an empty table stays
    empty. Columns of docs are kept as they are.
    """
    sizes = docs.select(F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"))
    rates = staged(source_targets(sizes, weights, most), "rates").withColumnsRenamed(
        {"source": "_source", "source_size": "_source_size", "target": "_target", "rate": "_rate"})
    small = broadcast_if_small(rates)
    if small is rates:  # many sources: a join that splits a source with very many documents
        out = join_back(docs.withColumn("_source", F.col(source_col)), rates, ["_source"])
    else:
        out = docs.join(small, F.col(source_col).eqNullSafe(F.col("_source")))
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text "), F.md5(text_col)), F.lit(""))
    rate = F.col("_rate")
    copies = F.floor(rate) + (coin(key, seed) < rate - F.floor(rate)).cast("long")
    return out.withColumn("_size", word_count(F.col(text_col))).withColumn("_copies", copies).drop("_source", "_rate")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs, each as often as the mix takes it."""
    chosen = with_copies(docs, **options)
    again = F.explode(F.array_repeat(F.lit(1), F.col("_copies").cast("int")))
    return chosen.withColumn("_again", again).select(*docs.columns)
