"""From raw documents to shards of a training mix: five stages over whole tables.

Every stage takes nulls in any column, repeated rows, empty texts and an empty table; all but the
last return the columns of documents as they are, further ones included. What each makes of odd
rows stands with it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from patronage.llm import decontaminate, mixing, ngram_join, sharding, toxicity
from patronage.llm.staging import staged

SHARDS = 16


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar, learned from the labelled ones, does not call toxic: score
    under 0.5. Null, empty and blank texts have no clause and stay, as all do if none is
    labelled toxic. A row is judged by its text alone, so equal texts share one fate and ids
    may be null or repeated."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels, F.lit(True)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id. Sets of five
    words, similarity 0.8. Documents without words (null, empty or blank text) stay, and so do
    rows with a null id; rows with one id are one document and stay or go together."""
    return ngram_join.without_near_copies(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts hold none; a row with a null
    id is judged by its text; rows of one id go together. Null items are left out, and an empty
    benchmark removes nothing."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: 0 to 3 times. A null source is a
    source, after all others; a source whose texts have no words is taken as it weighs in words,
    not at all. Rows with one id throw one coin, rows with a null id one by their text."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and their slot in it. Null ids share one key, hence one shard;
    repeated rows have slots of their own. Columns named as the new ones are replaced."""
    return sharding.sharded(docs, [1.0] * SHARDS)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix),
    ("sharding", shard),
]

# The grammar's weights are learned and the groups of near copies are a closure: no SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents of a folder, each from the written rows of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
