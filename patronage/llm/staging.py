"""Written tables between steps, in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..operators.staging import staging_folder


def new_path(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder; no two calls give the same one."""
    return f"{staging_folder(spark)}/{tag}-{uuid.uuid4().hex}"


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write the rows as Parquet and go on from the files: lineage ends here, lost executors
    cost nothing that is already written, and later readers prune columns."""
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
