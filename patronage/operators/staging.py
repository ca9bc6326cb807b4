"""Cutting lineage between long steps with reliable checkpoints."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from .sizing import plan_bytes


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names; only a local session may fall back to scratch."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="patronage-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.setCheckpointDir(folder)


def stage(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared folder and go on from there. What is read back
    survives the loss of executors, is the same on every read, and later steps read only the
    columns that they need."""
    return _written(df, f"stage-{uuid.uuid4().hex}")


def staging_folder(spark: SparkSession) -> str:
    """The shared folder for staged tables of this application."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/tables-{spark.sparkContext.applicationId}"


# of a stored table: from here on it is read by many tasks as it is
MANY_TASKS = 64 * 1024 * 1024


def stage_table(df: DataFrame, name: str, sources: list[DataFrame] | None = None, balanced: bool = False) -> DataFrame:
    """Write the rows as a parquet table in the shared folder and read it back, so that later
    jobs prune columns and push filters into a plain scan.

    A table out of small files would be scanned by one task ever after, so its rows are dealt
    anew to files of balanced size. That shuffles and sorts every row; `sources`, the tables that
    the rows come from, may say that it is not needed: out of a large one the rows already come
    in many parts of a bounded size, from the splits of its scan or the shuffle of its join. So they
    do where the caller says `balanced`: rows out of a shuffle of their own."""
    balanced = balanced or any(plan_bytes(s) > MANY_TASKS for s in sources or [])
    return _written(df if balanced else df.hint("rebalance"), name)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = f"{staging_folder(df.sparkSession)}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_staging(spark: SparkSession) -> None:
    """Remove the staged tables of this application, at the end of a job."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(staging_folder(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
