"""Table and file sinks. Row counts per file are balanced by adaptive execution, so one large
partition value does not end up in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.columns import null_text_to_empty


def overwrite(df: DataFrame, path: str, partition: str | None = None, fmt: str = "parquet") -> None:
    """Replace a table, or only the partitions that the rows touch."""
    if partition is None:
        df.hint("rebalance").write.mode("overwrite").format(fmt).save(path)
        return
    (df.hint("rebalance", partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).format(fmt).save(path))


def append(df: DataFrame, path: str, partition: str | None = None, fmt: str = "parquet") -> None:
    writer = df.hint("rebalance").write.mode("append").format(fmt)
    (writer.partitionBy(partition) if partition else writer).save(path)


def write_text(lines: DataFrame, path: str) -> None:
    """One text column, for exception lists."""
    lines.write.mode("overwrite").text(path)


def write_csv_feed(df: DataFrame, folder: str, day: str) -> str:
    """Pipe-separated feed without quotes in a dated folder; nulls are empty."""
    path = f"{folder}/{day}"
    text = null_text_to_empty(df.select([df[c].cast("string").alias(c) for c in df.columns]))
    text.write.mode("overwrite").options(sep="|", header=True, quote="\u0000", escape='"', nullValue="",
                                         emptyValue="").csv(path)
    return path


def write_by_file(df: DataFrame, path: str, file_col: str = "file_name", fmt: str = "orc") -> None:
    """Rewrite rows partitioned by the file they came from."""
    df.hint("rebalance", file_col).write.mode("overwrite").partitionBy(file_col).format(fmt).save(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict, connections: int = 8) -> None:
    """Append an aggregate to a database table over a bounded number of connections."""
    df.coalesce(connections).write.jdbc(url, table, mode="append", properties=properties)


def save_stats(df: DataFrame, name: str, path: str | None = None) -> None:
    """Replace a table of statistics, at a path of its own if one is given."""
    writer = df.write.mode("overwrite")
    (writer.option("path", path) if path else writer).saveAsTable(name)
