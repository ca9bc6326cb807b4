"""Table and file sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.columns import align_to_schema, as_schema, empty_to_null


def scan_table(source: DataFrame, columns: list[str] | None = None, where: str | None = None) -> DataFrame:
    """Filter and projection; both reach the file scan."""
    out = source.where(where) if where else source
    return out.select(*columns) if columns else out


def read_pipe_csv(spark: SparkSession, path: str, null_value: str = "NULL", columns: list[str] | None = None) -> DataFrame:
    """Pipe-delimited text with a header; every column is text, blank becomes null. With the
    column names given, no file has to be opened to plan the scan."""
    reader = spark.read.options(sep="|", header=True, inferSchema=False, nullValue=null_value, enforceSchema=False)
    if columns:
        reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return empty_to_null(reader.csv(path))


def read_headerless_csv(spark: SparkSession, path: str, header: str, null_value: str = "NULL") -> DataFrame:
    """Pipe-delimited text whose header is given as one pipe-separated string."""
    schema = T.StructType([T.StructField(c.strip(), T.StringType()) for c in header.split("|")])
    return empty_to_null(spark.read.options(sep="|", header=False, nullValue=null_value).schema(schema).csv(path))


def read_ddl_csv(spark: SparkSession, path: str, file_columns: list[str], ddl: str, date_format="yyyy/MM/dd",
                 null_value="NULL") -> DataFrame:
    """Comma-separated text typed by a table's DDL: the file holds some of its columns, the
    others come out null."""
    target = as_schema(ddl)
    types = {f.name: f.dataType for f in target}
    schema = T.StructType([T.StructField(c, types[c]) for c in file_columns])
    raw = spark.read.options(header=True, dateFormat=date_format, nullValue=null_value).schema(schema).csv(path)
    return align_to_schema(raw, target)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict, split_on: str | None = None,
              lower: int = 0, upper: int = 0, parts: int = 1) -> DataFrame:
    """A database table; with a numeric split column the read is spread over tasks."""
    if split_on is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(url, table, column=split_on, lowerBound=lower, upperBound=upper, numPartitions=parts,
                           properties=properties)


def with_file_name(df: DataFrame, name: str = "file_name") -> DataFrame:
    """Tag each row with the file it was read from."""
    return df.withColumn(name, F.input_file_name())


def files_holding(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Files that hold at least one of the keys."""
    return with_file_name(df).join(keys.select(on), on, "left_semi").select("file_name").distinct()


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of delimited files as they are, without the header line of each file."""
    # a separator and quote that no line holds leave one column, named by the header
    lines = spark.read.options(header=True, sep="\u0001", quote="", emptyValue="").csv(path)
    return lines.toDF("value")
