"""Projection helpers: every function is DataFrame -> DataFrame and adds no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..codes import UNKNOWN_KEY
from ..functions.text import blank_to_null


def get_columns(df: DataFrame, alias: str | None = None, exclude=()) -> list[Column]:
    names = [c for c in df.columns if c not in set(exclude)]
    return [F.col(f"{alias}.{c}" if alias else c) for c in names]


def drop_columns(df: DataFrame, names) -> DataFrame:
    return df.drop(*names)


def rename_columns(df: DataFrame, mapping: dict[str, str], reverse: bool = False) -> DataFrame:
    if reverse:
        mapping = {v: k for k, v in mapping.items()}
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def apply_expressions(df: DataFrame, expressions) -> DataFrame:
    """Set columns from SQL texts in order; a later text may use an earlier column."""
    items = expressions.items() if isinstance(expressions, dict) else expressions
    for name, text in items:
        df = df.withColumn(name, F.expr(text))
    return df


def cast_columns(df: DataFrame, names=None, to: str = "string", of_type: str | None = None) -> DataFrame:
    """Cast the named columns, or every column of one type, to another type."""
    if of_type is not None:
        names = [n for n, t in df.dtypes if t == of_type]
    return df.withColumns({n: F.col(n).cast(to) for n in names})


def unstruct(df: DataFrame, name: str) -> DataFrame:
    """Expand a struct column to top-level columns, replacing columns of the same name."""
    fields = df.schema[name].dataType.fieldNames()
    keep = [c for c in df.columns if c != name and c not in fields]
    return df.select(*keep, *[F.col(f"{name}.{f}").alias(f) for f in fields])


def as_schema(schema) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    return T.StructType.fromDDL(schema)


def align_to_schema(df: DataFrame, schema, defaults: dict | None = None) -> DataFrame:
    """Exactly the target's columns, in its order and types; missing ones null or defaulted."""
    defaults = defaults or {}
    have = set(df.columns)
    cols = []
    for field in as_schema(schema):
        src = F.col(field.name) if field.name in have else F.lit(defaults.get(field.name))
        cols.append(src.cast(field.dataType).alias(field.name))
    return df.select(*cols)


def key_defaults(schema, value: int = UNKNOWN_KEY) -> dict:
    """Default by name: *_key columns get the unknown key, every other column null."""
    return {f.name: value for f in as_schema(schema) if f.name.endswith("_key")}


def default_fill_columns(df: DataFrame, schema, zero: bool = False) -> DataFrame:
    """Fill the columns a source lacks with 0 (measures) or by name (keys to -1, else null)."""
    schema = as_schema(schema)
    defaults = {f.name: 0 for f in schema} if zero else key_defaults(schema)
    return align_to_schema(df, schema, defaults)


def string_columns(df: DataFrame) -> list[str]:
    return [n for n, t in df.dtypes if t == "string"]


def empty_to_null(df: DataFrame, names=None) -> DataFrame:
    return df.withColumns({n: blank_to_null(F.col(n)) for n in names or string_columns(df)})


def null_text_to_empty(df: DataFrame, names=None) -> DataFrame:
    """On export: null and the literal text null become empty."""
    names = names or string_columns(df)
    return df.withColumns({n: F.when(F.col(n).isNull() | (F.lower(F.col(n)) == "null"), "")
                           .otherwise(F.col(n)) for n in names})


def strip_delimiter(df: DataFrame, names, delimiter: str = "|") -> DataFrame:
    return df.withColumns({n: F.replace(F.col(n), F.lit(delimiter), F.lit("")) for n in names})


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in df.columns})


def unprefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: c[len(prefix):] for c in df.columns if c.startswith(prefix)})
