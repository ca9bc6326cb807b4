"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..codes import STATUS_CURRENT, UNKNOWN_KEY
from ..functions.dates import as_date


def split_by(df: DataFrame, cond: Column, keep_null: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows that meet the condition, the others). A null condition counts as not met,
    unless keep_null is off: then such rows are in neither side."""
    if keep_null:
        return df.filter(cond), df.filter(~F.coalesce(cond, F.lit(False)))
    return df.filter(cond), df.filter(~cond)


def current_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("status") == STATUS_CURRENT)


def newest_batch(df: DataFrame) -> DataFrame:
    """Current rows of the newest batch; the batch id is found by a one-row aggregate
    that is joined back, so no driver round trip is needed."""
    current = current_only(df)
    newest = current.agg(F.max("batch_id").alias("batch_id"))
    return current.join(F.broadcast(newest), "batch_id", "left_semi")


def exclude_skew_keys(df: DataFrame, name: str, keys) -> DataFrame:
    """Drop rows of known garbage keys that the caller names."""
    return df.filter(~F.col(name).isin(list(keys) + [UNKNOWN_KEY]))


def after_business_date(df: DataFrame, date, name: str = "last_updated_date") -> DataFrame:
    return df.filter(F.col(name).cast("date") > as_date(date))


def df_is_empty(df: DataFrame) -> bool:
    return df.isEmpty()
