"""Lookup and merge joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..codes import UNKNOWN_KEY
from .sizing import broadcast_if_small


def left_lookup(df: DataFrame, dim: DataFrame, on, keys: list[str], fill=UNKNOWN_KEY) -> DataFrame:
    """Left join to a dimension; missing keys get the fill. If the dimension has several rows
    for the same values, the one with the smallest keys counts, so no row is multiplied."""
    on = [on] if isinstance(on, str) else on
    one = dim.groupBy(*on).agg(F.min(F.struct(*keys)).alias("_k")).select(*on, "_k.*")
    out = df.join(broadcast_if_small(one), on, "left")
    return out.fillna(fill, keys)


def update_keys(df: DataFrame, names, dim: DataFrame, join_col: str, value_col: str) -> DataFrame:
    """For each named column add <name>_key (or the given key name) from one dimension."""
    names = names if isinstance(names, dict) else {n: f"{n}_key" for n in names}
    small = broadcast_if_small(dim.groupBy(join_col).agg(F.min(value_col).alias(value_col)))
    for src, dst in names.items():
        side = small.select(F.col(join_col).alias(f"_j_{src}"), F.col(value_col).alias(dst))
        df = (df.join(side, F.col(src) == F.col(f"_j_{src}"), "left")
              .drop(f"_j_{src}").fillna(UNKNOWN_KEY, [dst]))
    return df


def full_outer_merge(left: DataFrame, right: DataFrame, keys: list[str], prefer: str = "left") -> DataFrame:
    """Full join of two snapshots; shared columns are taken from the preferred side first.
    `side` tells where a row was found: left, right or both."""
    shared = [c for c in left.columns if c in right.columns and c not in keys]
    l = left.withColumnsRenamed({c: f"_l_{c}" for c in left.columns if c not in keys}).withColumn("_in_l", F.lit(1))
    r = right.withColumnsRenamed({c: f"_r_{c}" for c in right.columns if c not in keys}).withColumn("_in_r", F.lit(1))
    side = (F.when(F.col("_in_r").isNull(), "left").when(F.col("_in_l").isNull(), "right")
            .otherwise("both").alias("side"))
    first, second = ("_l_", "_r_") if prefer == "left" else ("_r_", "_l_")
    cols = [F.coalesce(F.col(first + c), F.col(second + c)).alias(c) for c in shared]
    cols += [F.col(f"_l_{c}").alias(c) for c in left.columns if c not in shared and c not in keys]
    cols += [F.col(f"_r_{c}").alias(c) for c in right.columns if c not in shared and c not in keys]
    return l.join(r, keys, "full").select(*keys, *cols, side)


def anti(df: DataFrame, other: DataFrame, on) -> DataFrame:
    return df.join(other, on, "left_anti")


def semi(df: DataFrame, other: DataFrame, on) -> DataFrame:
    return df.join(other, on, "left_semi")


def explode_key_list(df: DataFrame, name: str, key: str, sep: str = ",") -> DataFrame:
    """One row per key of a separated list."""
    return (df.withColumn(key, F.explode(F.split(F.col(name), sep)))
            .withColumn(key, F.trim(key).try_cast("bigint")))


def constant_domain(df: DataFrame, constants: DataFrame, columns: dict, type_col="constant_type",
                    value_col="constant_value", id_col="constant_id", fill=None) -> DataFrame:
    """Replace codes by ids, column by column, from a constants table (case and blanks
    ignored). Each column names its constant type, or a list of types."""
    for name, domain in columns.items():
        types = [domain] if isinstance(domain, str) else list(domain)
        side = (constants.filter(F.upper(F.trim(type_col)).isin(types))
                .groupBy(F.lower(F.trim(value_col)).alias("_code")).agg(F.min(id_col).alias("_id")))
        found = F.col("_id") if fill is None else F.coalesce("_id", F.lit(fill))
        df = (df.join(broadcast_if_small(side), F.lower(F.trim(F.col(name))) == F.col("_code"), "left")
              .withColumn(name, found).drop("_code", "_id"))
    return df


def resolve_parent(df: DataFrame, id_col: str, parent_col: str, key_col: str, order: list[Column],
                   out: str, history: DataFrame | None = None) -> DataFrame:
    """Key of the parent row (newest row per id) from the same fact and its stored history."""
    from .ranking import latest_per_key
    known = df if history is None else df.unionByName(history)
    parents = (latest_per_key(known.filter(F.col(id_col).isNotNull()), id_col, order)
               .select(F.col(id_col).alias("_pid"), F.col(key_col).alias(out)))
    return (df.join(parents, F.col(parent_col) == F.col("_pid"), "left")
            .drop("_pid").fillna(UNKNOWN_KEY, [out]))
