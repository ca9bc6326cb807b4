"""Slowly changing dimensions: change detection and the two-partition load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..codes import STATUS_CURRENT, STATUS_HISTORY
from ..functions.dates import as_date, file_date
from ..operators.aggregates import max_key
from ..operators.filters import current_only, newest_batch
from ..operators.ranking import latest_per_key
from ..operators.sequence import generate_sequence
from ..operators.sets import union_all
from ..operators.sizing import plan_bytes

META = ["last_updated_date", "status", "batch_id", "action_cd"]


def _key_columns(df: DataFrame, keys: list[str], kinds: dict | None = None) -> dict[str, Column]:
    """Columns without nulls that are equal where the natural keys are: text without case and
    outer blanks, other types as they are, each of these with a flag for null. They are columns
    and not expressions of a join, so that a stored dimension can be bucketed by them. Keys
    whose type is not that in `kinds` are compared as text."""
    out = {}
    for i, k in enumerate(keys):
        kind = df.schema[k].dataType
        if isinstance(kind, T.StringType) or (kinds and kinds[k] != kind):
            out[f"_k{i}"] = F.coalesce(F.lower(F.trim(F.col(k).cast("string"))), F.lit("\u0002"))
            continue
        empty = F.lit(0 if isinstance(kind, T.NumericType) else False if isinstance(kind, T.BooleanType) else "1970-01-01").cast(kind)
        out |= {f"_k{i}": F.coalesce(F.col(k), empty), f"_n{i}": F.col(k).isNull()}
    return out


def _keyed(df: DataFrame, keys: list[str], other: DataFrame | None = None) -> DataFrame:
    """The rows with their key columns; those of a stored dimension are kept."""
    kinds = {k: other.schema[k].dataType for k in keys} if other is not None else None
    made = _key_columns(df, keys, kinds)
    same = set(made) <= set(df.columns) and set(df.columns) & KEY_COLUMNS == set(made)
    return df if same else df.drop(*KEY_COLUMNS).withColumns(made)


# names of the key columns of up to eight natural keys
KEY_COLUMNS = {f"_{x}{i}" for x in "kn" for i in range(8)}


def store_dimension(df: DataFrame, natural_keys: list[str], table: str, path: str, buckets: int | None = None) -> DataFrame:
    """Write a dimension bucketed and sorted by its natural key, and read it back. A load then
    joins it where it lies: only the source is shuffled. There are at least as many buckets as
    shuffle partitions, else the join would rather move the dimension."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cols = sorted(_key_columns(df, natural_keys))
    size = plan_bytes(df)
    wanted = -(-size // BUCKET_BYTES) if size < 1 << 60 else 0  # beyond, the size is not known
    buckets = buckets or max(least, min(wanted, MOST_BUCKETS))
    rows = df.drop(*KEY_COLUMNS).withColumns(_key_columns(df, natural_keys)).repartition(buckets, *cols)
    rows.write.mode("overwrite").option("path", path).bucketBy(buckets, *cols).sortBy(*cols).saveAsTable(table)
    return df.sparkSession.table(table)


BUCKET_BYTES, MOST_BUCKETS = 256 << 20, 100_000


def _latest(df: DataFrame, natural_keys: list[str], tiebreak: list[str] | None, target: DataFrame | None = None) -> DataFrame:
    order = [file_date(F.col("etl_unique_id")).desc()] if "etl_unique_id" in df.columns else []
    order += [F.col(c) for c in (tiebreak or sorted(set(df.columns) - set(natural_keys)))]
    keyed = _keyed(df, natural_keys, target)
    return latest_per_key(keyed, [F.col(c) for c in sorted(set(keyed.columns) & KEY_COLUMNS)], order)


def dedup_source(df: DataFrame, natural_keys: list[str], tiebreak: list[str] | None = None) -> DataFrame:
    """One row per natural key (case and outer blanks ignored), newest load file first."""
    return _latest(df, natural_keys, tiebreak).drop(*KEY_COLUMNS)


def change_set(source: DataFrame, target: DataFrame, natural_keys: list[str], surrogate: str, derived=(),
               incremental: bool = True) -> DataFrame:
    """Full join of a deduplicated source with the current rows; action_cd I, U or NCD.

    Columns are compared null-safe and without case. A row that only the target has stays
    (NCD) in an incremental load and disappears in a full one. Derived columns come from the
    source on insert and from the target otherwise.
    """
    return _changes(source, target, natural_keys, surrogate, derived, "full" if incremental else "left")


def _changes(source: DataFrame, target: DataFrame, natural_keys: list[str], surrogate: str, derived, how: str) -> DataFrame:
    """The change set of one kind of join; of an anti join, the source rows that are inserts."""
    names = [c for c in target.columns if c not in META and c != surrogate and c not in derived and c not in KEY_COLUMNS]
    values = [c for c in names if c not in natural_keys]
    s = _keyed(source, natural_keys, target).withColumn("_in_s", F.lit(True))
    t = _keyed(target, natural_keys, source).withColumn("_in_t", F.lit(True))
    same = F.lit(True)
    for c in sorted(set(s.columns) & KEY_COLUMNS):
        same = same & (F.col(f"s.{c}") == F.col(f"t.{c}"))
    joined = s.alias("s").join(t.alias("t"), same, how)
    if how == "left_anti":
        missing = lambda c: F.lit(None).cast(target.schema[c].dataType).alias(c)
        return joined.select(missing(surrogate), *names, *[F.col(c) if c in source.columns else missing(c) for c in derived],
                             missing("last_updated_date"), F.lit("I").alias("action_cd"))
    text = lambda side, c: F.lower(F.col(f"{side}.{c}").cast("string"))
    changed = F.lit(False)
    for c in values:
        changed = changed | ~text("s", c).eqNullSafe(text("t", c))
    action = (F.when(F.col("t._in_t").isNull(), "I").when(F.col("s._in_s").isNull(), "NCD")
              .when(changed, "U").otherwise("NCD"))
    joined = joined.withColumn("action_cd", action)
    fresh = F.col("action_cd") != "NCD"
    cols = [F.when(fresh, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in names]
    for c in derived:
        own = F.col(f"s.{c}") if c in source.columns else F.lit(None).cast(target.schema[c].dataType)
        cols.append(F.when(F.col("action_cd") == "I", own).otherwise(F.col(f"t.{c}")).alias(c))
    return joined.select(F.col(f"t.{surrogate}").alias(surrogate), *cols,
                         F.col("t.last_updated_date").alias("last_updated_date"), "action_cd")


def scd2_load(source: DataFrame, dimension: DataFrame, natural_keys: list[str], surrogate: str, batch_id: str, date,
              derived=(), incremental: bool = True, new_key_on_update: bool = False) -> tuple[DataFrame, DataFrame]:
    """(current partition, history partition) after the batch.

    Inserts, and updates when asked, are numbered after the largest current surrogate key in
    the order of the natural key. Only these rows are written in between; the others come
    straight out of the join, which moves no row of a dimension that `store_dimension` has written.
    """
    target = newest_batch(dimension)
    rows = _latest(source, natural_keys, None, target)
    changes = lambda how: _changes(rows, target, natural_keys, surrogate, derived, how)
    kept = changes("right" if incremental else "inner")
    updated = F.col("action_cd") == "U"
    if new_key_on_update:
        fresh, kept = changes("left").filter(F.col("action_cd").isin("I", "U")), kept.filter(~updated)
    else:
        fresh = changes("left_anti")
    order = [F.lower(F.trim(F.col(k).cast("string"))) if t == "string" else F.col(k)
             for k, t in fresh.dtypes if k in natural_keys]
    order += [F.col(k) for k in natural_keys]
    numbered = generate_sequence(fresh.drop(surrogate), surrogate, order, max_key(current_only(dimension), surrogate)).select(*fresh.columns)
    stamped = lambda d, status: d.withColumns({
        "last_updated_date": F.when(F.col("action_cd") == "NCD", F.col("last_updated_date")).otherwise(as_date(date)),
        "batch_id": F.lit(batch_id), "status": F.lit(status)})
    return (stamped(union_all([numbered, kept]), STATUS_CURRENT), stamped(union_all([numbered, kept.filter(updated)]), STATUS_HISTORY))


def scd2_process_load(work: DataFrame, dimension: DataFrame, process: str, natural_keys: list[str], surrogate: str,
                      batch_id: str, date, derived=(), new_key_on_update: bool = True) -> tuple[DataFrame, DataFrame]:
    """Load the rows of one process; the dedup and household processes replace the whole
    dimension, all others only add to it."""
    mine = work.filter(F.col("process") == process).drop("process")
    full = process.strip() in ("dedup", "dim_household")
    current, history = scd2_load(mine, dimension, natural_keys, surrogate, batch_id, date, derived,
                                 incremental=not full, new_key_on_update=new_key_on_update)
    return tuple(p.withColumn("process", F.lit(process.strip())) for p in (current, history))


def stub_members(lines: list[DataFrame], id_col: str, known: list[DataFrame], target: DataFrame, key: str,
                 defaults: dict) -> DataFrame:
    """Default dimension rows for ids that transactions use but neither the new files nor the
    stored dimension hold."""
    seen = union_all([d.select(F.col(id_col).alias(key)) for d in lines]).distinct()
    have = union_all([d.select(key) for d in known])
    stubs = seen.join(have, key, "left_anti")
    return stubs.select(*[F.col(key) if c == key else F.lit(defaults.get(c)).cast(t).alias(c) for c, t in target.dtypes])
