"""First loads from landed files, and table comparison."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..codes import UNKNOWN_KEY
from ..functions.dates import as_date
from ..functions.text import is_empty, is_not_empty, normalize_flag
from ..operators.aggregates import max_key
from ..operators.columns import apply_expressions, empty_to_null, rename_columns
from ..operators.joins import left_lookup, update_keys
from ..operators.ranking import largest, latest_per_key, mark_best, newest
from ..operators.sequence import generate_sequence
from ..operators.sets import union_all
from ..operators.sizing import broadcast_if_small
from ..operators.skew import join_back
from ..operators.staging import stage
from .facts import members_by_ip, with_member_by_ip


def default_rows(df: DataFrame, key: str, batch_id: str) -> DataFrame:
    """Rows for the keys -1 and 0, all other columns null."""
    spark = df.sparkSession
    keys = spark.range(-1, 1).select(F.col("id").cast("bigint").alias(key))
    return keys.select(*[F.col(c) if c == key else F.lit(None).cast(t).alias(c) for c, t in df.dtypes])


def hist_dim_load(rows: DataFrame, key: str, group: list[str], order: list[Column], batch_id: str, mode: str = "per_row",
                  renames: dict | None = None, expressions=None, stored: DataFrame | None = None, defaults: bool = True) -> DataFrame:
    """Landed rows as current and history partitions (column status).

    The newest row per group is current, the others history; the history partition also holds
    the current rows. Key modes: per_row numbers history rows from 1 and goes on with the
    current ones; per_key gives all rows of a group one key, after the largest stored key;
    keep takes the file's keys and drops its rows for -1 and 0, which the load adds itself.
    """
    out = apply_expressions(rename_columns(rows, renames or {}), expressions or {})
    out = stage(mark_best(out, group, order, "_current"))
    if mode == "per_row":
        # history rows sort before current ones, so one sequence numbers both
        out = generate_sequence(out.drop(key), key, [F.col("_current")] + [F.col(g) for g in group] + order)
    elif mode == "per_key":
        keys = out.select(*group).distinct()
        start = max_key(stored, key) if stored is not None else 0
        out = join_back(out.drop(key), generate_sequence(keys, key, [F.col(g) for g in group], start), group)
    else:
        out = out.withColumn(key, F.col(key).cast("bigint")).filter(~F.col(key).isin(UNKNOWN_KEY, 0))
    columns = [key] + [c for c in out.columns if c not in (key, "_current")]
    current, everything = out.filter("_current").select(*columns), out.select(*columns)
    parts = []
    for part, name in ((current, "current"), (everything, "history")):
        full = part.unionByName(default_rows(part, key, batch_id)) if defaults else part
        parts.append(full.withColumn("status", F.lit(name)))
    return union_all(parts).withColumn("batch_id", F.lit(batch_id))


@dataclass(frozen=True)
class FirstLoad:
    """Surrogate key, how keys are given, and which row of a group is the current one."""

    key: str
    mode: str
    group: tuple[str, ...]
    order: tuple[str, ...]


# ---- fixed values: keys and groups of the dimensions' first loads ------------------------
FIRST_LOADS = {
    "currency": FirstLoad("currency_key", "keep", ("currency_code",), ("create_date",)),
    "discount_type": FirstLoad("discount_type_key", "keep", ("discount_type_code", "discount_deal_code"), ("create_date",)),
    "product": FirstLoad("product_key", "keep", ("item_nbr",), ("product_key",)),
    "ring_code": FirstLoad("ring_code_id", "per_key", ("campaign_key", "campaign_code", "cell_code", "campaign_segment_key", "ring_code"), ("create_date",)),
    "employee": FirstLoad("employee_key", "keep", ("employee_id",), ("create_date",)),
    "store_master": FirstLoad("store_key", "keep", ("store_id",), ("create_date",)),
    "store_group": FirstLoad("store_group_key", "per_key", ("record_key", "active_store_number"), ("store_key",)),
    "member": FirstLoad("member_id", "per_row", ("member_key",), ("member_key",)),
    "member_multi_phone": FirstLoad("member_multi_phone_key", "per_row", ("member_key", "phone_number"), ("create_date",)),
    "member_multi_email": FirstLoad("member_multi_email_key", "per_row", ("member_key", "email_address"), (
        "consent_date_retail", "consent_date_outlet", "consent_date_next", "first_pos_consent_date")),
    "member_consent": FirstLoad("consent_history_id", "keep", ("member_key", "consent_type"), ("create_date",)),
    "household": FirstLoad("household_id", "per_row", ("household_key",), ("create_date",)),
    "cs_agent": FirstLoad("cs_agent_key", "per_key", ("cs_agent_id",), ("createdate",)),
    "kill_list": FirstLoad("kill_list_id", "per_key", ("ip_code", "household_key", "first_name", "last_name", "address_line_one", "zipcode"), ("createdate",)),
    "reward_def": FirstLoad("reward_def_key", "per_key", ("reward_def_id",), ("createdate",)),
    "tier": FirstLoad("tier_key", "keep", ("tier_id",), ("updatedate",)),
    "scoring_model": FirstLoad("scoring_model_key", "keep", ("scoring_model_key",), ()),
}


@dataclass(frozen=True)
class ColumnMap:
    """What a landed file needs before its first load: new names, columns that are set to null
    or to -1, free-text flags with their spellings (None: yes, no and unknown), expressions.
    The maps of a warehouse are data of its own; `from_json` reads them by table."""

    renames: dict = field(default_factory=dict)
    nulls: tuple[str, ...] = ()
    unknown: tuple[str, ...] = ()
    flags: dict = field(default_factory=dict)
    expressions: dict = field(default_factory=dict)

    @staticmethod
    def from_json(text: str) -> dict[str, ColumnMap]:
        return {name: ColumnMap(m.get("renames", {}), tuple(m.get("nulls", ())), tuple(m.get("unknown", ())), m.get("flags", {}), m.get("expressions", {}))
                for name, m in json.loads(text).items()}

    def applied(self, rows: DataFrame) -> DataFrame:
        out = rename_columns(rows, self.renames)
        fixed = {c: F.lit(None).cast(out.schema[c].dataType if c in out.columns else "string") for c in self.nulls}
        fixed |= {c: F.lit(UNKNOWN_KEY).cast(out.schema[c].dataType if c in out.columns else "bigint") for c in self.unknown}
        fixed |= {c: normalize_flag(F.col(c), values) for c, values in self.flags.items()}
        return apply_expressions(out.withColumns(fixed) if fixed else out, self.expressions)


def first_load(name: str, rows: DataFrame, batch_id: str, columns: ColumnMap | None = None, stored: DataFrame | None = None, defaults: bool = True) -> DataFrame:
    """First load of a dimension from its landed rows, by its keys and its map of columns. The
    newest row by the order columns is a group's current one; further columns break ties."""
    spec = FIRST_LOADS[name]
    out = (columns or ColumnMap()).applied(rows)
    if spec.key not in out.columns:
        out = out.withColumn(spec.key, F.lit(None).cast("bigint"))
    rest = sorted(set(out.columns) - {spec.key, *spec.group, *spec.order})
    dated = lambda c: out.schema[c].dataType.typeName() in ("date", "timestamp")
    order = [*[newest(c) if dated(c) else largest(c) for c in spec.order], *[F.col(c) for c in rest]]
    return hist_dim_load(out, spec.key, list(spec.group), order, batch_id, spec.mode, stored=stored, defaults=defaults)


# fixed values: date patterns of landed files
FILE_DATE, FILE_STAMP, ISO_DATE = "MM/dd/yyyy HH:mm:ss", "yyyyMMddHHmmss", "yyyy-MM-dd"


def parse_date(c: Column, pattern: str = FILE_DATE) -> Column:
    """Text to date; text that is not a date gives null."""
    return F.try_to_timestamp(F.trim(c), F.lit(pattern)).cast("date")


def with_date_keys(df: DataFrame, columns: list[str], dates: DataFrame, pattern: str = FILE_DATE) -> DataFrame:
    parsed = df.withColumns({c: parse_date(F.col(c), pattern) for c in columns})
    return update_keys(parsed, columns, dates, "sdate", "date_key")


# fixed values: first e-mail consent from the two brand consents; later expressions use earlier ones
CONSENT_SEED = {
    "email_consent": "case when consent_value_retail = 'YES' or consent_value_outlet = 'YES' then 'YES' else 'NO' end",
    "email_consent_date": ("case when consent_value_retail = 'YES' and consent_value_outlet = 'YES' then greatest(consent_date_retail, consent_date_outlet) "
                           "when consent_value_retail = 'YES' then consent_date_retail when consent_value_outlet = 'YES' then consent_date_outlet end"),
    "last_updated_date": "greatest(consent_date_retail, consent_date_outlet, email_consent_date)",
}


def consent_seed(emails: DataFrame) -> DataFrame:
    return apply_expressions(emails, CONSENT_SEED)


# ---------------------------------------------------------------- special dimensions

def phones(numbers: DataFrame, mobiles: DataFrame) -> DataFrame:
    """Phone file and mobile consent file by member and number; a consent status makes it a mobile."""
    usable = lambda d: d.filter(F.col("member_key").isNotNull() & F.col("phone_number").isNotNull())
    both = usable(numbers).withColumnsRenamed({"create_date": "ph_create_date", "loyalty_flag": "ph_loyalty_flag"}).join(
        usable(mobiles).withColumnsRenamed({"create_date": "mb_create_date", "loyalty_flag": "mb_loyalty_flag"}), ["member_key", "phone_number"], "full")
    return both.withColumn("phone_type", F.when(F.col("consent_status").isNull(), "UNKNOWN").otherwise("MOBILE"))


def emails(rows: DataFrame, mail_ids: DataFrame) -> DataFrame:
    """E-mail file with the newest mailing id per member and address."""
    ids = latest_per_key(mail_ids, ["member_key", "email_address"], [newest("ingest_date"), F.col("mme_id")]).select("member_key", "email_address", "mme_id")
    return rows.join(ids, ["member_key", "email_address"], "left")


def dm_consents(rows: DataFrame, member: DataFrame) -> DataFrame:
    return rows.filter("consent_type = 'DM'").join(member.select("member_key", "loyalty_id"), "member_key", "left")


def households(rows: DataFrame, dates: DataFrame, columns: list[str]) -> DataFrame:
    return with_date_keys(rows, columns, dates)


def employees(rows: DataFrame) -> DataFrame:
    return rows.withColumn("employee_id", F.lpad(F.col("employee_id").cast("string"), 11, "0"))


# ---------------------------------------------------------------- facts

def fact_sequence(rows: DataFrame, key: str, order: list[Column], stored: DataFrame, batch_id: str) -> DataFrame:
    return generate_sequence(rows.drop(key), key, order, max_key(stored, key)).withColumn("batch_id", F.lit(batch_id))


def fact_transaction_summary(rows: DataFrame, tender: DataFrame, dates: DataFrame, stores: DataFrame) -> DataFrame:
    last = tender.groupBy("trxn_id").agg(F.max("fact_tender_hist_id").alias("max_tender_id"))
    out = rows.join(broadcast_if_small(stores.select("store_key", "currency_key")), "store_key", "left")
    return with_date_keys(out, ["trxn_date"], dates, ISO_DATE).join(last, "trxn_id", "left")


def fact_transaction_detail(rows: DataFrame, dates: DataFrame) -> DataFrame:
    return with_date_keys(rows, ["trxn_date"], dates, ISO_DATE)


def fact_scoring(rows: DataFrame, segments: DataFrame) -> DataFrame:
    return rows.join(broadcast_if_small(segments.select("scoring_model_segment_key", "segment_rank", "model_id")), "scoring_model_segment_key", "left")


def fact_tender(rows: DataFrame, tiebreak: list[Column]) -> DataFrame:
    return latest_per_key(rows, "fact_tender_hist_id", [newest("trxn_date")] + tiebreak)


def fact_tier(rows: DataFrame, dates: DataFrame, tiers: DataFrame, member: DataFrame) -> DataFrame:
    out = with_date_keys(rows, ["tier_begin_date", "tier_end_date"], dates, FILE_STAMP)
    return with_member_by_ip(left_lookup(out, tiers, "tier_id", ["tier_key"]), member, "ipcode")


def fact_point(rows: DataFrame, cards: DataFrame, dates: DataFrame) -> DataFrame:
    holder = cards.groupBy(F.col("vc_key").alias("vckey")).agg(F.max(F.struct("card_history_id", "member_key", "ip_code")).alias("c"))
    out = rows.join(holder.select("vckey", "c.member_key", "c.ip_code"), "vckey", "left")
    return with_date_keys(out, ["pointawarddate", "transactiondate", "expirationdate"], dates, FILE_STAMP)


def fact_reward(rows: DataFrame, reward_trxn: DataFrame, dates: DataFrame, defs: DataFrame, member: DataFrame) -> DataFrame:
    used = latest_per_key(reward_trxn, "certificate_nbr", [newest("trxn_date"), F.col("trxn_id").desc()]).select("certificate_nbr", "trxn_id")
    out = rows.join(used, "certificate_nbr", "left")
    out = with_date_keys(out, ["dateissued", "expiration", "fulfillmentdate", "redemptiondate"], dates, FILE_STAMP)
    return with_member_by_ip(out.join(broadcast_if_small(defs), "reward_def_id", "left"), member, "memberid")


def fact_by_member(rows: DataFrame, member: DataFrame) -> DataFrame:
    """Coupons, campaigns and service notes: member by ip code."""
    return with_member_by_ip(rows, member, "memberid")


# ---------------------------------------------------------------- export history

def edw_history(audit: DataFrame, gold: DataFrame, key: str, since) -> DataFrame:
    """Old audit rows and newer stored rows, the latest per key and day. Audit rows keep their
    own flag (I is A, else C); of the stored rows a key's first is A, the others C."""
    known = lambda d: d.filter("record_type <> 'PROSPECT' or record_type is null")
    old = latest_per_key(known(audit), [key, "ingest_date"], [F.col("status")]).withColumn("cc_flag", F.when(F.col("status") == "I", "A").otherwise("C"))
    fresh = known(gold).withColumn("ingest_date", F.col("last_updated_date").cast("date")).filter(F.col("ingest_date") > as_date(since))
    new = latest_per_key(fresh, [key, "ingest_date"], [F.col("last_updated_date").desc(), F.col("record_type")]).withColumn("cc_flag", F.lit(None).cast("string"))
    rows = union_all([d.select(key, "record_type", "ingest_date", "cc_flag") for d in (old, new)])
    marked = mark_best(rows, [key], [F.col("ingest_date"), F.coalesce("cc_flag", F.lit("~"))], "_first")
    return marked.withColumn("cc_flag", F.coalesce("cc_flag", F.when(F.col("_first"), "A").otherwise("C"))).drop("_first")


# ---------------------------------------------------------------- comparison

FAN, LEVELS = 4096, 2  # ranges of keys that one range is divided into, and how often


def _digested(df: DataFrame, keys: list[str], values: list[str], like: DataFrame) -> DataFrame:
    """Rows with a known key, the ranges of the hash of their key, and two hashes of all they are compared by."""
    text = lambda c: F.coalesce(F.lower(F.col(c).cast("string")), F.lit("\u0001"))
    spread = F.xxhash64(*[F.col(k).cast(like.schema[k].dataType).cast("string") for k in keys])
    known = df.dropna(subset=keys).withColumn("_h", spread)
    ranges = {f"_r{i}": F.pmod(F.shiftrightunsigned("_h", 12 * i), F.lit(FAN)) for i in range(LEVELS)}
    row = [F.col("_h"), *[text(c) for c in values]]
    return known.withColumns(ranges | {"_x": F.xxhash64(*row), "_y": F.pmod(F.xxhash64(F.lit(7), *row), F.lit(1 << 40))}).drop("_h")


def open_ranges(a: DataFrame, b: DataFrame) -> DataFrame:
    """Ranges of keys in which two digested tables differ. Each level sums up signed digests of
    both, which is one combining aggregate, and only ranges that differ are divided further."""
    marks = ["_x", "_y", *[f"_r{i}" for i in range(LEVELS)]]
    both = a.select(*marks, F.lit(1).alias("_s")).unionByName(b.select(*marks, F.lit(-1).alias("_s")))
    for depth in range(1, LEVELS + 1):
        cols = [f"_r{i}" for i in range(depth)]
        sums = both.groupBy(*cols).agg(F.sum("_s").alias("n"), F.bit_xor("_x").alias("x"), F.sum(F.col("_s") * F.col("_y")).alias("y"))
        differ = broadcast_if_small(stage(sums.filter("n <> 0 or x <> 0 or y <> 0").select(*cols)))
        both = both.join(differ, cols, "left_semi")
    return differ


def compare_tables(old: DataFrame, new: DataFrame, keys: list[str], skip: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(counts, differing rows with old:new texts, differing rows per column) of two tables.

    Keys are unique in each table; a row with a null key matches nothing. Tables mostly agree,
    so they are first compared by digests of key ranges, which moves a few numbers for each
    range. Only rows of ranges that differ are joined.
    """
    new = new.filter("status = 'current'") if "status" in new.columns else new
    values = [c for c in old.columns if c in new.columns and c not in keys and c not in skip and c not in ("status", "ingest_date")]
    a, b = (_digested(empty_to_null(d.select(*keys, *values)), keys, values, new) for d in (old, new))
    differ = open_ranges(a, b)
    cols = [f"_r{i}" for i in range(LEVELS)]
    rest = ["_x", "_y", *cols]
    part = lambda d, side: d.join(differ, cols, "left_semi").drop(*rest).withColumnsRenamed({c: f"{side}_{c}" for c in values})
    left = part(a, "o")
    joined = left.join(part(b, "n"), keys)
    low = lambda c: F.lower(F.col(c).cast("string"))
    differs = {c: ~low(f"o_{c}").eqNullSafe(low(f"n_{c}")) for c in values}
    any_diff = F.lit(False)
    for d in differs.values():
        any_diff = any_diff | d
    text = lambda c: F.when(differs[c], F.concat_ws(":", F.col(f"o_{c}").cast("string"), F.col(f"n_{c}").cast("string")))
    rows = joined.filter(any_diff).select(*keys, *[text(c).alias(c) for c in values])
    columns = joined.agg(*[F.count_if(differs[c]).alias(c) for c in values])
    # where ranges agree, every old key is matched
    side = lambda d, name: d.select(F.lit(name).alias("side"))
    counted = union_all([side(old, "old"), side(new, "new"), side(a, "known"), side(left, "open"),
                         joined.select(F.when(any_diff, "different").otherwise("same").alias("side"))]).groupBy("side").agg(F.count(F.lit(1)).alias("n"))
    pick = lambda *names: F.coalesce(F.sum(F.when(F.col("side").isin(*names), F.col("n"))), F.lit(0))
    counts = counted.agg(pick("old").alias("old_count"), pick("new").alias("new_count"),
                         (pick("known", "same", "different") - pick("open")).alias("matched_keys"), pick("different").alias("different_rows"))
    return counts, rows, columns
