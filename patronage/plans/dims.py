"""Work tables to dimension sources: renames, fixed texts and lookups."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..codes import DATE_MODEL_END
from ..functions.dates import as_date
from ..functions.text import decode, is_empty
from ..operators.aggregates import max_key
from ..operators.columns import apply_expressions, rename_columns
from ..operators.joins import left_lookup, update_keys
from ..operators.ranking import latest_per_key
from ..operators.sequence import generate_sequence
from ..operators.sets import union_all
from ..operators.sizing import broadcast_if_small
from .scd import scd2_process_load


@dataclass(frozen=True)
class Mapping:
    """How a work table becomes a dimension source or a fact: renames, then SQL expressions in
    order, then dropped columns."""

    key: str
    natural: tuple[str, ...] = ()
    renames: dict = field(default_factory=dict)
    derived: dict = field(default_factory=dict)
    drops: tuple[str, ...] = ()


def blank_or_null_text(c: str) -> str:
    return f"case when {c} in ('', 'null') then null else {c} end"


NULL_TEXT = "cast(null as string)"
NULL_DATE = "cast(null as date)"

# ---- fixed values: column mappings --------------------------------------------
DIMENSIONS = {
    "cs_agent": Mapping("cs_agent_key", ("cs_agent_id",), {
        "id": "cs_agent_id", "agentnumber": "cs_agent_nbr", "groupid": "cs_agent_group_id",
        "firstname": "cs_agent_first_name", "lastname": "cs_agent_last_name", "emailaddress": "cs_agent_email_addr",
        "phonenumber": "cs_agent_phone_nbr", "extension": "cs_agent_extension", "username": "cs_agent_username",
        "status": "cs_agent_status_cd", "roleid": "cs_agent_role_id"}),
    "currency": Mapping("currency_key", ("currency_code",), {
        "quote": "currency_code", "effective_date": "currency_date", "bid": "usd_rate"}),
    "employee": Mapping("employee_key", ("employee_id",), {
        "location": "location_cd", "division_code": "division_cd", "discount_percentage": "discount_pct",
        "full_part_time_indicator": "full_part_time_ind", "home_store_number": "home_store_key"},
        {"employee_status": "case when employee_status = '' then null else employee_status end",
         "full_part_time_ind": "case when full_part_time_ind = '' then null else full_part_time_ind end"}),
    "experian": Mapping("experian_key", ("member_key",)),
    "household": Mapping("household_id", ("household_key",), drops=("household_id", "last_updated_date", "action_flag")),
    "kill_list": Mapping("kill_list_key", ("member_id", "household_key", "first_name", "last_name", "address_line_one", "zipcode"),
                         {"ip_code": "member_id", "zip_code": "zipcode"}),
    "member": Mapping("member_sk", ("member_key",)),
    "member_consent": Mapping("member_consent_key", ("member_key", "consent_type")),
    "member_multi_email": Mapping("member_multi_email_key", ("member_key", "email_address")),
    "member_multi_phone": Mapping("member_multi_phone_key", ("member_key", "phone_number")),
    "point_event": Mapping("point_event_key", ("point_event_id",),
                           {"name": "point_event_name", "description": "point_event_descr"}),
    "point_type": Mapping("point_type_key", ("point_type_id",), {
        "name": "point_type", "description": "point_type_descr", "money_backed": "money_backed_points"},
        {"point_txn_type_id": "1", "point_basis": NULL_TEXT, "point_group": NULL_TEXT, "txn_type_descr": NULL_TEXT}),
    "reward_def": Mapping("reward_def_key", ("reward_def_id",), {
        "id": "reward_def_id", "name": "reward_name", "how_many_points_to_earn": "points_required_to_earn",
        "thresh_hold": "threshhold", "active": "active_flag"},
        {"reward_long_description": NULL_TEXT, "reward_short_description": NULL_TEXT, "expiration_period": NULL_TEXT,
         "expiration_period_unit": NULL_TEXT,
         "is_appeasement": "case when upper(trim(certificate_type_code)) = 'APPEASEMENT' then 'YES' else 'NO' end"}),
    "ring_code": Mapping("ring_code_id", ("campaign_key", "campaign_code", "cell_code", "campaign_segment_key", "ring_code"), {
        "campaign_key": "campaign_key_source", "ring_code_channel": "channel",
        "campaign_reporting_group": "campaign_reporting_grp", "rcl_campaign_name": "campaign_name"},
        {"campaign_key": blank_or_null_text("campaign_key_source"), "campaign_code": "rcl_cell_name",
         "campaign_segment_key": "-1", "cell_code": blank_or_null_text("cell_code"),
         "ring_code": blank_or_null_text("ring_code"), "elf_segment": NULL_TEXT, "circulation": NULL_TEXT}),
    "store_group": Mapping("store_group_key", ("record_key", "active_store_number"), {"selection_name": "group_selection_name"},
                           {"record_key": "try_cast(nullif(trim(record_key), '') as int)"}),
    "tier": Mapping("tier_key", ("tier_id",), {
        "description": "tier_descr", "entry_points": "min_points_for_tier", "exit_points": "max_points_for_tier"},
        {"tier_source": "'LW'", "point_event_names": NULL_TEXT, "tier_point_type_name": NULL_TEXT,
         "expire_date_expr": NULL_TEXT, "activity_period_start_expr": NULL_TEXT, "activity_period_end_expr": NULL_TEXT},
        ("last_dml_id", "etl_unique_id")),
}


def apply_mapping(df: DataFrame, m: Mapping) -> DataFrame:
    out = rename_columns(df, m.renames)
    out = apply_expressions(out, m.derived)
    return out.drop(*m.drops)


def dimension_source(name: str, work: DataFrame) -> DataFrame:
    """Work table to the columns of a dimension, for the rename-only dimensions."""
    return apply_mapping(work, DIMENSIONS[name])


def currency(work: DataFrame) -> DataFrame:
    return dimension_source("currency", work.filter("base = 'USD'"))


def reward_def(work: DataFrame, tiers: DataFrame) -> DataFrame:
    mapped = dimension_source("reward_def", work)
    return left_lookup(mapped.drop("tier_key"), tiers.filter("status = 'current'").select("tier_id", "tier_key"), "tier_id", ["tier_key"])


def store_group(work: DataFrame, stores: DataFrame) -> DataFrame:
    keys = stores.select(F.col("store_id").alias("active_store_number"), "store_key")
    return left_lookup(dimension_source("store_group", work), keys, "active_store_number", ["store_key"])


# ---- fixed values: discount texts ----------------------------------------------
DISCOUNT_TYPES = {0: "Group Coupon", 1: "Line Coupon", 2: "Group Damage", 3: "Line Damage", 4: "Group Promo",
                  5: "Line Promo", 6: "Associate"}
DISCOUNT_DEALS = {
    "Group Coupon": ["00", "40"], "Item Discount % Off": ["11", "61"], "Item Discount $ Off": ["12", "62"],
    "Group Discount % Off": ["63", "03"], "Group Discount $ Off": ["04", "14", "64"],
    "Free Item (Always % off)": ["65", "15"], "Promo Discount % Off": ["66", "06"], "Promo Discount $ Off": ["07", "67"],
    "Associate Discount % Off": ["610"], "Deal Pricing Qty Break": ["013", "613"], "Deal Pricing % Off": ["614", "014"],
    "Line Coupon": ["41", "51"], "Group Damage": ["42", "52"], "Line Promo": ["45"], "Default": ["10", "60"],
    "UNKNOWN": ["19", "114", "413", "441"]}


def discount_type(work: DataFrame, data_source: str = "T-log") -> DataFrame:
    """Discount codes of the till lines, one row per (type, deal); unlisted deals have no text."""
    two = lambda c: F.when(F.col(c) <= 9, F.concat(F.lit("0"), F.col(c).cast("string"))).otherwise(F.col(c).cast("string"))
    deal = F.concat(F.col("discount_type").cast("string"), F.col("discount_deal").cast("string"))
    texts = {code: name for name, codes in DISCOUNT_DEALS.items() for code in codes}
    out = work.select("discount_type", "discount_deal").distinct()
    return out.select(two("discount_type").alias("discount_type_code"), two("discount_deal").alias("discount_deal_code"),
                      decode(F.col("discount_type"), DISCOUNT_TYPES, "Unknown").alias("discount_type_description"),
                      decode(deal, texts).alias("discount_deal_description"),
                      F.lit(None).cast("date").alias("effective_date"), F.lit(None).cast("date").alias("expiration_date"),
                      F.lit(data_source).alias("data_source"))


# ---------------------------------------------------------------- product and store

PRODUCT_STUB = {"department_cd": "-1", "class_cd": -1, "division_cd": -1, "division_name": "UNKNOWN", "color_cd": -1,
                "color_name": "UNKNOWN", "size_cd": -1, "size_name": "UNKNOWN", "style_cd": -1, "department_descr": "UNKNOWN"}


def product(item, classes, styles, colors, sizes, hierarchy, attributes) -> DataFrame:
    """Seven-table join. Gender is the first letter of the item's gender attribute, else the
    department's status code. The six small tables are dimensions of the item table."""
    small = broadcast_if_small
    out = (item.join(small(classes.withColumnRenamed("class_code", "class_cd")), F.col("class_code_1") == F.col("class_cd"), "left")
           .join(small(styles.select(F.col("class").alias("_c"), F.col("style").alias("_s"), F.col("vendor").alias("vendor_cd"))),
                 (F.col("class_code_1") == F.col("_c")) & (F.col("style") == F.col("_s")), "left")
           .join(small(colors.withColumnRenamed("color_code", "color_cd")), F.col("color") == F.col("color_cd"), "left")
           .join(small(sizes.select("size", "size_name")), "size", "left")
           .join(small(hierarchy), F.col("class_code_1") == F.col("class_number"), "left")
           .join(small(attributes.filter("uda_id = 1").select(F.col("item_number").alias("_i"), "uda_value_desc")),
                 F.col("item_number") == F.col("_i"), "left"))
    gender = F.when(is_empty(F.col("uda_value_desc")), F.trim("department_stat_code")).otherwise(F.substring("uda_value_desc", 1, 1))
    return out.select(
        F.nullif(F.trim("item_number"), F.lit("")).try_cast("bigint").alias("item_nbr"),
        F.nullif("price_group", F.lit("")).alias("price_group_code"), "item_description",
        F.col("department").alias("department_cd"), "class_cd", "class_name", F.col("division").try_cast("bigint").alias("division_cd"),
        "division_name", F.col("department_name").alias("department_descr"), "color_cd", "color_name",
        F.col("size").alias("size_cd"), "size_name", F.col("style").alias("style_cd"), "vendor_cd",
        F.col("ticket_price").cast("decimal(10,2)").alias("ticket_price"), gender.alias("gender"))


# ---- fixed values: store code texts ---------------------------------------------
STORE_PROFILE = {0: "No Profile Defined", 1: "Single Entrance", 2: "Multiple Entrances", 3: "EXPBBW SXS", 4: "EXPSTR SXS",
                 5: "EXP/STR/BBW SXS", 6: "EXP/LTD SXS", 7: "EXP/LTD/STR SXS", 8: "STR/BBW SXS"}
STORE_DESIGN = {0: "Undefined", 1: "White EXP", 2: "White EXP", 3: "Black & White", 4: "Slatwall", 5: "French", 6: "Old",
                7: "Old Italian", 8: "New Italian", 9: "Industrial", 10: "Brown Leather", 11: "Gen XY", 12: "Gen X",
                13: "Gen Y", 14: "Haywood", 15: "Outlet"}
STORE_TYPE = {"D": "dual gender", "W": "womens", "M": "mens"}
STORE_STATUS = {"AHD": "Ahead", "BHD": "Behind", "CMP": "Complete", "HLD": "On Hold", "LGL": "Legal Hold", "OPN": "Open",
                "PLP": "Pending LL Pkg", "SCH": "On Schedule", "SPC": "Special", "TBD": "To Be Determined"}
STORE_VOLUME = {"A": "$3.00 - $4.99 | 3,000,000", "A+": "$5.00 and higher | 5,000,000", "B": "'$1.80 - $2.99 | 1,800,000",
                "C": "$0.00 - $1.80 | 0", "U": "Undefined | 0"}
STORE_STUB = {"retail_web_flag": "UNKNOWN", "store_name": "UNKNOWN", "profile_code": 0,
              "profile_description": "NO PROFILE DEFINED", "rtl_flag": "Y", "store_design_code": 0,
              "store_design_description": "UNDEFINED", "sales_volume_class_code": "U", "sales_volume_class": "UNDEFINED",
              "district_name": "UNKNOWN", "region_name": "UNKNOWN", "zone_name": "UNKNOWN", "district_code": "0",
              "region_code": "0", "zone_code": "0"}


def store_master(master: DataFrame, hierarchy: DataFrame, owner: DataFrame, on) -> DataFrame:
    day = as_date(on)
    out = (master.join(hierarchy, F.col("shop_number") == F.col("site_code"), "left")
           .join(owner, F.col("shop_number") == F.col("shop_nbr"), "left"))
    is_open = ((F.col("act_open_date") < day) & (F.col("last_close_date").isNull() | (F.col("last_close_date") > day))
               & (F.col("sell_sq_ft") > 1))
    return out.select(
        F.nullif(F.trim(F.col("shop_number").cast("string")), F.lit("")).alias("store_id"),
        F.when(F.col("district_number") == 97, "WEB").otherwise("RETAIL").alias("retail_web_flag"),
        F.when(is_open, "OPEN").otherwise("CLOSED").alias("open_closed_ind"), F.col("shop_name").alias("store_name"),
        F.col("shop_profile_code").alias("profile_code"),
        decode(F.col("shop_profile_code"), STORE_PROFILE, "UNKNOWN").alias("profile_description"), "rtl_flag",
        F.col("shop_dsgn_cd").alias("store_design_code"),
        decode(F.col("shop_dsgn_cd"), STORE_DESIGN, "UNKNOWN").alias("store_design_description"),
        F.col("shop_type_cd").alias("store_type_code"),
        decode(F.col("shop_type_cd"), STORE_TYPE, "UNKNOWN").alias("store_type_description"),
        decode(F.col("shop_stat_cd"), STORE_STATUS, "UNKNOWN").alias("store_status_code"), F.col("shop_stat_cd").alias("store_status"),
        F.col("vol_class_cd").alias("sales_volume_class_code"),
        decode(F.col("vol_class_cd"), STORE_VOLUME, "UNKNOWN").alias("sales_volume_class"),
        F.col("act_open_date").alias("actual_open_date"), F.col("last_close_date").alias("last_closed_date"),
        F.col("sell_sq_ft").alias("selling_sq_ft"), "district_name", "region_name", "zone_name", "district_code",
        "region_code", "zone_code", "latitude", "longitude")


# ---------------------------------------------------------------- scoring model

MODEL_MEMBER, MODEL_HOUSEHOLD = 104, 108  # fixed values: model ids


def first_fiscal_wednesday(dates: DataFrame, on) -> DataFrame:
    """One row: the first Wednesday whose fiscal month began in the month of the date, and the
    day before that fiscal month."""
    month = F.date_format(as_date(on), "yyyy-MM")
    return (dates.filter((F.dayofweek("sdate") == 4) & (F.date_format("fiscal_month_begin_date", "yyyy-MM") == month))
            .agg(F.min("sdate").alias("scoring_day"),
                 F.date_sub(F.min("fiscal_month_begin_date"), 1).alias("data_through_date")))


def scoring_model(models: DataFrame, scored: dict[int, int], scoring_day, data_through) -> tuple[DataFrame, DataFrame]:
    """(current, history) partitions after a monthly run: version + 1 with keys max + 1 and
    max + 2, the previous version closed the day before."""
    ids = [MODEL_MEMBER, MODEL_HOUSEHOLD]
    day = as_date(scoring_day)
    in_use = F.col("model_id").isin(ids) & (F.upper(F.trim("current_model_ind")) == "YES")
    last = max_key(models.filter("status = 'current'"), "scoring_model_key")  # one row
    fresh = (models.filter((F.col("status") == "current") & in_use).crossJoin(F.broadcast(last))
             .withColumns({"model_version_id": F.col("model_version_id") + 1,
                           "scoring_model_key": F.col("max_key") + F.when(F.col("model_id") == MODEL_MEMBER, 1).otherwise(2),
                           "scored_record_count": decode(F.col("model_id"), scored).cast("bigint"), "effective_date": day,
                           "expiration_date": as_date(DATE_MODEL_END), "data_through_date": as_date(data_through)})
             .select(*models.columns))
    current = models.filter((F.col("status") == "current") & ~F.col("model_id").isin(ids)).unionByName(fresh)
    old = models.filter(F.col("status") == "history")
    closed = old.filter(in_use).withColumns({"current_model_ind": F.lit("NO"), "expiration_date": F.date_sub(day, 1)})
    history = union_all([closed, old.filter(~F.coalesce(in_use, F.lit(False))).distinct(), fresh.withColumn("status", F.lit("history"))])
    return current, history


# ---------------------------------------------------------------- member tables

# ---- fixed values: natural key, surrogate key and columns taken over on insert only ----
MEMBER_TABLES = {
    "multi_email": (["member_key", "email_address"], "member_multi_email_key", ["original_source_key", "original_store_key"]),
    "multi_phone": (["member_key", "phone_number"], "member_multi_phone_key", ["original_source_key"]),
    "consent": (["member_key", "consent_type"], "consent_history_id", ["original_source_key"]),
}


def member_table_load(name: str, work: DataFrame, dimension: DataFrame, process: str, batch_id: str, date) -> tuple[DataFrame, DataFrame]:
    """(current, history) of a table of members' addresses, phones or consents after the rows of
    one process of the work layer. Rows that are already numbered or marked there are so anew."""
    natural, surrogate, derived = MEMBER_TABLES[name]
    rows = work.drop(surrogate, "last_updated_date", "action_flag", "action_cd")
    return scd2_process_load(rows, dimension, process, natural, surrogate, batch_id, date, derived)


# ---------------------------------------------------------------- first loads

HOUSEHOLD_DATES = ["first_trxn_date", "add_date", "introduction_date", "last_store_purch_date", "last_web_purch_date",
                   "account_open_date"]


def household_history(rows: DataFrame, dates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(current, history): six date keys, a sequence over all rows, latest ingest is current."""
    keyed = update_keys(rows, HOUSEHOLD_DATES, dates, "sdate", "date_key")
    numbered = generate_sequence(keyed, "household_id", [F.col("household_key"), F.col("ingest_date")])
    newest = F.max("ingest_date").alias("_newest")
    top = numbered.groupBy("household_key").agg(newest)
    current = (numbered.join(top, "household_key").filter(F.col("ingest_date") == F.col("_newest")).drop("_newest"))
    return current, numbered


def member_history(rows: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Numbered rows that are both the current and the history partition of a first load."""
    numbered = generate_sequence(rows, key, order)
    return union_all([numbered.withColumn("status", F.lit(s)) for s in ("current", "history")])
