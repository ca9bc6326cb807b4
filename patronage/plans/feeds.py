"""Feed jobs: recipes over the matching operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import file_date
from ..functions.text import is_empty, is_not_empty
from ..operators.joins import left_lookup
from ..operators.ranking import latest_per_key
from ..operators.sets import union_all
from ..operators.sizing import broadcast_if_small
from ..operators.skew import left_join_known
from ..operators.staging import stage
from . import matching as mt

# ---- fixed values: order of the criteria per feed ----------------------------
TILL_ORDER = ["loyalty_id", "phone_email_loyalty", "plcc_name_loyalty", "plcc_loyalty", "plcc_name", "employee_id",
              "bank_card_name", "bank_card", "name_address", "phone_email_name", "phone_email", "email_name", "email",
              "phone_name", "phone"]
CARD_ORDER = ["phone_email_loyalty", "plcc_name_loyalty", "plcc_loyalty", "plcc_name", "name_address",
              "phone_email_name", "phone_email", "email_name", "email", "phone_name", "phone"]
EMPLOYEE_ORDER = ["phone_email_loyalty", "employee_id", "name_address", "phone_email_name", "phone_email",
                  "email_name", "email", "phone_name", "phone"]
EMAIL_UPDATE_ORDER = ["email"]
MOBILE_ORDER = ["name_address", "phone_without_name"]
RENTAL_ORDER = ["name_address"]

# ---- fixed values: source key per feed ------------------------------------------
FEED_SOURCES = {"employee": 144, "card_statement": 8, "card_account": 9, "loyalty": 300, "email_update": 2225,
                "mobile": 2226, "rental_anthem": 2199, "rental_jcrew": 264, "rental_venus": 2112}
EXPERIAN_MALE, EXPERIAN_FEMALE = 1561, 1560


def complete(matched: DataFrame, member: DataFrame, record_info: DataFrame, card_type: DataFrame | None, source: Column) -> DataFrame:
    """Steps that every feed shares after matching: new keys for the unmatched rows, record
    info key, source key."""
    staged = stage(matched)
    fresh = mt.new_member_keys(staged.filter(~F.col("match_status")), member)
    rows = union_all([staged.filter("match_status"), fresh.select(*staged.columns)])
    return mt.record_info_key(rows, record_info, card_type).withColumn("source_key", source)


def till(feed: DataFrame, lk: mt.Lookups, stores: DataFrame, record_info: DataFrame, card_type: DataFrame) -> DataFrame:
    """Rows with a loyalty id are matched by it alone: a miss goes straight to a new key. All
    other rows run through the remaining criteria. Source key by store and match type."""
    matched = mt.match_waterfall(feed, lk, TILL_ORDER, gate=is_empty(F.col("implied_loyalty_id")))
    matched = matched.join(broadcast_if_small(stores.select("store_key", "retail_web_flag")), "store_key", "left")
    out = complete(matched, lk.member, record_info, card_type, mt.till_source_key(F.col("retail_web_flag"), F.col("match_key")))
    loyalty = lk.member.select("member_key", F.col("loyalty_id").alias("member_loyalty"))
    # rows with a new key or none have no stored member, and need not meet one
    return left_join_known(out, loyalty, ["member_key"], F.col("match_status"), ["etl_unique_id"])


def card_account(feed: DataFrame, lk: mt.Lookups, record_info: DataFrame, card_type: DataFrame) -> DataFrame:
    """Newest row per card, then the card criteria."""
    newest = latest_per_key(feed.filter(is_not_empty(F.col("tender_number"))), "tender_number",
                            [file_date(F.col("etl_unique_id")).desc(), F.col("etl_unique_id")])
    return complete(mt.match_waterfall(newest, lk, CARD_ORDER), lk.member, record_info, card_type, F.lit(FEED_SOURCES["card_account"]))


def merge_statement(primary: DataFrame, authorised: DataFrame, key: str = "tender_number") -> DataFrame:
    """Statement rows with one row per home and mobile phone, and authorised users without a
    statement row of their card in the same columns."""
    each = primary.withColumn("phone", F.explode(F.array("home_phone", "mobile_phone")))
    users = authorised.join(primary.select(key).distinct(), key, "left_anti")
    return each.unionByName(users, allowMissingColumns=True).distinct()


def card_statement(primary: DataFrame, authorised: DataFrame, lk: mt.Lookups, record_info: DataFrame, card_type: DataFrame) -> DataFrame:
    """Each phone of a row is matched on its own; the row keeps its largest member key."""
    rows = merge_statement(primary, authorised).withColumn("_row", F.concat_ws("|", "etl_unique_id", "phone"))
    matched = mt.match_waterfall(rows, lk, CARD_ORDER, row_id="_row")
    best = latest_per_key(matched, "etl_unique_id", [F.col("member_key").desc(), F.col("_row")]).drop("_row")
    return complete(best, lk.member, record_info, card_type, F.lit(FEED_SOURCES["card_statement"]))


def simple(feed: DataFrame, lk: mt.Lookups, record_info: DataFrame, card_type: DataFrame | None, order: list[str], source: Column) -> DataFrame:
    return complete(mt.match_waterfall(feed, lk, order), lk.member, record_info, card_type, source)


def email_update(feed: DataFrame, lk: mt.Lookups, record_info: DataFrame) -> DataFrame:
    """Rows that carry a member key skip matching (match key 0)."""
    known, rest = mt.split_known_keys(feed)
    source = F.lit(FEED_SOURCES["email_update"])
    done = complete(mt.match_waterfall(rest, lk, EMAIL_UPDATE_ORDER), lk.member, record_info, None, source)
    carried = mt.record_info_key(known, record_info).withColumn("source_key", source)
    return done.unionByName(carried.select(*done.columns))


def rental(feed: DataFrame, lk: mt.Lookups, record_info: DataFrame, source: Column, only_new: bool = False) -> DataFrame:
    """Rented lists; one of them keeps only the rows that became new members."""
    out = simple(feed, lk, record_info, None, RENTAL_ORDER, source)
    return out.filter(~F.col("match_status")) if only_new else out


def loyalty_router(feed: DataFrame, lk: mt.Lookups, own_key: str = "loyalty_member_key") -> DataFrame:
    """Loyalty feed: what becomes of each row (column route).

    matched: found by loyalty id, or, without one, by ip code, and the row's own member key (if
    any) agrees · new: a loyalty id that nobody has and no own key · rejected: everything else.
    """
    has_id = is_not_empty(F.col("implied_loyalty_id"))
    by_id = mt.match_waterfall(feed.filter(has_id), lk, ["loyalty_id"])
    by_ip = mt.match_waterfall(feed.filter(~has_id), lk, ["ip_code"])
    rows = union_all([by_id.withColumn("_id", F.lit(True)), by_ip.withColumn("_id", F.lit(False))])
    own = F.col(own_key)
    conflict = own.isNotNull() & (own != F.col("member_key"))
    route = (F.when(F.col("match_status") & ~conflict, "matched")
             .when(F.col("_id") & ~F.col("match_status") & own.isNull(), "new").otherwise("rejected"))
    return rows.withColumn("route", route).drop("_id")


def loyalty(feed: DataFrame, lk: mt.Lookups, stores: DataFrame, record_info: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(loaded rows with store key, rejected rows). Members who left the programme (status 5)
    are not loaded; of several rows per own key and ip code the newest enrolment counts."""
    one = latest_per_key(feed.filter(F.coalesce(F.col("memberstatus") != 5, F.lit(True))), ["loyalty_member_key", "ip_code", "implied_loyalty_id"],
                         [F.col("enroll_date").desc_nulls_last(), F.col("etl_unique_id")])
    routed = stage(loyalty_router(one, lk))
    loaded = complete(routed.filter("route <> 'rejected'"), lk.member, record_info, None, F.lit(FEED_SOURCES["loyalty"]))
    keys = stores.select(F.col("store_id").alias("enroll_store"), F.col("store_key").alias("enroll_store_key"))
    return left_lookup(loaded, keys, "enroll_store", ["enroll_store_key"]), routed.filter("route = 'rejected'")


def reject_lines(rejected: DataFrame, columns: list[str]) -> DataFrame:
    """Rejected rows as one pipe-separated text column."""
    return rejected.select(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).alias("rejected_data"))
