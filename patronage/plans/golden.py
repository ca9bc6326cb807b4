"""Golden record: one collapsed member per duplicate group.

Every field rule is an aggregate with a partial step (min or max of a struct that spells the
rule's order), so a group of any size is reduced where its rows are and is never gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..codes import DATE_FAR, DATE_UNKNOWN, UNKNOWN_KEY
from ..functions.dates import as_date
from ..operators.aggregates import any_flag
from ..operators.skew import join_back

# ---- fixed values: columns that move together -------------------------------
NAME_ADDRESS_COLUMNS = [
    "household_key", "global_opt_out", "name_prefix", "first_name", "last_name", "name_suffix", "company_name",
    "address1_scrubbed", "address2_scrubbed", "city_scrubbed", "state_scrubbed", "zip_code_scrubbed",
    "zip4_scrubbed", "zip_full_scrubbed", "non_us_postal_code", "country_code", "dpv_key", "latitude", "longitude",
    "ncoa_last_change_date", "first_name_scrubbed", "last_name_scrubbed", "valid_loose", "valid_strict", "county",
    "address1", "address2", "address_mailable", "address_type", "city", "state", "zip_code", "zip4",
    "name_prefix_scrubbed", "gender_scrubbed", "name_suffix_scrubbed", "country_code_scrubbed", "dwelling_type"]
OVERLAY_COLUMNS = ["overlay_rank_key", "overlay_load_id", "overlay_date"]
ORIGINAL_SOURCE_COLUMNS = [
    "original_source_key", "original_record_info_key", "customer_introduction_date",
    "customer_introduction_date_key", "ean", "ean_type", "rid", "ecommerce_customer_nbr", "legacy_customer_nbr",
    "customer_add_date", "customer_add_date_key"]
CURRENT_SOURCE_COLUMNS = ["record_info_key", "match_type_key", "current_source_key", "batch_id", "last_updated_date"]
ENRICHMENT_COLUMNS = [
    "valid_email", "email_address", "email_consent", "cm_gender_merch_descr", "preferred_store_key", "record_type",
    "phone_nbr", "sms_consent", "sms_consent_date", "distance_to_preferred_store", "email_consent_date",
    "preferred_channel", "closest_store_state", "second_closest_store_state", "distance_to_closest_store",
    "distance_to_sec_closest_store", "closest_store_key", "second_closest_store_key", "preferred_store_state",
    "is_dm_marketable", "is_sms_marketable", "is_em_marketable", "best_household_member"]
PHONE_COLUMNS = ["valid_phone_for_call", "valid_phone_for_sms", "phone_ext", "phone_type", "phone_consent"]
INDICATOR_COLUMNS = ["ads_do_not_statement_insert", "ads_do_not_sell_name", "ads_spam_indicator",
                     "ads_email_change_date", "ads_return_mail_ind", "open_close_ind"]
LOYALTY_COLUMNS = [
    "cdh_member_key", "communications_pref", "confirm_age_eighteen", "current_tier_key", "tier_name",
    "e_cert_opt_in", "e_cert_opt_in_date", "e_cert_opt_in_date_key", "facebook_id", "ip_code", "is_loyalty_member",
    "language_preference", "loyalty_id", "loyalty_type", "lw_enrollment_source_key", "lw_enrollment_store_key",
    "member_acct_close_date", "member_acct_close_date_key", "member_acct_enroll_date",
    "member_acct_enroll_date_key", "member_acct_open_date", "member_acct_open_date_key", "member_source",
    "member_status", "opt_status", "plcc_request_date", "plcc_request_user_id", "preapproval_expiration_date",
    "preapproval_number", "printed_card_req_date", "printed_card_req_date_key", "printed_cert_opt_in",
    "printed_cert_opt_in_date", "printed_cert_opt_in_date_key", "request_loyalty_card", "request_paper_cert_date",
    "security_question", "token_nbr_association_request", "twitter_id", "is_plcc_request",
    "member_acct_open_date_time"]
FLAG_COLUMNS = ["promotion_consent", "deceased", "address_is_prison", "is_plcc"]
FIRST_TRXN_COLUMNS = ["first_trxn_date", "first_trxn_date_key", "first_trxn_store_key"]
LAST_STORE_COLUMNS = ["last_store_purch_date", "last_store_purch_date_key"]
LAST_WEB_COLUMNS = ["last_web_purch_date", "last_web_purch_date_key"]
COUNT_COLUMNS = ["prospect_appearance_count", "prospect_contact_count", "prospect_mb_purch_count"]
CARD_SOURCES = [8, 9]

GROUP = ["grouping_id"]


def _loyal() -> Column:
    return F.coalesce(F.col("is_loyalty_member") == "YES", F.lit(False))


def _date_or(c: str, default: str) -> Column:
    return F.coalesce(F.col(c).cast("date"), as_date(default))


def _pick(df: DataFrame, names: list[str], order: list[Column], largest: bool = False) -> Column:
    """Aggregate: the named columns of the row that is first (or last) in the order."""
    have = [c for c in names if c in df.columns]
    row = F.struct(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]).alias("o"),
                   F.struct(*[F.col(c) for c in have]).alias("v"))
    return (F.max_by if largest else F.min_by)(row["v"], row["o"])


def collections(rows: DataFrame, group: list[str] = GROUP) -> DataFrame:
    """Per group: size, collection id and best member.

    -1 single · 1 no loyalty member · 2 all · 3 exactly one · 4 some. Best member: 1 earliest
    introduction then smallest key; 3 the loyalty member; 4 the active member with the latest
    transaction, then earliest enrolment; otherwise -1.
    """
    key = F.col("member_key")
    active = F.coalesce(F.col("member_status") == "ACTIVE", F.lit(False))
    agg = rows.groupBy(*group).agg(
        F.count(F.lit(1)).alias("grouped_count"),
        F.count_if(_loyal()).alias("_loyal"),
        F.min(F.struct(_date_or("customer_introduction_date", DATE_FAR), key.alias("k")))["k"].alias("_oldest"),
        F.min(F.when(_loyal(), key)).alias("_loyal_key"),
        F.min(F.when(active, F.struct(
            (-F.unix_date(_date_or("trxn_date", DATE_UNKNOWN))).alias("t"),
            _date_or("member_acct_enroll_date", DATE_FAR).alias("e"), key.alias("k"))))["k"].alias("_active"))
    coll = (F.when(F.col("grouped_count") == 1, -1).when(F.col("_loyal") == 0, 1).when(F.col("_loyal") == 1, 3)
            .when(F.col("_loyal") == F.col("grouped_count"), 2).otherwise(4))
    out = agg.withColumn("collection_id", coll)
    best = (F.when(F.col("collection_id") == 1, F.col("_oldest")).when(F.col("collection_id") == 3, F.col("_loyal_key"))
            .when(F.col("collection_id") == 4, F.coalesce("_active", F.lit(UNKNOWN_KEY).cast("bigint")))
            .otherwise(F.lit(UNKNOWN_KEY).cast("bigint")))
    return (out.withColumn("resolved_member", best)
            .withColumn("is_resolved", ~F.col("collection_id").isin(-1, 2) & (F.col("resolved_member") != UNKNOWN_KEY))
            .select(*group, "grouped_count", "collection_id", "resolved_member", "is_resolved"))


def eligible(rows: DataFrame, colls: DataFrame, group: list[str] = GROUP) -> DataFrame:
    """Rows that take part in the collapse: in collection 4 the loyalty members other than
    the best one are left out."""
    tagged = join_back(rows, colls, group)
    drop = (F.col("collection_id") == 4) & _loyal() & (F.col("member_key") != F.col("resolved_member"))
    return tagged.filter(~drop)


# ---------------------------------------------------------------- field rules (aggregates)

def overlay_rank() -> Column:
    r = F.col("source_overlay_rank")
    return F.when(r.isNull() | r.isin(-1, 0), 99).otherwise(r)


def dpv_rank() -> Column:
    d = F.col("dpv_key")
    return F.when(d.isNull() | (d == 0), -1).otherwise(d)


def _ago(c: str) -> Column:
    """Later dates first; a missing date last."""
    return F.coalesce(-F.unix_date(F.col(c).cast("date")), F.lit(2147483647))


def name_address(df: DataFrame) -> Column:
    return _pick(df, NAME_ADDRESS_COLUMNS, [overlay_rank(), -dpv_rank(), _ago("last_updated_date"), F.col("member_key")])


def overlay(df: DataFrame) -> Column:
    return _pick(df, OVERLAY_COLUMNS, [overlay_rank(), F.col("member_key")])


def original_source(df: DataFrame) -> Column:
    return _pick(df, ORIGINAL_SOURCE_COLUMNS, [_date_or("customer_introduction_date", DATE_FAR), F.col("member_key")])


def current_source(df: DataFrame) -> Column:
    return _pick(df, CURRENT_SOURCE_COLUMNS, [_ago("last_updated_date"), F.col("member_key")])


def indicators(df: DataFrame) -> Column:
    """Among members of the card sources the largest open/close indicator (missing counts as
    open), the oldest on ties; without such members the latest member."""
    is_card = F.coalesce(F.col("current_source_key").isin(CARD_SOURCES), F.lit(False))
    ind = F.coalesce(F.col("open_close_ind"), F.lit("O"))
    closed_first = -F.ascii(ind)
    order = [F.when(is_card, 0).otherwise(1), F.when(is_card, closed_first).otherwise(0),
             F.when(is_card, -_ago("last_updated_date")).otherwise(_ago("last_updated_date")), F.col("member_key")]
    return _pick(df, INDICATOR_COLUMNS, order)


def gender() -> Column:
    female = F.count_if(F.col("gender").isin("FEMALE", "F"))
    male = F.count_if(F.col("gender").isin("MALE", "M"))
    return (F.when((female == 0) & (male == 0), "UNKNOWN").when(female >= male, "FEMALE").otherwise("MALE"))


def dm_consent(df: DataFrame) -> Column:
    c = F.col("direct_mail_consent")
    order = [_ago("direct_mail_consent_date"), F.when(c == "YES", 0).when(c == "NO", 1).otherwise(2), F.col("member_key")]
    return _pick(df, ["direct_mail_consent", "direct_mail_consent_date"], order)


def first_trxn(df: DataFrame) -> Column:
    store = F.col("first_trxn_store_key")
    order = [_date_or("first_trxn_date", DATE_FAR),
             F.when(store.isNull() | store.isin(0, -1), F.lit(2 ** 62)).otherwise(store), F.col("member_key")]
    return _pick(df, FIRST_TRXN_COLUMNS, order)


def last_purchase(df: DataFrame, names: list[str], latest: bool = False) -> Column:
    """The earliest date of the group is taken for "last purchase", as in the reference;
    `latest` gives what the name says."""
    date = names[0]
    order = [_ago(date)] if latest else [_date_or(date, DATE_FAR)]
    return _pick(df, names, order + [F.col("member_key")])


def loyalty(df: DataFrame) -> Column:
    is_best = F.col("collection_id").isin(3, 4) & (F.col("member_key") == F.col("resolved_member"))
    have = [c for c in LOYALTY_COLUMNS if c in df.columns]
    return F.max(F.when(is_best, F.struct(*have)))


def birth_dates(rows: DataFrame, on, group: list[str] = GROUP) -> DataFrame:
    """Per group the most frequent birth date of the last 100 years; when several dates are
    equally frequent, the earliest valid date."""
    day = as_date(on)
    valid = rows.filter((F.col("birth_date") < day) & (F.col("birth_date") > F.add_months(day, -1200)))
    per_date = valid.groupBy(*group, "birth_date").agg(F.count(F.lit(1)).alias("_n"))
    per_count = per_date.groupBy(*group, "_n").agg(F.count(F.lit(1)).alias("_dates"), F.min("birth_date").alias("_d"))
    top = F.max(F.struct("_n", "_dates", "_d"))
    return per_count.groupBy(*group).agg(F.when(top["_dates"] > 1, F.min("_d")).otherwise(top["_d"]).alias("birth_date"))


def golden_records(rows: DataFrame, on, group: list[str] = GROUP) -> DataFrame:
    """Collapsed member per resolved group, with the group's collection columns."""
    colls = collections(rows, group)
    part = eligible(rows, colls, group).filter("is_resolved")
    have = set(rows.columns)
    aggs = {"_na": name_address(part), "_ov": overlay(part), "_os": original_source(part), "_cs": current_source(part),
            "_in": indicators(part), "_dm": dm_consent(part), "_ft": first_trxn(part),
            "_ls": last_purchase(part, LAST_STORE_COLUMNS), "_lw": last_purchase(part, LAST_WEB_COLUMNS),
            "_lo": loyalty(part)}
    keys = [*group, "grouped_count", "collection_id", "resolved_member"]
    flags = [any_flag(c).alias(c) for c in FLAG_COLUMNS if c in have]
    counts = [F.sum(F.coalesce(F.col(c), F.lit(0))).alias(c) for c in COUNT_COLUMNS if c in have]
    wide = part.groupBy(*keys).agg(*[v.alias(k) for k, v in aggs.items()], gender().alias("gender"), *flags, *counts)
    wide = wide.join(birth_dates(part, on, group), group, "left")
    single = [c for c in wide.columns if c not in aggs]
    # the store of the first transaction belongs to its own rule, not to the address block
    reset = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in ENRICHMENT_COLUMNS + PHONE_COLUMNS if c in have]
    done = wide.select(*single, *[f"{s}.*" for s in aggs], *reset)
    return done.withColumn("member_key", F.col("resolved_member"))
