"""Fact transforms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..codes import MATCH_CODES, UNKNOWN_KEY
from ..functions.dates import as_date, file_date
from ..functions.geo import coordinate, haversine_miles
from ..functions.text import amount_from_cents, decode, is_not_empty, strip_brackets
from ..operators.aggregates import max_key
from ..operators.columns import align_to_schema
from ..operators.joins import left_lookup, update_keys
from ..operators.ranking import latest_per_key
from ..operators.sequence import generate_sequence, number_rows
from ..operators.sets import union_all
from ..operators.sizing import broadcast_if_small
from .dims import NULL_TEXT, Mapping, apply_mapping

IMPLIED_MATCHES = [MATCH_CODES[n] for n in ("phone_email_loyalty", "plcc_name_loyalty", "plcc_loyalty")]


def fact_load(rows: DataFrame, target, key: str, order: list[Column] | None = None, stored: DataFrame | None = None) -> DataFrame:
    """Number new fact rows after the largest stored key and align them to the target table.
    Keys follow an order if one is given; otherwise the rows are numbered where they lie."""
    start = 0 if stored is None else max_key(stored, key)
    numbered = generate_sequence(rows, key, order, start) if order else number_rows(rows, key, start)
    return align_to_schema(numbered, target)


# ---------------------------------------------------------------- rename-only facts

# ---- fixed values: column mappings ----------------------------------------------
MAPPINGS = {
    "broadcast": Mapping("fact_broadcast_results_id", renames={"container": "ir_campaign_id"}),
    "click": Mapping("fact_click_data_id", derived={
        "recipient_id": "cast(recipient_id as string)", "delivery_id": "cast(delivery_id as string)",
        "url_id": "cast(url_id as string)", "url_type": "cast(url_type as string)", "url_type_text": NULL_TEXT}),
    "delivery": Mapping("fact_delivery_data_id", derived={
        "recipient_id": "cast(recipient_id as string)", "delivery_id": "cast(delivery_id as string)",
        "status": "cast(status as string)", "failure_reason": "cast(failure_reason as string)", "status_text": NULL_TEXT,
        "failure_reason_text": NULL_TEXT, "channel_text": NULL_TEXT}),
    "quarantine": Mapping("fact_quarantine_data_id", renames={"address": "email_address"}, derived={
        "recipient_id": "cast(recipient_id as string)", "status": "cast(status as string)",
        "error_reason": "cast(error_reason as string)", "status_text": NULL_TEXT, "type_text": NULL_TEXT}),
    "rpa": Mapping("fact_rpa_id", derived={"member_key": r"trim(regexp_replace(member_key, '[\\[\\]]', ''))"}),
    "rea": Mapping("fact_rea_id", renames={
        "ddqoutcleansedemail": "ddq_cleansed_email", "fname_foc": "first_name", "lname_foc": "last_name",
        "addr1_foc": "address_1", "addr2_foc": "address_2", "city_foc": "city", "state_foc": "state", "zip_foc": "zip"},
        derived={"member_key": r"trim(regexp_replace(member_key, '[\\[\\]]', ''))"}),
}


def simple_fact(name: str, work: DataFrame, batch_id: str) -> DataFrame:
    return apply_mapping(work, MAPPINGS[name]).withColumn("batch_id", F.lit(batch_id))


# ---- fixed values: hygiene results that count as valid ---------------------------
VALID_EMAIL_RESULTS = [
    ("verified", "verified"), ("undeliverable", "mailboxfull"), ("undeliverable", "syntaxfailure"),
    ("unreachable", "unreachable"), ("unreachable", "unresolvable"), ("illegitimate", "illegitimate"),
    ("illegitimate", "roleaccount"), ("illegitimate", "localpartspamtrap"), ("illegitimate", "profanity"),
    ("unknown", "unknown"), ("unknown", "timeout"), ("unknown", "acceptall"), ("unknown", "relaydenied")]


def email_hygiene(work: DataFrame) -> DataFrame:
    pair = F.concat_ws("/", F.lower(F.trim("result")), F.lower(F.trim("verboseresult")))
    return work.withColumn("category", F.when(pair.isin(["/".join(p) for p in VALID_EMAIL_RESULTS]), "valid").otherwise("invalid"))


def hygiene_in(work: DataFrame) -> DataFrame:
    """Coordinates to degrees, brackets off the member key, fillers dropped."""
    return (work.drop(*[c for c in work.columns if c.startswith("filler")])
            .withColumns({"latitude_6_decimals": coordinate(F.col("latitude_6_decimals")),
                          "longitude_6_decimals": coordinate(F.col("longitude_6_decimals")),
                          "member_key": strip_brackets(F.col("member_key"))}))


def members_by_ip(members: DataFrame) -> DataFrame:
    """Newest member per ip code."""
    return (members.filter(F.col("ip_code").isNotNull()).groupBy("ip_code").agg(F.max("member_key").alias("member_key")))


def with_member_by_ip(work: DataFrame, members: DataFrame, on: str = "member_id") -> DataFrame:
    """Member key by ip code, -1 if unknown (coupons, campaigns, service notes, tiers, rewards)."""
    side = members_by_ip(members).withColumnRenamed("ip_code", on)
    return work.drop("member_key").join(side, on, "left").fillna(UNKNOWN_KEY, ["member_key"])


# ---------------------------------------------------------------- loyalty facts

# ---- fixed values ---------------------------------------------------------------
POINT_TRANSACTION_TYPES = {1: "CREDIT", 2: "DEBIT", 3: "HOLD", 4: "POINTS CONSUMED", 5: "POINTS TRANSFER"}
VIRTUAL_CARD_TYPE = 39


def point_history(points: DataFrame, cards: DataFrame, dates: DataFrame) -> DataFrame:
    """Points with the card's member, type text and three date keys. The reward behind consumed
    points counts only for transaction type 4 of owner type 6."""
    holder = latest_per_key(cards.filter(is_not_empty(F.col("vc_key")) & (F.col("vc_key") != "-1")), "vc_key",
                            [F.col("card_history_id").desc()]).select("vc_key", "member_key", F.col("ip_code").alias("ipcode"))
    out = points.join(holder, "vc_key", "left").withColumns({
        "transaction_type_description": decode(F.col("transaction_type"), POINT_TRANSACTION_TYPES),
        "associated_reward_history_id": F.when((F.col("transaction_type") == 4) & (F.col("owner_type") == 6), F.col("row_key")),
        "consumes_point_history_id": F.col("parent_transaction_id"), "card_type_key": F.lit(VIRTUAL_CARD_TYPE),
        "point_source_id": F.lit(UNKNOWN_KEY), "promotion_key": F.lit(UNKNOWN_KEY)})
    return update_keys(out, ["expiration_date", "txn_date", "points_awarded_date"], dates, "sdate", "date_key")


REWARD_DATES = ["reward_issue_date", "reward_expiration_date", "reward_fulfillment_date", "api_redemption_date",
                "trxn_redemption_date"]


def reward_history(rewards: DataFrame, defs: DataFrame, members: DataFrame, reward_trxn: DataFrame, dates: DataFrame) -> DataFrame:
    """Rewards with definition, member, the latest transaction of the certificate and five date keys."""
    used = latest_per_key(reward_trxn.filter(F.col("certificate_nbr").isNotNull()), "certificate_nbr",
                          [F.col("fact_reward_trxn_history_id").desc()]).select("certificate_nbr", "fact_reward_trxn_history_id", "trxn_id")
    out = rewards.join(broadcast_if_small(defs.select("reward_def_id", "reward_def_key")), "reward_def_id", "left")
    out = with_member_by_ip(out, members).join(used, "certificate_nbr", "left")
    out = out.withColumn("trxn_redemption_date", F.col("api_redemption_date"))
    return update_keys(out, REWARD_DATES, dates, "sdate", "date_key")


def reward_trxn(transactions: DataFrame, certificates: list[str]) -> DataFrame:
    """One row per redeemed certificate of a transaction."""
    return (transactions.withColumn("certificate_nbr", F.explode(F.array(*certificates)))
            .filter(is_not_empty(F.col("certificate_nbr"))).drop(*certificates))


def tier_history(tiers: DataFrame, members: DataFrame, tier_dim: DataFrame, dates: DataFrame) -> DataFrame:
    out = left_lookup(tiers, tier_dim, "tier_id", ["tier_key"])
    out = update_keys(out, {"from_date": "tier_begin_date_key", "to_date": "tier_end_date_key"}, dates, "sdate", "date_key")
    out = with_member_by_ip(out, members).withColumn("file_date", file_date(F.col("etl_unique_id")))
    return out


def engagement(rows: DataFrame, stored: DataFrame, stores: DataFrame, dates: DataFrame) -> DataFrame:
    """Store, date and the stored parent row (an id may be stored more than once: newest)."""
    out = left_lookup(rows, stores.select(F.col("store_id").alias("a_storecode"), F.col("store_key").alias("engagement_store_key")),
                      "a_storecode", ["engagement_store_key"])
    out = update_keys(out, ["engagement_date"], dates, "sdate", "date_key")
    parents = stored.groupBy(F.col("id").alias("_p")).agg(F.max("engagement_history_id").alias("parent_engagement_history_id"))
    return (out.join(parents, F.col("a_parentrowkey") == F.col("_p"), "left").drop("_p")
            .fillna(UNKNOWN_KEY, ["parent_engagement_history_id"]))


def contact_history(deliveries: DataFrame, ring_codes: DataFrame) -> DataFrame:
    """Deliveries with every segment of their campaign."""
    return deliveries.join(ring_codes.select("campaign_key", "campaign_segment_key").distinct(), "campaign_key", "left")


def waterfall_summary(feeds: list[DataFrame], till: DataFrame, batch_id: str) -> DataFrame:
    """Rows per source, record info, match type and rule; the till feed counts each
    transaction once, with its lowest match type."""
    keys = ["source_key", "record_info_key", "match_type_key", "mcd_criteria"]
    cols = lambda d: d.withColumnRenamed("match_key", "match_type_key").select(*keys)
    best = till.groupBy("transaction_id").agg(F.min(F.struct("match_key", "source_key", "record_info_key", "mcd_criteria")).alias("b"))
    rows = union_all([cols(d) for d in feeds] + [cols(best.select("b.*"))])
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("number_matches")).withColumn("batch_id", F.lit(batch_id))


# ---------------------------------------------------------------- transaction detail

DETAIL_KEYS = ["lbi_trxn_line_type_code", "lbi_trxn_line_type_cat_code", "price_modified_ind", "mobile_pos_ind",
               "associate_trxn_flag", "tax_status_flag", "loyalty_ind"]


def _flag(name: str) -> Column:
    return F.when(F.col(name) == 0, "N").otherwise("Y")


def _common() -> dict[str, Column]:
    return {
        "trxn_detail_id": F.concat(F.col("trxn_id").cast("string"), F.lpad(F.col("transaction_sequence_number").cast("string"), 4, "0")),
        "trxn_id": F.col("trxn_id"), "trxn_seq_nbr": F.col("transaction_sequence_number"), "member_key": F.col("member_key"),
        "trxn_date": F.col("transaction_date_iso"), "store_id": F.col("store_id"), "item_number": F.col("item_number"),
        "match_type_key": F.col("match_key"), "loyalty_ind": F.when(is_not_empty(F.col("loyalty")), "Y").otherwise("N"),
        "captured_loyalty_id": F.col("loyalty"),
        "implied_loyalty_id": F.when(F.col("match_key").isin(IMPLIED_MATCHES), F.col("member_loyalty")),
    }


def _signed(quantity: str, sign: str) -> Column:
    return F.when(F.col(sign) == "-", -F.col(quantity)).otherwise(F.col(quantity))


def _money(v: Column) -> Column:
    return v.cast("decimal(10,2)")


def sale_line() -> dict[str, Column]:
    qty = F.col("retail_quantity")
    unit = amount_from_cents(F.col("retail_sales_discount_amount"), F.col("retail_sales_discount_amount_sign"))
    return {
        "purchase_qty": qty, "units": _signed("retail_quantity", "retail_sales_discount_amount_sign"),
        "original_price": amount_from_cents(F.col("original_price"), F.col("original_price_sign")),
        "retail_amount": amount_from_cents(F.col("retail_amount"), F.col("retail_amount_sign")),
        "unit_price_after_discount": unit, "total_line_amnt_after_discount": _money(unit * qty),
        "discount_amount": _money(F.lit(0)), "is_shipping_cost": F.lit("NO"), "gift_card_sales_ind": F.lit("N"),
        "lbi_trxn_line_type_cat_code": F.when(F.col("transaction_modifier") == 0, "SALE").otherwise("RET"),
        "lbi_trxn_line_type_code": F.lit("IA"), "price_modified_ind": _flag("price_modifier_indicator"),
        "mobile_pos_ind": _flag("pos_indicator"), "associate_trxn_flag": _flag("associate_sales_flag"),
        "tax_status_flag": _flag("tax_status"), "discount_type_code": F.lit(None).cast("string"),
        "ring_code_used": F.lit(None).cast("int"), "markdown_type": F.lit(None).cast("string"),
    }


# fixed values: non-merchandise types
SHIPPING_TYPE, GIFT_CARD_TYPE = 25, 15


def non_merchandise_line() -> dict[str, Column]:
    kind, qty = F.col("non_merchandise_type"), F.col("non_merchandise_quantity")
    amount = amount_from_cents(F.col("non_merchandise_amount"), F.col("non_merchandise_amount_sign"))
    goods = lambda c: F.when(kind == SHIPPING_TYPE, 0).otherwise(c)
    return {
        "purchase_qty": goods(qty), "units": goods(_signed("non_merchandise_quantity", "non_merchandise_amount_sign")),
        "original_price": amount, "retail_amount": amount, "unit_price_after_discount": amount,
        "total_line_amnt_after_discount": _money(amount * qty), "discount_amount": _money(F.lit(0)),
        "is_shipping_cost": F.when(kind == SHIPPING_TYPE, "YES").otherwise("NO"),
        "gift_card_sales_ind": F.when(kind == GIFT_CARD_TYPE, "Y").otherwise("N"),
        "lbi_trxn_line_type_cat_code": F.when(F.col("transaction_modifier") == 0, "SALE").otherwise("RET"),
        "lbi_trxn_line_type_code": F.lit("N/A"), "price_modified_ind": F.lit("N/A"), "mobile_pos_ind": F.lit("N/A"),
        "associate_trxn_flag": F.lit("N/A"), "tax_status_flag": _flag("non_merchandise_tax"),
        "discount_type_code": F.lit(None).cast("string"), "ring_code_used": F.lit(None).cast("int"),
        "markdown_type": F.lit(None).cast("string"),
    }


# fixed values: ring codes and the discount code whose amount counts as a line amount
CERTIFICATE_RING, COUPON_RING, AMOUNT_DISCOUNT = 1417, 8888, "0610"


def discount_line() -> dict[str, Column]:
    two = lambda c: F.lpad(F.col(c).cast("string"), 2, "0")
    code = F.concat(two("discount_type"), two("discount_deal_code"))
    amount = amount_from_cents(F.col("discount_amount"), F.col("discount_amount_sign"))
    ring, zero = F.col("ring_code"), _money(F.lit(0))
    return {
        "purchase_qty": F.lit(0), "units": F.lit(0), "original_price": zero, "retail_amount": zero,
        "unit_price_after_discount": zero,
        "total_line_amnt_after_discount": F.when(code == AMOUNT_DISCOUNT, amount).otherwise(zero),
        "discount_amount": amount, "is_shipping_cost": F.lit("NO"), "gift_card_sales_ind": F.lit("N"),
        "lbi_trxn_line_type_cat_code": F.lit("DISC"), "lbi_trxn_line_type_code": F.lit("N/A"),
        "price_modified_ind": F.lit("N/A"), "mobile_pos_ind": _flag("mobile_pos_indicator"),
        "associate_trxn_flag": _flag("associate_sales_flag"), "tax_status_flag": F.lit("N/A"),
        "discount_type_code": code, "ring_code_used": ring,
        "markdown_type": F.when(ring == CERTIFICATE_RING, "CERT").when(ring.between(0, 1000), "POS")
                          .when(F.col("ring_code_dim").between(1001, 9999) | (ring == COUPON_RING), "CRM"),
    }


def transaction_detail(sale: DataFrame, non_merch: DataFrame, discount: DataFrame, matched: DataFrame, ring_codes: DataFrame,
                       products: DataFrame, stores: DataFrame, dates: DataFrame, times: DataFrame, trxn_types: DataFrame,
                       discount_types: DataFrame) -> DataFrame:
    """Three kinds of till lines in one schema, with member and dimension keys (-1 if unknown)."""
    one_per_trxn = matched.groupBy("trxn_id").agg(F.min(F.struct(
        "match_key", "member_key", "loyalty", "member_loyalty")).alias("m")).select("trxn_id", "m.*")
    rings = ring_codes.select(F.col("ring_code").alias("ring_code_dim")).distinct()
    discount = discount.join(broadcast_if_small(rings), F.col("ring_code") == F.col("ring_code_dim"), "left")
    heads = ["trxn_id", "transaction_sequence_number", "transaction_date_iso", "transaction_time", "store_id", "item_number"]
    kinds = ((sale, sale_line()), (non_merch, non_merchandise_line()), (discount, discount_line()))
    wide = [lines.select(*heads, *[v.alias(k) for k, v in columns.items()]) for lines, columns in kinds]
    # the lines are unified while still narrow and meet the matched transactions in one join
    rows = union_all(wide).join(one_per_trxn, "trxn_id")
    rows = rows.select(*[v.alias(k) for k, v in _common().items()], "transaction_time", *sale_line().keys())
    rows = left_lookup(rows, products.groupBy("item_number").agg(F.max("product_key").alias("product_key")), "item_number", ["product_key"])
    rows = left_lookup(rows, stores, "store_id", ["store_key", "currency_key"])
    rows = left_lookup(rows, dates.select(F.col("sdate").alias("trxn_date"), F.col("date_key").alias("trxn_date_key")), "trxn_date", ["trxn_date_key"])
    rows = left_lookup(rows, times, "transaction_time", ["trxn_time_key"])
    rows = left_lookup(rows, trxn_types, DETAIL_KEYS, ["transaction_type_key"])
    return left_lookup(rows, discount_types, "discount_type_code", ["discount_type_key"])


# ---------------------------------------------------------------- transaction summary

# ---- fixed values: tender type keys per bucket -----------------------------------
TENDER_BUCKETS = {
    "plcc_amount": [1, 2, 25],
    "credit_card_amount": [21, 19, 24, 3, 7, 6, 27, 28, 5, 32],
    "cash_amount": [4, 35],
    "check_amount": [16, 23],
    "gift_card_amount": [11, 9, 29, 18, 22],
}
REWARD_TENDERS = [12, 11]
WEB_DISTRICT = "97"


def tender_buckets(tender: DataFrame) -> DataFrame:
    """Tender amounts per transaction, one conditional sum per bucket."""
    kind, amount = F.col("tender_type_key"), F.col("tender_amount")
    known = [k for keys in TENDER_BUCKETS.values() for k in keys]
    sums = [F.sum(F.when(kind.isin(keys), amount).otherwise(0)).alias(n) for n, keys in TENDER_BUCKETS.items()]
    other = F.sum(F.when(~kind.isin(known), amount).otherwise(0)).alias("other_amount")
    return tender.groupBy("trxn_id").agg(*sums, other, F.max("tender_id").alias("max_tender_id"),
                                         F.sum("tender_amount").alias("ttl_amount"))


def reward_certificates(customer: DataFrame, tender: DataFrame, certificates: list[str]) -> DataFrame:
    """Redeemed certificates per transaction that was paid with one."""
    filled = [F.when(is_not_empty(F.col(c)), 1).otherwise(0) for c in certificates]
    total = filled[0]
    for f in filled[1:]:
        total = total + f
    counts = customer.groupBy("trxn_id").agg(F.sum(total).alias("reward_certs_qty"))
    return counts.join(tender.filter(F.col("tender_type_key").isin(REWARD_TENDERS)), "trxn_id", "left_semi")


def transaction_summary(detail: DataFrame, products: DataFrame, tender: DataFrame, certs: DataFrame, members: DataFrame,
                        stores: DataFrame) -> DataFrame:
    """One row per transaction, including transactions that have only tender lines."""
    lines = detail.join(broadcast_if_small(products.select("product_key", "gender")), "product_key", "left")
    up = lambda c: F.upper(F.trim(F.col(c)))
    women, men = F.coalesce(up("gender") == "W", F.lit(False)), F.coalesce(up("gender") == "M", F.lit(False))
    gift = F.coalesce(up("gift_card_sales_ind").isin("Y", "YES"), F.lit(False))
    other = ~women & ~men & F.coalesce(up("gift_card_sales_ind").isin("N", "NO") & (up("is_shipping_cost") == "NO"), F.lit(False))
    shipping = F.coalesce(up("is_shipping_cost").isin("Y", "YES"), F.lit(False))
    outlet = F.col("original_price") + F.lit(0.01).cast("decimal(3,2)") == F.round("original_price")
    total = lambda cond, c: F.sum(F.when(cond, F.col(c)).otherwise(0))
    measures = {"purchase_qty": "purchase_qty", "units": "units", "amount_after_discount": "total_line_amnt_after_discount"}
    aggs = []
    for name, src in measures.items():
        for tag, cond in (("w", women), ("m", men), ("gc", gift), ("other", other)):
            aggs.append(total(cond, src).alias(f"{tag}_{name}"))
        for tag, cond in (("out_w", women & outlet), ("out_m", men & outlet)):
            aggs.append(total(cond, src).alias(f"{tag}_{name}"))
    ring = F.col("ring_code_used")
    summary = lines.groupBy("trxn_id").agg(
        F.max("member_key").alias("member_key"), F.max("store_key").alias("store_key"), F.max("trxn_date").alias("trxn_date"),
        *aggs, total(shipping, "retail_amount").alias("shipping_amount"),
        total(ring == str(COUPON_RING), "discount_amount").alias("discount_amount_8888"),
        total(ring != str(COUPON_RING), "discount_amount").alias("discount_amount"))
    for name in measures:
        parts = [F.col(f"{t}_{name}") for t in ("w", "m", "gc", "other")]
        summary = summary.withColumn(f"ttl_{name}", parts[0] + parts[1] + parts[2] + parts[3])
        summary = summary.withColumn(f"ttl_out_{name}", F.col(f"out_w_{name}") + F.col(f"out_m_{name}"))
    buckets = tender_buckets(tender)
    heads = tender.groupBy("trxn_id").agg(*[F.max(c).alias(f"_t_{c}") for c in ("member_key", "store_key", "trxn_date")])
    # a full join finds transactions without detail lines without a second pass over the detail
    rows = (summary.withColumn("_d", F.lit(True)).join(heads.join(buckets, "trxn_id"), "trxn_id", "full"))
    for c in ("member_key", "store_key", "trxn_date"):
        rows = rows.withColumn(c, F.coalesce(c, f"_t_{c}")).drop(f"_t_{c}")
    rows = rows.withColumns({"has_detail": F.when(F.col("_d"), "YES").otherwise("NO"),
                             "has_tender": F.when(F.col("max_tender_id").isNull(), "NO").otherwise("YES")}).drop("_d")
    rows = rows.join(certs, "trxn_id", "left")
    numbers = [c for c, t in rows.dtypes if c.endswith(("_amount", "_qty", "_units", "_8888", "_discount"))]
    rows = rows.fillna(0, numbers)
    who = members.select("member_key", "member_acct_enroll_date", F.col("latitude").alias("_mlat"), F.col("longitude").alias("_mlon"))
    where = stores.select("store_key", "district_code", F.col("latitude").alias("_slat"), F.col("longitude").alias("_slon"))
    rows = rows.join(who, "member_key", "left").join(broadcast_if_small(where), "store_key", "left")
    days = F.datediff("trxn_date", "member_acct_enroll_date")
    web = F.col("district_code") == WEB_DISTRICT
    enrolled = (web & days.between(0, 7)) | (~web & (days == 0))
    return rows.withColumns({
        "enrollment_trxn_flag": F.when(enrolled, "YES").otherwise("NO"),
        "distance_traveled": haversine_miles(F.col("_mlat"), F.col("_mlon"), F.col("_slat"), F.col("_slon"))}
    ).drop("_mlat", "_mlon", "_slat", "_slon", "member_acct_enroll_date", "district_code")


# ---------------------------------------------------------------- tender history

def tender_history(tender: DataFrame, matched: DataFrame, stores: DataFrame, dates: DataFrame, tender_types: DataFrame,
                   check_auth: DataFrame) -> DataFrame:
    """Tender lines with their matched member (by transaction, type and card) and five keys."""
    yn = lambda c: F.when(F.col(c) == 1, "Y").otherwise("N")
    yes = lambda c: F.when(F.col(c) == 1, "YES").otherwise("NO")
    pad = lambda c, n: F.lpad(F.col(c).cast("string"), n, "0")
    side = matched.groupBy("trxn_id", pad("tender_type", 2).alias("_type"), pad("tender_number", 18).alias("_card")).agg(
        F.min(F.struct("match_key", "member_key", "loyalty", "member_loyalty")).alias("m")).select("trxn_id", "_type", "_card", "m.*")
    rows = tender.withColumns({"_type": pad("tender_type", 2), "_card": pad("tokenized_cc_nbr", 18)})
    rows = rows.join(side, ["trxn_id", "_type", "_card"], "left").withColumnRenamed("match_key", "match_type_key")
    code = F.col("match_type_key")
    rows = rows.withColumns({
        "tender_amount": amount_from_cents(F.col("tender_amt"), F.col("tender_amount_sign")),
        "change_due": amount_from_cents(F.col("chng_due"), F.col("change_due_sign")),
        "associate_sales_flag": yes("associate_sales_flag"), "post_void_ind": yes("post_void_flag"),
        "check_auth_enable_flag": yn("check_auth_enable"), "check_swiped_flag": yn("chk_swiped"), "check_auth_type": yn("check_auth_type"),
        "captured_loyalty_id": F.when(code.isin(MATCH_CODES["loyalty_id"], MATCH_CODES["no_match"]), F.col("loyalty")),
        "implied_loyalty_id": F.when(code.isin(IMPLIED_MATCHES), F.col("member_loyalty"))})
    rows = left_lookup(rows, stores, "store_id", ["store_key", "currency_key"])
    rows = left_lookup(rows, dates.select(F.col("sdate").alias("trxn_date"), F.col("date_key").alias("trxn_date_key")), "trxn_date", ["trxn_date_key"])
    rows = left_lookup(rows, tender_types.select(F.col("tender_type_code").alias("tender_type"), "tender_type_key"), "tender_type", ["tender_type_key"])
    rows = left_lookup(rows, check_auth, ["check_auth_enable_flag", "check_swiped_flag", "check_auth_type"], ["check_auth_key"])
    return rows.fillna(UNKNOWN_KEY, ["member_key", "match_type_key"]).drop("_type", "_card", "loyalty", "member_loyalty")


# ---------------------------------------------------------------- card history

# ---- fixed values ---------------------------------------------------------------
CARD_FEED_TYPE, LOYALTY_SOURCE = 1, 300
CARD_DATES = ["account_open_date", "last_purchase_date", "closed_date", "cycle_update_date", "card_issue_date",
              "e_statement_change_date", "last_return_date", "unregistration_date", "first_card_trxn_date", "last_card_trxn_date"]


def card_ads400(feed: DataFrame, dates: DataFrame, on) -> DataFrame:
    """Credit card feed: open or closed, marketable, primary holder."""
    open_ = F.col("closed_date").isNull() | (F.col("closed_date") > as_date(on))
    out = feed.withColumnsRenamed({"account_number": "tokenized_cc_nbr", "open_date": "account_open_date", "match_key": "match_type_key",
                                   "credit_term_number": "credit_term_nbr", "division_number": "division_nbr"})
    out = out.withColumns({
        "open_close_ind": F.when(open_, "O").otherwise("C"),
        "marketable_ind": F.when(F.col("promotability_indicator") == "Y", "Y").otherwise("N"),
        "card_type_key": F.lit(CARD_FEED_TYPE), "is_primary_account_holder": F.lit("YES"), "email_change_date": as_date(on)})
    return update_keys(out.drop("promotability_indicator"), ["account_open_date"], dates, "sdate", "date_key")


def card_ads600(statement: DataFrame, account: DataFrame, dates: DataFrame, from_account=("member_key",)) -> DataFrame:
    """Full merge of the statement feed with the account feed by card. A card of both takes
    the named columns from the account feed and all others from the statement feed."""
    key = "tokenized_cc_nbr"
    s = statement.withColumnsRenamed({c: f"600_{c}" for c in statement.columns})
    a = account.withColumnsRenamed({c: f"400_{c}" for c in account.columns})
    both = s.join(a, F.col(f"600_{key}") == F.col(f"400_{key}"), "full")
    in_s = F.col(f"600_{key}").isNotNull()
    in_a = F.col(f"400_{key}").isNotNull()
    cols = []
    for c in dict.fromkeys(statement.columns + account.columns):
        if c not in account.columns:
            cols.append(F.col(f"600_{c}").alias(c))
        elif c not in statement.columns:
            cols.append(F.col(f"400_{c}").alias(c))
        else:
            take_account = in_a & (~in_s | F.lit(c in from_account))
            cols.append(F.when(take_account, F.col(f"400_{c}")).otherwise(F.col(f"600_{c}")).alias(c))
    return update_keys(both.select(*cols), ["account_open_date"], dates, "sdate", "date_key")


def card_bp_member(feed: DataFrame, dates: DataFrame) -> DataFrame:
    """Cards that loyalty members registered."""
    out = feed.filter(is_not_empty(F.col("a_tokennbrassociationrequest"))).select(
        "member_key", F.col("ipcode").alias("ip_code"), F.col("a_tokennbrassociationrequest").alias("tokenized_cc_nbr"),
        F.col("membercreatedate").alias("account_open_date"), F.col("a_enrollmentstorenumber").alias("application_store_key"),
        F.col("memberclosedate").alias("closed_date"), F.when(F.col("memberclosedate").isNull(), "O").otherwise("C").alias("open_close_ind"),
        F.col("match_key").alias("match_type_key"), F.lit(LOYALTY_SOURCE).alias("source_key"))
    return update_keys(out, ["closed_date", "account_open_date"], dates, "sdate", "date_key")


def card_virtual(cards: DataFrame, members: DataFrame) -> DataFrame:
    """Virtual cards of loyalty members; unknown dates are the far past."""
    past = as_date("1900-01-01")
    out = with_member_by_ip(cards, members)
    return out.withColumns({
        "card_type_key": F.lit(VIRTUAL_CARD_TYPE), "ip_code": F.col("member_id"), "loyalty_id": F.col("loyalty_id_number"),
        "vc_key": F.col("virtual_card_key"), "match_type_key": F.lit(MATCH_CODES["ip_code"]), "source_key": F.lit(LOYALTY_SOURCE),
        "is_primary_account_holder": F.lit("NO"), "issued_date": F.coalesce(F.col("date_issued").cast("date"), past),
        "registration_date": F.coalesce(F.col("date_registered").cast("date"), past), **{c: past for c in CARD_DATES}})


def card_till(tender: DataFrame, matched: DataFrame, card_types: DataFrame) -> DataFrame:
    """Cards seen at the till, with the matched member of their transaction."""
    side = matched.groupBy("trxn_id", "tender_number", "tender_type").agg(
        F.min(F.struct("match_key", "member_key", "loyalty", "source_key")).alias("m")).select("trxn_id", "tender_number", "tender_type", "m.*")
    out = tender.join(side, ["trxn_id", "tender_number", "tender_type"], "left")
    out = out.withColumns({
        "marketable_ind": F.when(F.col("promotion_flag") == 0, "N").otherwise("Y"), "loyalty_id": F.col("loyalty"),
        "application_store_key": F.lit(UNKNOWN_KEY), **{c: as_date("1900-01-01") for c in CARD_DATES}})
    out = left_lookup(out, card_types.select(F.col("tender_type_code").alias("tender_type"), "card_type_key"), "tender_type", ["card_type_key"])
    return (out.fillna(UNKNOWN_KEY, ["member_key"])
            .withColumnsRenamed({"tender_number": "tokenized_cc_nbr", "match_key": "match_type_key"}))
