"""Export layer: change flags, customer and transaction extracts, lookups and feeds."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import age_years, as_date
from ..functions.geo import haversine_miles
from ..functions.text import decode, is_not_empty, normalize_flag
from ..operators.columns import null_text_to_empty, strip_delimiter
from ..operators.filters import after_business_date
from ..operators.joins import constant_domain
from ..operators.ranking import latest_per_key, newest
from ..operators.sizing import broadcast_if_small
from ..operators.skew import join_back
from ..operators.staging import stage
from .facts import WEB_DISTRICT


def change_flag(df: DataFrame, business_date, run_date, added: str | None = None, updated: str = "last_updated_date") -> DataFrame:
    """ingest_date, cc_flag and run_date: NC up to the business date, A if added that day, else C."""
    out = df.withColumn("ingest_date", F.col(updated).cast("date"))
    same = F.col(added).cast("date") == F.col("ingest_date") if added else F.lit(True)
    return out.withColumns({
        "cc_flag": F.when(F.col("ingest_date") <= as_date(business_date), "NC").when(same, "A").otherwise("C"),
        "run_date": as_date(run_date)})


def no_prospects(df: DataFrame) -> DataFrame:
    return df.filter("record_type <> 'PROSPECT' or record_type is null")


def household(households: DataFrame, business_date, run_date) -> DataFrame:
    return change_flag(no_prospects(households), business_date, run_date, "add_date")


# ---------------------------------------------------------------- customer

def plcc_dates(cards: DataFrame, on) -> DataFrame:
    """Latest past opening and closing of store cards per member."""
    past = lambda c: F.max(F.when(F.col(c) < as_date(on), F.col(c)))
    mine = cards.filter((F.col("card_type_key") == 1) & F.col("source_key").isin(8, 9))
    return mine.groupBy("member_key").agg(past("account_open_date").alias("plcc_open_date"), past("closed_date").alias("plcc_closed_date"))


def gender_pref(women: str, men: str) -> Column:
    w, m = F.col(women), F.col(men)
    return (F.when((m == 0) & (w > 0), "WO").when((w == 0) & (m > 0), "MO").when((w > 0) & (m > 0) & (w >= m), "DLW")
            .when((w > 0) & (m > 0) & (w < m), "DLM"))


def _visits(rows: DataFrame, place: str, names: list[str]) -> DataFrame:
    """The places of a member's first and second row by (visits of the place, date): row-wise,
    so both may be the same place, as in the reference."""
    rows, key = rows.select("member_key", "trxn_id", "trxn_date", place), ["member_key", place]
    if len(names) == 1:  # no row but the newest of a place can be the first: two aggregates find it
        newest_row = F.min(F.struct(newest("trxn_date").alias("day"), "trxn_id"))
        places = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), newest_row.alias("_last"))
        first = F.min(F.struct(-F.col("_n"), F.col("_last.day"), F.col(place).isNull(), F.col(place).alias("place"), F.col("_last.trxn_id")))
        return places.groupBy("member_key").agg(first.alias("_first")).select("member_key", F.col("_first.place").alias(names[0]))
    # a place can bring no more than its newest rows: all others are only counted
    last = latest_per_key(rows, key, [F.col("trxn_date").desc(), F.col("trxn_id")], n=len(names))
    counted = join_back(last, rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")), key)
    top = latest_per_key(counted, "member_key", [F.col("_n").desc(), F.col("trxn_date").desc(), F.col(place).asc_nulls_last(), F.col("trxn_id")],
                         n=len(names), rank_col="_r")
    return top.groupBy("member_key").agg(*[F.max(F.when(F.col("_r") == i + 1, F.col(place))).alias(n) for i, n in enumerate(names)])


def shopping(summary: DataFrame, orders: DataFrame, stores: DataFrame, on) -> DataFrame:
    """Per member: last store and web purchase, first purchase of the last 24 months,
    merchandise gender by units and spend, preferred store, primary and secondary store and
    dominant channel of the last 12 months."""
    day = as_date(on)
    one_order = orders.groupBy("trxn_id").agg(F.min(F.struct("order_date", "demandloc")).alias("o")).select("trxn_id", "o.*")
    place = stores.select("store_key", "store_id", "retail_web_flag", "open_closed_ind", "zone_code")
    rows = summary.join(one_order, "trxn_id", "left").join(broadcast_if_small(place), "store_key", "left")
    open_ = F.col("open_closed_ind") == "OPEN"
    kind = F.when(open_, F.col("retail_web_flag"))
    bought = F.coalesce("order_date", "trxn_date")
    real = F.when(F.upper("demandloc") != "NULL", F.col("demandloc"))
    rows = rows.withColumn("_place", F.when(kind == "RETAIL", F.coalesce(real, F.col("store_id").cast("string"))))
    recent = F.col("trxn_date") >= F.add_months(day, -12)
    totals = ["w_units", "m_units", "w_amount_after_discount", "m_amount_after_discount"]
    # one scan of the summary and the orders; all periods and places read these few columns
    rows = stage(rows.select("member_key", "trxn_id", "trxn_date", "_place", "zone_code", kind.alias("_kind"), bought.alias("_bought"), *totals))
    kind, bought = F.col("_kind"), F.col("_bought")
    sums = [F.sum(c).alias(f"_{c}") for c in totals]
    agg = rows.groupBy("member_key").agg(
        F.max(F.when(kind == "RETAIL", bought)).alias("last_store_trxn_date"), F.max(F.when(kind == "WEB", bought)).alias("last_web_trxn_date"),
        F.min(F.when(F.col("trxn_date") >= F.add_months(day, -24), F.col("trxn_date"))).alias("brand_first_trxn_date"), *sums)
    agg = agg.withColumns({"gender_merch_units": gender_pref("_w_units", "_m_units"),
                           "gender_merch_spend": gender_pref("_w_amount_after_discount", "_m_amount_after_discount")})
    agg = agg.drop("_w_units", "_m_units", "_w_amount_after_discount", "_m_amount_after_discount")
    channel = _visits(rows.filter(recent), "zone_code", ["_zone"]).select(
        "member_key", decode(F.col("_zone"), {8: "EFO", 6: "Ecomm", 1: "Retail", 2: "Retail"}).alias("dominant_shopping_channel"))
    return (agg.join(_visits(rows, "_place", ["preferred_store_id"]), "member_key", "left")
            .join(_visits(rows.filter(recent), "_place", ["primary_store_id", "secondary_store_id"]), "member_key", "left")
            .join(channel, "member_key", "left"))


def last_browse(visits: DataFrame, member: DataFrame, mail_ids: DataFrame) -> DataFrame:
    """Latest visit per member: by 13-character loyalty id, else by the id of the mailing system."""
    each = visits.select(F.trim("loyalty_id").alias("loyalty_id"), F.upper(F.trim("mail_id")).alias("mail_id"), "visit_date").distinct()
    cards = member.filter(F.length("loyalty_id") == 13).select(F.col("loyalty_id").alias("_l"), F.col("member_key").alias("_by_card"))
    ids = mail_ids.filter(is_not_empty(F.col("mme_id"))).select(F.col("mme_id").alias("_m"), F.col("member_key").alias("_by_mail")).distinct()
    found = each.join(cards, F.col("loyalty_id") == F.col("_l"), "left").join(ids, F.col("mail_id") == F.col("_m"), "left")
    return (found.withColumn("member_key", F.coalesce("_by_card", "_by_mail")).filter(F.col("member_key").isNotNull())
            .groupBy("member_key").agg(F.max("visit_date").alias("_browsed")))


def customer(member: DataFrame, summary: DataFrame, orders: DataFrame, stores: DataFrame, cards: DataFrame, visits: DataFrame, mail_ids: DataFrame,
             snapshot: DataFrame, business_date, run_date, on) -> DataFrame:
    """Customer extract; the last browse date is carried forward from the previous snapshot."""
    day = as_date(on)
    known = no_prospects(member)
    real = F.when((F.year("birth_date") > 1900) & (F.col("birth_date") <= day), F.col("birth_date"))
    out = known.withColumn("birth_date", real).withColumn("customer_age", age_years(F.col("birth_date"), on))
    out = out.withColumn("customer_age_qualifier", F.when(F.col("customer_age") > 0, "X").otherwise("U"))
    out = out.join(plcc_dates(cards, on), "member_key", "left").join(shopping(summary, orders, stores, on), "member_key", "left")
    where = stores.select(F.col("store_id").cast("string").alias("_sid"), F.col("latitude").alias("_slat"), F.col("longitude").alias("_slon"), "district_code", "open_closed_ind")
    out = out.join(broadcast_if_small(where), F.col("preferred_store_id") == F.col("_sid"), "left")
    miles = haversine_miles(F.col("_slat"), F.col("_slon"), F.col("latitude"), F.col("longitude"))
    out = out.withColumn("distance_to_preferred_store", F.when(F.col("district_code") == WEB_DISTRICT, F.lit(-1.0))
                         .when(F.col("open_closed_ind") == "OPEN", miles)).drop("_sid", "_slat", "_slon", "district_code", "open_closed_ind")
    out = out.join(last_browse(visits, known, mail_ids), "member_key", "left")
    out = out.join(snapshot.select("member_key", F.col("last_browse_date").alias("_before")), "member_key", "left")
    store, web = F.col("last_store_purch_date"), F.col("last_web_purch_date")
    out = out.withColumns({
        "last_browse_date": F.coalesce("_browsed", "_before"), "last_trxn_date": F.when(store.isNull() | (store < web), web).otherwise(store),
        "gender": decode(F.upper(F.trim("gender")), {"M": "MALE", "F": "FEMALE", "U": "UNKNOWN", "FEMALE": "FEMALE", "MALE": "MALE", "UNKNOWN": "UNKNOWN"})})
    return change_flag(out.drop("_browsed", "_before"), business_date, run_date, "customer_add_date")


# ---------------------------------------------------------------- transactions

def order_reference(ref: Column) -> dict[str, Column]:
    """Store, date, register and number packed in an order's transaction id: 8 characters
    store, 8 date, 10 register, and 6 number from the 28th on."""
    bare = lambda a, n: F.trim(F.regexp_replace(F.substring(ref, a, n), "^0*", ""))
    number = lambda a, n: F.when(F.length(bare(a, n)) == 0, "0").otherwise(bare(a, n))
    return {"ref_store": bare(1, 8), "ref_date": F.concat_ws("-", F.substring(ref, 9, 4), F.substring(ref, 13, 2), F.substring(ref, 15, 2)),
            "ref_register": number(17, 10), "ref_number": number(28, 6)}


def invoices(orders: DataFrame) -> DataFrame:
    one = latest_per_key(orders, "id_trn", [newest("ingest_date"), F.col("invoicenumber")])
    parts = one.select("invoicenumber", *[v.alias(k) for k, v in order_reference(F.col("id_trn")).items()])
    return parts.groupBy("ref_store", "ref_date", "ref_register", "ref_number").agg(F.min("invoicenumber").alias("invoicenumber"))


def demand_store(store: Column, demand: Column) -> Column:
    """The ordering location replaces the store unless it is empty or the text null."""
    return F.when(is_not_empty(demand) & (F.upper(demand) != "NULL"), demand).otherwise(store)


def yes_no(c: Column) -> Column:
    return normalize_flag(c, {"y": "YES", "n": "NO", "yes": "YES", "no": "NO"})


def transactions(rows: DataFrame, translation: DataFrame, orders: DataFrame, stores: DataFrame, business_date, run_date, gift_flag: str) -> DataFrame:
    """Transaction detail and summary extracts: store id, order id, invoice, demand location.
    Needs the columns trxn_id, trxn_date, store_key, register_nbr, trxn_nbr."""
    fresh = after_business_date(rows, business_date).withColumn(gift_flag, yes_no(F.col(gift_flag)))
    ids = broadcast_if_small(stores.select("store_key", F.col("store_id").cast("string").alias("store_id")))
    out = fresh.join(ids, "store_key", "left")
    one = translation.groupBy("trxn_id").agg(F.min(F.struct("exp_order_id", "demandloc")).alias("t")).select("trxn_id", "t.*")
    out = out.join(one, "trxn_id", "left")
    out = out.join(invoices(orders), (F.col("trxn_date").cast("string") == F.col("ref_date")) & (F.col("store_id") == F.col("ref_store"))
                   & (F.col("register_nbr").cast("string") == F.col("ref_register")) & (F.col("trxn_nbr").cast("string") == F.col("ref_number")), "left")
    out = out.withColumn("store_id", demand_store(F.col("store_id"), F.col("demandloc"))).drop("ref_store", "ref_date", "ref_register", "ref_number", "demandloc")
    return change_flag(out, business_date, run_date, "last_updated_date")


def dedup_map(history: DataFrame, business_date, run_date) -> DataFrame:
    valid = after_business_date(history.filter("not is_invalid"), business_date)
    return change_flag(valid, business_date, run_date, "last_updated_date").select(
        "old_member_key", "new_member_key", "ingest_date", "cc_flag", "run_date")


def dedup_transactions(lines: DataFrame, history: DataFrame, stores: DataFrame, translation: DataFrame, business_date, run_date) -> DataFrame:
    """Transactions of members that took over other members."""
    touched = stage(after_business_date(history.filter("not is_invalid"), business_date)
                    .groupBy(F.col("new_member_key").alias("member_key")).agg(F.max("last_updated_date").alias("last_updated_date")))
    # lines of other members go before the distinct, which shuffles all that is left
    heads = (lines.select("member_key", "trxn_id", "trxn_date", "store_key", "register_nbr", "trxn_nbr")
             .join(broadcast_if_small(touched), "member_key").distinct())
    order = latest_per_key(translation, "trxn_id", [newest("ingest_date"), F.col("exp_order_id")]).select("trxn_id", "exp_order_id")
    out = (heads.join(broadcast_if_small(stores.select("store_key", "store_id")), "store_key", "left")
           .join(order, "trxn_id", "left")
           .select("member_key", "trxn_date", "store_id", "trxn_nbr", "exp_order_id", "register_nbr", "last_updated_date").distinct())
    return change_flag(out, business_date, run_date, "last_updated_date")


# ---------------------------------------------------------------- lookups and feeds

# ---- fixed values: lookup extracts -----------------------------------------------------
LOOKUPS = {
    "discount_type": ("status = 'current'", ["discount_type_key", "discount_type_code", "discount_deal_code", "discount_type_description"]),
    "loyalty": ("status = 'current'", ["tier_key", "tier_name"]),
    "scoring_model": ("status = 'current'", ["scoring_model_key", "model_id", "model_description"]),
    "scoring_model_segment": ("status = 'current'", ["scoring_model_segment_key", "model_id", "segment_rank"]),
    "transaction_type": ("status = 'current'", ["transaction_type_key", "lbi_trxn_line_type_code"]),
}


def lookup(df: DataFrame, where: str, columns: list[str], run_date) -> DataFrame:
    return df.filter(where).select(*columns).withColumn("run_date", as_date(run_date))


def _newest_run(df: DataFrame) -> DataFrame:
    """Rows of the newest run date, found by a one-row aggregate that is joined back."""
    return df.join(F.broadcast(df.agg(F.max("run_date").alias("run_date"))), "run_date", "left_semi")


def feed(extract: DataFrame, constants: DataFrame, codes: dict, clean: list[str], columns: list[str], start, end=None, order: str = "ingest_date") -> DataFrame:
    """Rows of a run date (or range of dates): codes to constant ids (-1 if unknown) from the
    newest constants, delimiter and null texts removed, ordered by ingest date."""
    run = F.col("run_date")
    rows = extract.filter(run.between(as_date(start), as_date(end)) if end else run == as_date(start))
    out = constant_domain(rows, _newest_run(constants), codes, fill=-1) if codes else rows
    out = null_text_to_empty(strip_delimiter(out, clean), clean) if clean else out
    return out.select(*columns).orderBy(order)


def snapshot_feed(extract: DataFrame, clean: list[str], columns: list[str], run_date) -> DataFrame:
    """Newest snapshot of a lookup extract, stamped with the feed's date."""
    rows = _newest_run(extract).withColumn("run_date", as_date(run_date))
    return (null_text_to_empty(strip_delimiter(rows, clean), clean) if clean else rows).select(*columns)


@dataclass(frozen=True)
class FeedShape:
    """How an extract becomes a feed: coded columns with their constant type (and default),
    columns cleaned of the delimiter, columns of the feed (None: the extract's own, as stored).
    A snapshot is fed whole from its newest run, others by run date."""

    codes: dict = field(default_factory=dict)
    clean: tuple[str, ...] = ()
    columns: tuple[str, ...] | None = None
    snapshot: bool = False


# ---- fixed values: the twelve feeds ------------------------------------------------------
FEEDS = {
    "household": FeedShape({"is_express_plcc": ["FLAG"], "valid_address": ["VALID ADDRESS"], "record_type": ["RECORD TYPE"]}, ("zip_code",), (
        "household_key", "member_count", "first_trxn_date", "is_express_plcc", "add_date", "introduction_date", "last_store_purch_date", "last_web_purch_date",
        "account_open_date", "zip_code", "scoring_model_key", "scoring_model_segment_key", "valid_address", "record_type", "associated_member_key",
        "ingest_date", "cc_flag", "run_date")),
    "customer": FeedShape({
        "valid_strict": ["FLAG"], "valid_loose": ["FLAG"], "valid_email": ["FLAG"], "valid_phone_for_sms": ["FLAG"], "phone_type": ["PHONE TYPE", "UNKNOWN"],
        "gender": ["GENDER", "UNKNOWN"], "direct_mail_consent": ["FLAG", "UNKNOWN"], "email_consent": ["FLAG", "UNKNOWN"], "sms_consent": ["FLAG", "UNKNOWN"],
        "deceased": ["FLAG", "UNKNOWN"], "address_is_prison": ["FLAG", "UNKNOWN"], "is_express_plcc": ["FLAG"], "ads_do_not_statement_insert": ["ADS_DO_NOT_INSERT"],
        "ads_do_not_sell_name": ["ADS_DO_NOT_SELL"], "ads_spam_indicator": ["ADS_SPAM_INDICATOR"], "ads_return_mail_ind": ["ADS_RETURN_MAIL_INDICATOR"],
        "gender_merch_units": ["GENDER PREF"], "gender_merch_spend": ["GENDER PREF"], "customer_age_qualifier": ["AGE QUALIFIER"], "is_dm_marketable": ["FLAG"],
        "is_em_marketable": ["FLAG"], "is_sms_marketable": ["FLAG"], "record_type": ["RECORD TYPE"], "preferred_channel": ["CHANNEL"],
        "dominant_shopping_channel": ["CHANNEL"], "is_loyalty_member": ["FLAG"], "tier_name": ["LOTALTY TIER"], "member_status": ["LOYALTY STATUS", "UNKNOWN"]}, (
        "first_name", "last_name", "address1", "address2", "city", "state", "zip_code", "zip4", "first_name_scrubbed", "last_name_scrubbed", "address1_scrubbed",
        "address2_scrubbed", "city_scrubbed", "state_scrubbed", "zip_code_scrubbed", "zip4_scrubbed", "zip_full_scrubbed", "non_us_postal_code", "country_code",
        "country_code_scrubbed", "email_address")),
    "transaction_detail": FeedShape({"is_shipping_cost": ["FLAG"], "markdown_type": ["MARKDOWN TYPE"], "gift_card_sales_ind": ["FLAG"], "post_void_ind": ["INDICATOR"]}),
    "transaction_summary": FeedShape({"has_tender": ["FLAG"], "has_detail": ["FLAG"], "gift_card_sales_only_ind": ["FLAG"], "enrollment_trxn_flag": ["FLAG"]}),
    "constants": FeedShape(columns=("constant_id", "constant_value", "constant_desc", "constant_type", "run_date"), snapshot=True),
    "customer_dedup_mtx": FeedShape(columns=("old_member_key", "new_member_key", "customer_deduped_date", "cc_flag", "run_date")),
    "customer_dedup_txn_mtx": FeedShape(columns=(
        "member_key", "trxn_date", "store_id", "trxn_nbr", "exp_order_id", "register_nbr", "dedupe_run_date", "cc_flag", "run_date")),
    "lkp_source": FeedShape(clean=("source_description",), snapshot=True),
    "lkp_scoring_model": FeedShape(snapshot=True),
    "lkp_scoring_model_segment": FeedShape(columns=(
        "scoring_model_segment_key", "model_id", "segment_type", "segment_rank", "segment_description", "segment_grouping", "segment_grouping_rank",
        "segment_in_use", "run_date"), snapshot=True),
    "lkp_transaction_type": FeedShape(snapshot=True),
    "lkp_discount_type": FeedShape(columns=(
        "discount_type_key", "discount_type_code", "discount_deal_code", "discount_type_description", "discount_deal_description", "data_source", "run_date"), snapshot=True),
}


def export_feed(name: str, extract: DataFrame, constants: DataFrame, start, end=None, order: str = "ingest_date") -> DataFrame:
    """One of the twelve feeds from its extract. Coded and cleaned columns that an extract of the
    feed does not have are left out; a feed with columns of its own needs all of them."""
    shape = FEEDS[name]
    columns = list(shape.columns or extract.columns)
    clean = [c for c in shape.clean if c in extract.columns]
    if shape.snapshot:
        return snapshot_feed(extract, clean, columns, start)
    codes = {c: kind for c, kind in shape.codes.items() if c in extract.columns}
    return feed(extract, constants, codes, clean, columns, start, end, order if order in columns else columns[0])


def validate_household(df: DataFrame) -> DataFrame:
    is_ = lambda v: F.count_if(F.upper(F.trim("valid_address")) == v)
    keys = df.groupBy("household_key").agg(is_("STRICT").alias("s"), is_("LOOSE").alias("l"))
    return keys.agg(F.count("household_key").alias("distinct_household_count"), F.sum("s").alias("valid_address_strict"), F.sum("l").alias("valid_address_loose"))


def validate_customer(df: DataFrame) -> DataFrame:
    keys = df.groupBy("member_key").agg(
        F.count("loyalty_id").alias("l"), F.count_if(F.upper(F.trim("member_status")) == "ACTIVE").alias("a"),
        F.count_if(F.upper(F.trim("is_plcc")) == "YES").alias("y"), F.count_if(F.upper(F.trim("is_plcc")) == "NO").alias("n"))
    return keys.agg(F.count("member_key").alias("distinct_member_count"), F.sum("l").alias("loyalty_records_count"), F.sum("a").alias("active_records_count"),
                    F.sum("y").alias("plcc_records_yes"), F.sum("n").alias("plcc_records_no"))
