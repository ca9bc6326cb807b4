"""Member and household enrichment: every step adds columns from a frame with one row per member."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..codes import UNKNOWN_KEY
from ..functions.dates import as_date
from ..functions.geo import haversine_miles
from ..functions.text import is_not_empty
from ..operators.columns import key_defaults
from ..operators.joins import update_keys
from ..operators.nearest import nearest_stores
from ..operators.ranking import largest, latest_per_key, mark_best, newest, with_key_aggregates, yes_first
from ..operators.rewrite import read_by_key, rewrite_keys
from ..operators.sizing import broadcast_if_small
from ..operators.skew import left_join_known
from ..operators.staging import stage
from .facts import WEB_DISTRICT

# ---------------------------------------------------------------- contacts


def _up(c: str) -> Column:
    return F.upper(F.trim(F.col(c)))


def best_email(member: DataFrame, emails: DataFrame) -> DataFrame:
    """Copy the best e-mail of each member; action_flag NC if nothing changes, else U."""
    best = latest_per_key(emails.filter("best_email_flag = 'YES'"), "member_key", [newest("consent_date"), F.col("email_address")])
    best = best.select("member_key", F.col("email_address").alias("_mail"), F.col("valid_email").alias("_valid"),
                       F.col("email_consent").alias("_consent"), F.col("consent_date").alias("_date"))
    out = member.join(best, "member_key", "left")
    same = ((_up("valid_email") == _up("_valid")) & (_up("email_address") == _up("_mail"))
            & (_up("email_consent") == _up("_consent")) & (F.col("email_consent_date") == F.col("_date")))
    yes = lambda c: F.when(_up(c) == "YES", "YES").otherwise("NO")
    return out.withColumns({
        "action_flag": F.when(same, "NC").otherwise("U"), "valid_email": yes("_valid"), "email_consent": yes("_consent"),
        "email_address": F.coalesce("_mail", "email_address"), "email_consent_date": F.coalesce("_date", "email_consent_date")}
    ).drop("_mail", "_valid", "_consent", "_date")


def marketability(member: DataFrame) -> DataFrame:
    any_of = lambda *names: F.coalesce(*[F.when(is_not_empty(F.col(n)), F.lit(True)) for n in names if n in member.columns], F.lit(False))
    dm = any_of("address1", "address1_scrubbed") & any_of("last_name", "last_name_scrubbed") & any_of("zip_code", "zip_code_scrubbed")
    em = (_up("valid_email") == "YES") & (_up("email_consent") == "YES")
    return member.withColumns({"is_dm_marketable": F.when(dm, "YES").otherwise("NO"), "is_em_marketable": F.when(em, "YES").otherwise("NO")})


# fixed values: sources that keep a member's record type, and source codes of requests
APPEND_SOURCES = [2229, 1236, 1237, 1064, 1065]
REQUEST_CODES = ["ADOBE", "3C"]


def audience(member: DataFrame, lines: DataFrame, sources: DataFrame, visits: DataFrame | None = None) -> DataFrame:
    """Buyers are customers if marketable (or already so), else purchasers; others by the kind
    of their source."""
    buyers = (lines if visits is None else visits).select("member_key").distinct().withColumn("_bought", F.lit(True))
    src = broadcast_if_small(sources.select(F.col("source_key").alias("current_source_key"), "source_code", "is_prospect", "is_mail_request", "is_sms_request"))
    yes = lambda c: F.coalesce(_up(c) == "YES", F.lit(False))
    marketable = yes("is_dm_marketable") | yes("is_em_marketable") | yes("is_sms_marketable")
    kind = F.col("record_type")
    buyer = F.when(marketable, "CUSTOMER").when(kind == "CUSTOMER", kind).otherwise("PURCHASER")
    other = (F.when(kind.isin("CUSTOMER", "PURCHASER"), kind).when(F.col("is_prospect") == "YES", "PROSPECT")
             .when((F.col("is_mail_request") == "YES") | (F.col("is_sms_request") == "YES") | F.col("source_code").isin(REQUEST_CODES), "REQUESTER")
             .when(F.col("current_source_key").isin(APPEND_SOURCES) | (kind == "REQUESTER"), kind).otherwise("RECORD"))
    out = member.join(buyers, "member_key", "left").join(src, "current_source_key", "left")
    return (out.withColumn("record_type", F.when(F.col("_bought"), buyer).otherwise(other))
            .drop("_bought", "source_code", "is_prospect", "is_mail_request", "is_sms_request"))


def phone(member: DataFrame, phones: DataFrame) -> DataFrame:
    """Best mobile of each member."""
    best = latest_per_key(phones.filter("best_mobile_flag = 'YES'"), "member_key", [newest("consent_date"), F.col("phone_number")])
    best = best.select("member_key", F.col("phone_number").alias("phone_nbr"), "phone_type", F.col("phone_consent").alias("sms_consent"),
                       F.col("consent_date").alias("sms_consent_date"))
    return member.drop(*best.columns[1:]).join(best, "member_key", "left")


def sms(member: DataFrame, phones: DataFrame) -> DataFrame:
    """Marketable by text if any phone consents; one row per member however many phones do."""
    yes = phones.filter(F.lower(F.trim("phone_consent")) == "yes").select("member_key").distinct().withColumn("_sms", F.lit("YES"))
    return member.join(yes, "member_key", "left").withColumn("is_sms_marketable", F.coalesce("_sms", F.lit("NO"))).drop("_sms")


def dm_consent(member: DataFrame, consents: DataFrame) -> DataFrame:
    """Latest direct mail consent; the date moves only when the value does."""
    last = latest_per_key(consents.filter("consent_type = 'DM'"), "member_key", [newest("consent_date"), F.col("consent_value")])
    last = last.select("member_key", F.col("consent_value").alias("_v"), F.col("consent_date").alias("_d"))
    out = member.join(last, "member_key", "left")
    same = F.coalesce(_up("direct_mail_consent") == _up("_v"), F.lit(False))
    return out.withColumns({
        "direct_mail_consent": F.when(same, F.upper("direct_mail_consent")).otherwise(F.col("_v")),
        "direct_mail_consent_date": F.when(same, F.col("direct_mail_consent_date")).otherwise(F.col("_d"))}).drop("_v", "_d")


# ---------------------------------------------------------------- purchases

def member_visits(lines: DataFrame) -> DataFrame:
    """One row per member and store: trips, spend, first and last date. All that enrichment
    asks of purchases but their products follows from it, so the lines are read once."""
    # per trip first: the distinct count of trips is then a plain count that combines
    trips = lines.groupBy("member_key", "store_key", "trxn_id").agg(
        F.sum("retail_amount").alias("spend"), F.min("trxn_date").alias("first"), F.max("trxn_date").alias("last"),
        F.max(F.col("trxn_date").isNull()).alias("undated"))
    return trips.groupBy("member_key", "store_key").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("spend").alias("spend"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.max("undated").alias("undated"))


def trxn_flags(member: DataFrame, lines: DataFrame, stores: DataFrame, visits: DataFrame | None = None) -> DataFrame:
    """First purchase with its store, last store and last web purchase: one aggregate. A
    purchase without a date comes before all others."""
    web = F.col("district_code") == WEB_DISTRICT
    seen = member_visits(lines) if visits is None else visits
    with_store = seen.filter(F.col("member_key") > 0).join(broadcast_if_small(stores.select("store_key", "district_code")), "store_key", "left")
    first = F.min(F.struct(F.when(~F.col("undated"), F.col("first")).alias("trxn_date"), "store_key"))
    agg = with_store.groupBy("member_key").agg(
        first["trxn_date"].alias("_first"), first["store_key"].alias("_store"),
        F.max(F.when(web, F.col("last"))).alias("_web"), F.max(F.when(~F.coalesce(web, F.lit(False)), F.col("last"))).alias("_shop"))
    return member.join(agg, "member_key", "left").withColumns({
        "first_trxn_date": F.coalesce("_first", "first_trxn_date"), "first_trxn_store_key": F.coalesce("_store", "first_trxn_store_key"),
        "last_store_purch_date": F.coalesce("_shop", "last_store_purch_date"), "last_web_purch_date": F.coalesce("_web", "last_web_purch_date")}
    ).drop("_first", "_store", "_web", "_shop")


def gender_merch(member: DataFrame, lines: DataFrame, products: DataFrame) -> DataFrame:
    """Merchandise gender of a member: one gender only MO or WO, else the larger DLM or DLW
    (tie DLW). Lines without a product are left out; the reference's own test for them is
    always true."""
    goods = products.filter(F.col("gender").isNotNull()).select("product_key", "gender")
    each = lines.filter((F.col("product_key") != 0) & (F.col("product_key") != UNKNOWN_KEY)).select("member_key", "trxn_id", "trxn_date", "product_key").distinct()
    agg = each.join(broadcast_if_small(goods), "product_key").groupBy("member_key").agg(
        F.count_if(F.col("gender") == "M").alias("_m"), F.count_if(F.col("gender") == "W").alias("_w"),
        F.count(F.lit(1)).alias("_n"))
    single = F.when((F.col("_m") == F.col("_n")), "MO").when((F.col("_w") == F.col("_n")), "WO")
    agg = agg.withColumn("cm_gender_merch_descr", F.coalesce(single, F.when(F.col("_m") > F.col("_w"), "DLM").otherwise("DLW")))
    return member.drop("cm_gender_merch_descr").join(agg.select("member_key", "cm_gender_merch_descr"), "member_key", "left")


def preferred_store(member: DataFrame, lines: DataFrame, stores: DataFrame, visits: DataFrame | None = None) -> DataFrame:
    """Open store with most trips, then spend, then the latest visit, then the smallest key."""
    seen = member_visits(lines) if visits is None else visits
    known = seen.filter((F.col("member_key") != UNKNOWN_KEY) & (F.col("store_key") != UNKNOWN_KEY))
    open_ = stores.filter("open_closed_ind = 'OPEN'").select("store_key", "retail_web_flag")
    best = latest_per_key(known.join(broadcast_if_small(open_), "store_key"), "member_key",
                          [F.col("trips").desc(), F.col("spend").desc(), F.col("last").desc(), F.col("store_key")])
    best = best.select("member_key", F.col("store_key").alias("preferred_store_key"), F.col("retail_web_flag").alias("preferred_channel"))
    return member.drop("preferred_store_key", "preferred_channel").join(best, "member_key", "left")


def store_distance(member: DataFrame, stores: DataFrame, located: DataFrame | None = None) -> DataFrame:
    """Distance to the preferred store (web -1, closed or unknown null) and the two nearest open
    stores. `located` may give the members' coordinates from a plain table, so that the search
    does not run the earlier steps again."""
    s = stores.select(F.col("store_key").alias("_sk"), F.col("latitude").alias("_slat"), F.col("longitude").alias("_slon"), "district_code", "open_closed_ind")
    out = member.join(broadcast_if_small(s), F.col("preferred_store_key") == F.col("_sk"), "left")
    miles = haversine_miles(F.col("_slat"), F.col("_slon"), F.col("latitude"), F.col("longitude"))
    out = out.withColumn("distance_to_preferred_store", F.when(F.col("district_code") == WEB_DISTRICT, F.lit(-1.0))
                         .when(F.col("open_closed_ind") == "OPEN", miles)).drop("_sk", "_slat", "_slon", "district_code", "open_closed_ind")
    near = nearest_stores(located if located is not None else member, stores.filter("open_closed_ind = 'OPEN'")).withColumnsRenamed({
        "distance": "distance_to_closest_store", "second_distance": "distance_to_sec_closest_store"})
    return out.drop(*near.columns[1:]).join(near, "member_key", "left")


def store_states(member: DataFrame, web_stores: list[int]) -> DataFrame:
    """State of the three store distances."""
    key, dist = F.col("preferred_store_key"), F.col("distance_to_preferred_store")
    no_lat, no_lon = F.col("latitude").isNull(), F.col("longitude").isNull()
    web = key.isin(web_stores)
    preferred = (F.when(web & (dist == -1), "E-COMMERCE").when((key > -1) & ~web & (dist > -1), "CALCULATED")
                 .when((key == -1) & dist.isNull() & no_lat & no_lon, "NO PREFERRED STORE")
                 .when((key > -1) & dist.isNull() & (no_lat | no_lon), "CANNOT MEASURE").otherwise("(RE)CALCULATE"))

    def near(k: str, d: str) -> Column:
        k, d = F.col(k), F.col(d)
        return (F.when((k > -1) & d.isNotNull(), "CALCULATED").when((k == -1) & (d == -1), "OUTSIDE RANGE")
                .when((k == -1) & d.isNull() & (no_lat | no_lon), "CANNOT MEASURE").otherwise("(RE)CALCULATE"))

    return member.withColumns({
        "preferred_store_state": preferred, "closest_store_state": near("closest_store_key", "distance_to_closest_store"),
        "second_closest_store_state": near("second_closest_store_key", "distance_to_sec_closest_store")})


# ---------------------------------------------------------------- household and loyalty

def household(member: DataFrame, household_members: DataFrame) -> DataFrame:
    """Household of each member, -1 without one. Takes (household_key, member_key) rows."""
    one = household_members.groupBy("member_key").agg(F.min("household_key").alias("_h"))
    return (member.join(one, "member_key", "left")
            .withColumn("household_key", F.coalesce("_h", F.lit(UNKNOWN_KEY).cast("bigint"))).drop("_h"))


def best_household(member: DataFrame, scoring: DataFrame, lines: DataFrame, visits: DataFrame | None = None,
                   homes: DataFrame | None = None) -> DataFrame:
    """The member of a household with the lowest latest segment (none counts 99), then the
    latest purchase, then the smallest key. `homes` may give the members' households as a
    narrow frame, so that the picks do not run the earlier steps again."""
    scored = latest_per_key(scoring.filter((F.col("household_key") != UNKNOWN_KEY) & (F.col("member_key") != UNKNOWN_KEY)),
                            "member_key", [newest("last_updated_date"), F.col("segment_rank")])
    rank = F.when(F.col("segment_rank") > 0, F.col("segment_rank")).otherwise(99)
    seen = member_visits(lines) if visits is None else visits
    last = seen.groupBy("member_key").agg(F.max("last").alias("_last"))
    known = ((member if homes is None else homes).select("member_key", "household_key").join(scored.select("member_key", rank.alias("_rank")), "member_key")
             .join(last, "member_key", "left"))
    best = known.groupBy("household_key").agg(F.min(F.struct("_rank", newest("_last"), "member_key"))["member_key"].alias("member_key"))
    return (member.join(best.select("member_key").withColumn("_best", F.lit("YES")), "member_key", "left")
            .withColumn("best_household_member", F.coalesce("_best", F.lit("NO"))).drop("_best"))


def loyalty_flag(member: DataFrame) -> DataFrame:
    return member.withColumn("is_loyalty_member", F.when(is_not_empty(F.col("loyalty_id")), "YES").otherwise("NO"))


def global_opt_out(member: DataFrame, kill_list: DataFrame, homes: DataFrame | None = None) -> DataFrame:
    """YES for members of a household on the kill list. With `homes`, the members' households as
    a narrow frame, only that is shuffled by household and the members stay where they are."""
    out = kill_list.filter(F.col("household_key").isNotNull() & (F.col("household_key") != UNKNOWN_KEY)).select("household_key").distinct()
    known, yes = F.col("household_key").isNotNull() & (F.col("household_key") != UNKNOWN_KEY), F.lit("YES").alias("global_opt_out")
    if homes is None:
        marked = left_join_known(member.drop("global_opt_out"), out.select("household_key", yes), ["household_key"], known, ["member_key"])
    else:
        gone = homes.filter(known).join(out, "household_key", "left_semi").select("member_key", yes)
        marked = member.drop("global_opt_out").join(gone, "member_key", "left")
    return marked.select(*[c for c in member.columns if c != "global_opt_out"], "global_opt_out")


def tier(member: DataFrame, tier_history: DataFrame, tiers: DataFrame) -> DataFrame:
    last = latest_per_key(tier_history.filter(F.col("member_key").isNotNull() & (F.col("member_key") != UNKNOWN_KEY)), "member_key",
                          [F.col("id").desc(), newest("tier_begin_date")])
    named = last.select("member_key", F.col("tier_key").alias("current_tier_key")).join(
        broadcast_if_small(tiers.select(F.col("tier_key").alias("current_tier_key"), "tier_name")), "current_tier_key", "left")
    name = F.col("tier_name")
    named = named.withColumn("tier_name", F.when(is_not_empty(name) & (F.trim(name) != "N/A"), name))
    return member.drop("current_tier_key", "tier_name").join(named, "member_key", "left")


# fixed values: card feeds and card types that count as the store card
PLCC_SOURCES, PLCC_TYPES = [8, 9, 300], [1, 25, 2]


def plcc(member: DataFrame, cards: DataFrame, on) -> DataFrame:
    """YES if requested, or if any card is open in its latest row, else NO."""
    mine = cards.filter(F.col("source_key").isin(PLCC_SOURCES) & F.col("card_type_key").isin(PLCC_TYPES))
    last = latest_per_key(mine, ["member_key", "tokenized_cc_nbr"], [newest("last_updated_date"), F.col("card_type_key")])
    open_ = (F.col("closed_date").isNull() | (F.col("closed_date") > as_date(on))) & F.col("is_primary_account_holder").isNotNull()
    any_open = last.groupBy("member_key").agg(F.max(open_).alias("_open"))
    return member.join(any_open, "member_key", "left").withColumn(
        "is_plcc", F.when(F.coalesce(F.col("is_plcc_request") == "YES", F.lit(False)) | F.coalesce("_open", F.lit(False)), "YES").otherwise("NO")).drop("_open")


# fixed values: member status texts
MEMBER_STATUS = {1: "ACTIVE", 2: "CANCELED", 3: "CLOSED", 4: "LOCKED", 5: "UNKNOWN", 6: "MERGED"}


def member_status(c: Column) -> Column:
    text = F.upper(F.trim(c.cast("string")))
    out = None
    for code, name in MEMBER_STATUS.items():
        out = (F if out is None else out).when(text.isin(str(code), name), name)
    return out


# columns of the stored member that the steps may change
ENRICHED = ["valid_email", "email_address", "email_consent", "email_consent_date", "phone_nbr", "phone_type", "sms_consent", "sms_consent_date",
            "direct_mail_consent", "direct_mail_consent_date", "is_dm_marketable", "is_em_marketable", "is_sms_marketable", "record_type",
            "first_trxn_date", "first_trxn_store_key", "last_store_purch_date", "last_web_purch_date", "preferred_store_key", "preferred_channel",
            "household_key", "best_household_member", "is_loyalty_member", "global_opt_out", "cm_gender_merch_descr", "current_tier_key",
            "tier_name", "is_plcc", "member_status"]


def enrich_member(member, emails, phones, consents, lines, stores, products, sources, household_members, scoring, kill_list,
                  tier_history, tiers, cards, dates, date_columns, web_stores, on) -> DataFrame:
    """All steps in their fixed order. Each one joins to a frame with one row per member, and
    no step reads the wide member twice. The purchase lines are read twice: once for visits, which are written and shared by four
    steps, and once for products.

    action_flag is U if any stored column has changed at the end, compared null-safe, else NC.
    """
    visits = stage(member_visits(lines))
    stored = [c for c in ENRICHED if c in member.columns]
    out = best_email(member.withColumn("_stored", F.struct(*stored)), emails)
    out = phone(out, phones)
    out = dm_consent(out, consents)
    out = marketability(out)
    out = trxn_flags(out, lines, stores, visits)
    out = preferred_store(out, lines, stores, visits)
    out = store_distance(out, stores, member)
    out = store_states(out, web_stores)
    out = household(out, household_members)
    homes = household(member.select("member_key"), household_members)
    out = best_household(out, scoring, lines, visits, homes)
    out = loyalty_flag(out)
    out = global_opt_out(out, kill_list, homes)
    out = gender_merch(out, lines, products)
    out = sms(out, phones)
    out = audience(out, lines, sources, visits)
    out = tier(out, tier_history, tiers)
    out = plcc(out, cards, on)
    out = update_keys(out, date_columns, dates, "sdate", "date_key")
    out = out.withColumn("member_status", member_status(F.col("member_status")))
    same = F.lit(True)
    for c in stored:
        same = same & F.col(c).eqNullSafe(F.col("_stored")[c])
    return out.withColumn("action_flag", F.when(same, "NC").otherwise("U")).drop("_stored")


def household_segment(households: DataFrame, scoring: DataFrame, segments: DataFrame, models: DataFrame, member: DataFrame) -> DataFrame:
    """Segment and model of the household's best rank; its record type if all members share one.
    Of several models the one with the largest key counts."""
    best = (scoring.filter(F.col("segment_rank").isNotNull() & F.col("member_key").isNotNull()).groupBy("household_key")
            .agg(F.min("segment_rank").alias("segment_rank")))
    best = best.join(broadcast_if_small(segments.select("segment_rank", F.col("scoring_model_segment_key").alias("_seg"))), "segment_rank", "left")
    kinds = (member.filter(F.col("household_key") != UNKNOWN_KEY).groupBy("household_key")
             .agg(F.min("record_type").alias("_kind"), F.max("record_type").alias("_other")))
    model = models.agg(F.max("scoring_model_key").alias("_model"))  # one row
    out = households.drop("record_type", "scoring_model_segment_key").join(kinds, "household_key", "left").join(best, "household_key", "left").join(F.broadcast(model))
    return out.withColumns({
        "record_type": F.when(F.col("_kind") == F.col("_other"), F.col("_kind")), "scoring_model_segment_key": F.col("_seg"),
        "scoring_model_key": F.when(F.col("_seg").isNotNull(), F.col("_model"))}).drop("_kind", "_other", "_seg", "_model", "segment_rank")


# ---------------------------------------------------------------- e-mails

# fixed values: delivery results
FAILED, HARD_REASONS, SOFT_REASONS = "2", ["1"], ["2", "3", "4", "5", "20"]
OPENED = "2"


def email_bounce(emails: DataFrame, deliveries: DataFrame) -> DataFrame:
    """no_hard_bounce and no_soft_bounce from the first stored delivery per member and address."""
    first = latest_per_key(deliveries, ["member_key", "email_address"], [F.col("fact_delivery_data_id"), newest("event_date")])
    side = first.select("member_key", "email_address", F.col("status").cast("string").alias("_st"), F.col("failure_reason").cast("string").alias("_why"))
    out = emails.join(side, ["member_key", "email_address"], "left")
    bounced = lambda reasons: F.coalesce((F.col("_st") == FAILED) & F.col("_why").isin(reasons), F.lit(False))
    return out.withColumns({"no_hard_bounce": F.when(bounced(HARD_REASONS), "NO").otherwise("YES"),
                            "no_soft_bounce": F.when(bounced(SOFT_REASONS), "NO").otherwise("YES")}).drop("_st", "_why")


EMAIL_CRITERIA = ["email_consent", "valid_email", "no_hard_bounce", "no_soft_bounce", "recently_opened_flag",
                  "recent_email_consent_flag", "most_opened_12_months"]


def email_flags(emails: DataFrame, deliveries: DataFrame, clicks: DataFrame, on) -> DataFrame:
    """The seven yes/no criteria of the best-address choice.

    "Recently opened" and "recent consent" are YES for rows that share the newest click date,
    or the newest (consent date, address), of their member with another row.
    """
    out = email_bounce(emails, deliveries)
    click = latest_per_key(clicks, ["member_key", "email_address"], [F.col("fact_click_data_id").desc()]).select(
        "member_key", "email_address", "log_date", F.col("url_type").cast("string").alias("url_type"))
    out = out.join(click, ["member_key", "email_address"], "left")
    per_date = with_key_aggregates(out, ["member_key", "log_date"], _same_click=F.count(F.lit(1)))
    out = with_key_aggregates(per_date, ["member_key"], _newest=F.max("log_date"),
                              _consent=F.max(F.struct("consent_date", "email_address")))
    same_consent = F.struct("consent_date", "email_address").eqNullSafe(F.col("_consent"))
    out = with_key_aggregates(out.withColumn("_top", same_consent), ["member_key"], _ties=F.count_if("_top"))
    opened = F.coalesce(F.col("url_type") == OPENED, F.lit(False))
    yes = lambda c: F.when(F.coalesce(c, F.lit(False)), "YES").otherwise("NO")
    return out.withColumns({
        "recently_opened_flag": yes(F.col("log_date").eqNullSafe(F.col("_newest")) & (F.col("_same_click") > 1) & opened),
        "recent_email_consent_flag": yes(F.col("_top") & (F.col("_ties") > 1)),
        "most_opened_12_months": yes((F.datediff(as_date(on), F.col("log_date")) <= 365) & opened)}
    ).drop("_same_click", "_newest", "_consent", "_top", "_ties", "log_date", "url_type")


def email_best(flagged: DataFrame) -> DataFrame:
    """Per member the address that alone meets the first criterion which exactly one address
    meets; if no criterion decides, the first address. Needs counts only, never the list."""
    counts = {f"_c{i}": F.count_if(F.col(c) == "YES") for i, c in enumerate(EMAIL_CRITERIA)}
    out = with_key_aggregates(flagged, ["member_key"], _first=F.min("email_address"), **counts)
    best = None
    for i, c in enumerate(EMAIL_CRITERIA):
        best = (F if best is None else best).when(F.col(f"_c{i}") == 1, F.coalesce(F.col(c) == "YES", F.lit(False)))
    best = best.otherwise(F.col("email_address") == F.col("_first"))
    new = F.when(best, "YES").otherwise("NO")
    return out.withColumns({"action_flag": F.when(new.eqNullSafe(F.col("best_email_flag")), "NCD").otherwise("U"), "best_email_flag": new}
                           ).drop("_first", *counts)


def email_activity(emails: DataFrame, deliveries: DataFrame, clicks: DataFrame, on) -> DataFrame:
    """ACTIVE if delivered in the last 90 days and opened or clicked in the last 90 days."""
    since = F.date_sub(as_date(on), 90)
    sent = deliveries.filter(F.col("delivery_contact_date").cast("date") >= since).select("mme_id", "email_address").distinct().withColumn("_sent", F.lit(True))
    open_ = clicks.filter((F.col("log_date").cast("date") >= since) & F.col("url_type").isin(1, 2)).select("mme_id").distinct().withColumn("_open", F.lit(True))
    out = emails.join(sent, ["mme_id", "email_address"], "left").join(open_, "mme_id", "left")
    return out.withColumn("active_inactive_flag", F.when(F.col("_sent") & F.col("_open"), "ACTIVE").otherwise("INACTIVE")).drop("_sent", "_open")


def last_purchase(lines: DataFrame, time: str, amount: str) -> DataFrame:
    """Spend at the newest purchase moment of each member; a purchase without a date comes first.
    The lines are read once and add up to moments before a member's moments are compared."""
    moments = lines.filter(F.col("member_key") != UNKNOWN_KEY).groupBy("member_key", "trxn_date", time).agg(F.sum(amount).alias("last_spend"))
    return latest_per_key(moments, "member_key", [-F.unix_date("trxn_date"), -F.col(time)])


def email_best_member(emails: DataFrame, purchases: DataFrame, scoring: DataFrame) -> DataFrame:
    """Per address the member with the best segment, then the latest purchase, then its spend."""
    rows = emails.join(purchases, "member_key", "left").join(scoring.select("member_key", "segment_rank"), "member_key", "left")
    order = [F.coalesce(F.col("segment_rank"), F.lit(999)), newest("trxn_date"), F.coalesce(-F.col("trxn_time_key"), F.lit(0)),
             largest("last_spend"), F.col("member_key")]
    marked = mark_best(rows, ["email_address"], order, "_best")
    return marked.withColumn("best_member", F.when(F.col("_best"), "YES").otherwise("NO")).drop("_best")


def email_loyalty_unique(emails: DataFrame, newest_loyalty: DataFrame) -> DataFrame:
    """At most one loyalty address per member and one member per loyalty address; the address
    of the newest loyalty feed goes first."""
    rows = emails.join(newest_loyalty.select("member_key", "email_address").distinct().withColumn("_new", F.lit(0)), ["member_key", "email_address"], "left")
    rows = rows.withColumn("_new", F.coalesce("_new", F.lit(1)))
    for keys in (["member_key", "is_loyalty_email"], ["email_address", "is_loyalty_email"]):
        rows = mark_best(rows, keys, [F.col("_new"), F.col("member_key"), F.col("email_address")], "_first")
        rows = rows.withColumn("is_loyalty_email", F.when((F.col("is_loyalty_email") == "YES") & ~F.col("_first"), "NO")
                               .otherwise(F.col("is_loyalty_email"))).drop("_first")
    return rows.drop("_new")


# ---------------------------------------------------------------- phones

def phone_best(phones: DataFrame) -> DataFrame:
    """Best mobile per member by acknowledgements, consent date and the previous flag; other
    phones are never best."""
    mobile = phones.filter("phone_type = 'MOBILE'")
    order = [largest("acknowledgements"), newest("consent_date"), yes_first("best_mobile_flag"), F.col("phone_number")]
    marked = mark_best(mobile, ["member_key"], order, "_best")
    marked = marked.withColumn("best_mobile_flag", F.when(F.col("_best"), "YES").otherwise("NO")).drop("_best")
    rest = phones.filter(~F.coalesce(F.col("phone_type") == "MOBILE", F.lit(False))).withColumn("best_mobile_flag", F.lit("NO"))
    return marked.unionByName(rest)


def phone_best_member(phones: DataFrame, purchases: DataFrame, scoring: DataFrame) -> DataFrame:
    rows = phones.join(purchases, "member_key", "left").join(scoring.select("member_key", "segment_rank"), "member_key", "left")
    order = [F.coalesce(F.col("segment_rank"), F.lit(0)), newest("trxn_date"), F.coalesce(-F.col("trxn_time_key"), F.lit(0)),
             largest("last_spend"), F.col("member_key")]
    mobile = F.coalesce(F.col("phone_type") == "MOBILE", F.lit(False))
    marked = mark_best(rows.filter(mobile), ["phone_number"], order, "_best")
    return (marked.withColumn("best_member", F.when(F.col("_best"), "YES").otherwise("NO")).drop("_best")
            .unionByName(rows.filter(~mobile).withColumn("best_member", F.lit("NO"))))


# ---------------------------------------------------------------- scrubbing

# fixed values: what a scrubbed prospect keeps, and its defaults
SCRUB_KEEPS = ["valid_email", "email_consent", "customer_add_date", "customer_introduction_date", "record_info_key",
               "original_record_info_key", "match_type_key", "original_source_key", "is_plcc", "record_type",
               "customer_add_date_key", "customer_introduction_date_key", "is_dm_marketable", "is_em_marketable",
               "is_sms_marketable", "closest_store_state", "is_loyalty_member", "preferred_store_state",
               "second_closest_store_state", "best_household_member", "status", "member_key", "file_name", "member_id", "batch_id"]
SCRUB_DEFAULTS = {"current_source_key": 776, "overlay_rank_key": 0, "direct_mail_consent": "UNKNOWN", "deceased": "UNKNOWN",
                  "address_is_prison": "UNKNOWN", "gender": "UNKNOWN", "gender_scrubbed": "UNKNOWN"}


def _purged(since, purge_days: int, on) -> tuple[Column, Column]:
    """(prospects to purge, those of them that were not scrubbed before)"""
    old = F.datediff(as_date(on), F.col("customer_add_date")) >= purge_days
    purge = F.coalesce((_up("record_type") == "PROSPECT") & (F.col("customer_add_date") >= as_date(since)) & old, F.lit(False))
    return purge, purge & ~F.coalesce(F.col("current_source_key") == SCRUB_DEFAULTS["current_source_key"], F.lit(False))


def _wiped(df: DataFrame, cond: Column) -> DataFrame:
    defaults = {**key_defaults(df.schema), **SCRUB_DEFAULTS}
    return df.select(*[F.col(c) if c in SCRUB_KEEPS else F.when(cond, F.lit(defaults.get(c)).cast(t)).otherwise(F.col(c)).alias(c)
                       for c, t in df.dtypes])


def _wiped_members(history: DataFrame, gone: DataFrame) -> DataFrame:
    marked = history.join(broadcast_if_small(gone.select("member_key").withColumn("_purge", F.lit(True))), "member_key", "left")
    return _wiped(marked, F.coalesce("_purge", F.lit(False))).select(*history.columns)


def _purge_counts(gone: DataFrame) -> DataFrame:
    return gone.groupBy("customer_add_date").agg(F.count(F.lit(1)).alias("purge_record_count"))


def scrub_prospects(member: DataFrame, history: DataFrame, since, purge_days: int, on) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(current, history, purged members per add date): prospects added since a date and older
    than the purge period lose all but a few columns, in both partitions."""
    purge, fresh = _purged(since, purge_days, on)
    gone = member.filter(purge)
    return _wiped(member, fresh), _wiped_members(history, gone), _purge_counts(gone)


def scrub_stored(spark, current: str, history: str, since, purge_days: int, on, parts: int = 512) -> DataFrame:
    """The same for both partitions stored by member_key: only parts that hold a prospect to
    purge are read again and written."""
    purge, fresh = _purged(since, purge_days, on)
    member = read_by_key(spark, current)
    gone = stage(member.filter(purge).select("member_key", "customer_add_date", fresh.alias("_fresh")))
    rewrite_keys(spark, current, "member_key", gone.filter("_fresh").select("member_key"), lambda rows: _wiped(rows, fresh), parts)
    rewrite_keys(spark, history, "member_key", gone.select("member_key"), lambda rows: _wiped_members(rows, gone), parts)
    return _purge_counts(gone)
