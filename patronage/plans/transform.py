"""Survivorship: matched feed rows into the member, e-mail, phone and household work tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..codes import DATE_UNKNOWN, UNKNOWN_KEY
from ..functions.dates import as_date
from ..functions.text import decode, is_empty, is_not_empty
from ..operators.aggregates import earliest_key, first_non_empty, max_key
from ..operators.columns import align_to_schema, apply_expressions, key_defaults, rename_columns
from ..operators.joins import explode_key_list, update_keys
from ..operators.ranking import latest_per_key
from ..operators.sequence import generate_sequence
from ..operators.skew import join_back
from ..operators.sets import union_all
from ..operators.sizing import broadcast_if_small
from . import consent
from .feed_maps import FEED_DERIVED, FEED_MAPPINGS, META_RENAMES


def column_mapping(rows: DataFrame, feed: str) -> DataFrame:
    """Feed columns under their member names, then the feed's derived columns, as far as the
    rows have what they are made of."""
    out = rename_columns(rows, {**FEED_MAPPINGS[feed], **META_RENAMES})
    have = set(out.columns) | ({"member_source"} if "lw_enrollment_source_key" in out.columns else set())
    return apply_expressions(out, {n: e for n, e in FEED_DERIVED.get(feed, {}).items() if n in have})


def merge_member_info(rows: DataFrame, date: str, tiebreak: str, key: str = "member_key") -> DataFrame:
    """One row per member: each column takes its first non-empty value, newest row first."""
    order = [-F.unix_date(F.coalesce(F.col(date), as_date(DATE_UNKNOWN))), F.col(tiebreak)]
    values = [c for c in rows.columns if c not in (key,)]
    return (rows.filter(F.col(key) != UNKNOWN_KEY).groupBy(key)
            .agg(*[first_non_empty(c, order) for c in values]))


def member_insert(rows: DataFrame, target, on, intro: str | None = None) -> DataFrame:
    """Full member rows for new keys (unmatched rows that got a key), one per member."""
    fresh = rows.filter(~F.col("match_status") & (F.col("member_key") != UNKNOWN_KEY))
    one = latest_per_key(fresh, "member_key", [F.col("etl_unique_id")])
    full = one.withColumns({
        "customer_introduction_date": F.col(intro).cast("date") if intro else as_date(on), "customer_add_date": as_date(on),
        "original_record_info_key": F.col("record_info_key"), "original_source_key": F.col("current_source_key")})
    return align_to_schema(full, target).withColumn("action_flag", F.lit("I"))


OVERLAY = ["first_name", "last_name", "address1", "zip_code"]
ADDRESS_REST = ["address2", "state", "city", "zip4"]


def source_over_target(source_rank: Column, target_rank: Column) -> Column:
    """A target of rank -1 or less always loses; otherwise the lower rank wins, ties to the source."""
    return (target_rank <= -1) | (source_rank <= target_rank)


def card_rule(rank: Column, src_plcc: Column, src_bank: Column, tgt_plcc: Column) -> Column:
    """Till feed: source rank 4 needs the matching kind of card, rank 3 always passes."""
    yes = lambda c: F.coalesce(F.lower(c) == "yes", F.lit(False))
    return ((rank == 4) & yes(src_plcc) & yes(tgt_plcc)) | (
        (rank == 4) & yes(src_bank) & tgt_plcc.isNotNull() & ~yes(tgt_plcc)) | (rank == 3)


def member_update(rows: DataFrame, member: DataFrame, columns: list[str], sources: DataFrame | None = None, on=None,
                  till: bool = False) -> DataFrame:
    """Matched rows applied to their members: a non-blank source value replaces the current one.

    With `sources` (source_key, source_overlay_rank) names and address move as one block when
    the source has all of them and either the member has none, or the source outranks the
    member's and, for the till feed, the card rule holds. The condition is read from left to
    right, so the card rule also applies to members without an address. The overlay date
    changes only if the block does.
    """
    matched = rows.filter("match_status")
    one = latest_per_key(matched, "member_key", [F.col("etl_unique_id")])
    block = OVERLAY + [c for c in ADDRESS_REST if c in one.columns]
    plain = [c for c in columns if c not in block and c != "member_key"]
    s = one.select(F.col("member_key").alias("_key"), *[F.col(c).alias(f"s_{c}") for c in dict.fromkeys(plain + block) if c in one.columns],
                   *[F.col(c).alias(f"s_{c}") for c in ("batch_id", "is_plcc", "is_credit_card") if c in one.columns and c not in plain])
    out = s.join(member, F.col("_key") == F.col("member_key"))
    fresh = {c: F.when(is_not_empty(F.col(f"s_{c}")), F.col(f"s_{c}")).otherwise(F.col(c)) for c in plain}
    if sources is None:
        return out.withColumns(fresh).select(*member.columns).withColumn("action_flag", F.lit("U"))
    ranks = sources.select("source_key", "source_overlay_rank")
    for side, key in (("t", "overlay_rank_key"), ("s", "s_current_source_key")):
        one_side = ranks.select(F.col("source_key").alias(f"_{side}k"), F.col("source_overlay_rank").alias(f"_{side}rank"))
        out = out.join(broadcast_if_small(one_side), F.col(key) == F.col(f"_{side}k"), "left").drop(f"_{side}k")
    out = out.fillna(-1, ["_srank", "_trank"])
    every = lambda conds: _all(conds)
    has_source = every([is_not_empty(F.col(f"s_{c}")) for c in OVERLAY])
    no_target = every([is_empty(F.col(c)) for c in OVERLAY])
    wins = no_target | source_over_target(F.col("_srank"), F.col("_trank"))
    if till:
        wins = wins & card_rule(F.col("_srank"), F.col("s_is_plcc"), F.col("s_is_credit_card"), F.col("is_plcc"))
    move = has_source & wins
    same = every([F.coalesce(F.upper(F.trim(F.col(f"s_{c}"))) == F.upper(F.trim(F.col(c))), F.lit(False)) for c in OVERLAY[:3]]
                 + [F.coalesce(F.substring("s_zip_code", 1, 5) == F.substring("zip_code", 1, 5), F.lit(False))])
    moved = {c: F.when(F.col("_move"), F.col(f"s_{c}")).otherwise(F.col(c)) for c in block}
    moved["overlay_rank_key"] = F.when(F.col("_move"), F.col("s_current_source_key").cast("bigint")).otherwise(F.col("overlay_rank_key"))
    moved["overlay_load_id"] = F.when(F.col("_move"), F.col("s_batch_id").cast("bigint")).otherwise(F.col("overlay_load_id"))
    moved["overlay_date"] = F.when(F.col("_move") & ~F.col("_same"), as_date(on)).otherwise(F.col("overlay_date"))
    out = out.withColumns({"_move": move, "_same": same})
    return out.withColumns({**fresh, **moved}).select(*member.columns).withColumn("action_flag", F.lit("U"))


def _all(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def zip_split(df: DataFrame) -> DataFrame:
    """Long zip codes to five digits, the rest and the full form."""
    z = F.col("zip_code")
    long_ = F.length(z) > 5
    rest = F.when(long_, F.expr("substr(zip_code, 6)"))
    return df.withColumns({
        "zip4": F.when(is_not_empty(F.col("zip4")), F.col("zip4")).otherwise(rest),
        "zip_full": F.when(long_, F.concat(F.substring("zip_code", 1, 5), F.lit("-"), rest)).otherwise(z),
        "zip_code": F.substring("zip_code", 1, 5)})


# ---------------------------------------------------------------- hygiene

# ---- fixed values ---------------------------------------------------------------
HYGIENE_SOURCE, SUPPRESSED_SOURCE, EMAIL_HYGIENE_SOURCE = 2229, 776, 2228
MOVED = ["F", "P", "I", "B", "U"]
DWELLINGS = {"M": "Multi_No_Apartment", "B": "BUSINESS", "S": "SINGLE", "A": "MULTI_WITH_APARTMENT", "U": "UNKNOWN"}
WIPED_DEFAULTS = {"overlay_rank_key": 0, "direct_mail_consent": "UNKNOWN", "gender": "UNKNOWN", "gender_scrubbed": "UNKNOWN",
                  "deceased": "UNKNOWN", "address_is_prison": "UNKNOWN"}
WIPE_KEEPS = ["member_key", "member_id", "original_source_key", "valid_email", "email_consent", "customer_add_date",
              "customer_introduction_date", "record_info_key", "original_record_info_key", "match_type_key", "is_plcc",
              "record_type", "is_dm_marketable", "is_em_marketable", "is_sms_marketable", "is_loyalty_member",
              "best_household_member", "batch_id", "last_updated_date", "status"]


def hygiene_columns(rows: DataFrame) -> DataFrame:
    """Decode the hygiene feed: one row per member of its key list."""
    low = lambda c: F.lower(F.trim(F.col(c)))
    score, dsf = F.col("deliverability_score"), low("dsf2_verified")
    undeliverable = F.coalesce(low("deliverability_indicator") == "u", F.lit(False))
    bad_dsf = F.coalesce(dsf.isin("n", "d"), F.lit(False))
    yes = lambda c: F.coalesce(c, F.lit(False))
    strict = (F.when(yes(score.isin(1, 2, 3, 4)) | yes(dsf == "y"), "YES")
              .when(yes(score.isin(0, 5, 6, 7, 8)) | undeliverable | bad_dsf, "NO"))
    loose = (F.when(yes(score.isin(1, 2, 3, 4, 5, 6)) | yes(dsf == "s"), "YES")
             .when(yes(score.isin(0, 7, 8)) | undeliverable | bad_dsf, "NO"))
    return explode_key_list(rows.withColumnRenamed("member_key", "_keys"), "_keys", "member_key").drop("_keys").withColumns({
        "address_is_prison": F.when(F.col("prison_suppress_flag") == "A", "YES"),
        "deceased": F.when(F.col("deceased_suppress_flag") == "I", "YES"),
        "ncoa_last_change_date": F.when(F.col("ncoa_indicator").isin(MOVED), F.col("ncoa_move_date")),
        "dwelling_type": decode(F.col("dwelling_code"), DWELLINGS), "valid_strict": strict, "valid_loose": loose,
        "match_status": F.lit(True), "current_source_key": F.lit(HYGIENE_SOURCE)})


def comprehensive_hygiene(rows: DataFrame, member: DataFrame, columns: list[str]) -> DataFrame:
    """Hygiene results applied to members; suppressed prospects (pander flag F) are wiped to
    defaults instead."""
    feed = hygiene_columns(rows)
    prospects = member.filter(F.upper(F.trim("record_type")) == "PROSPECT").select("member_key")
    suppress = F.upper(F.trim("pander_suppress_flag")) == "F"
    flagged = feed.join(prospects.withColumn("_prospect", F.lit(True)), "member_key", "left")
    wipe = F.coalesce(suppress & F.col("_prospect"), F.lit(False))
    gone = flagged.filter(wipe).select("member_key").distinct()
    defaults = {**key_defaults(member.schema), **WIPED_DEFAULTS}
    wiped = member.join(gone, "member_key", "left_semi").select(*[
        F.col(c) if c in WIPE_KEEPS else (F.lit(SUPPRESSED_SOURCE).cast(t) if c == "current_source_key" else F.lit(defaults.get(c)).cast(t)).alias(c)
        for c, t in member.dtypes]).withColumn("action_flag", F.lit("U"))
    updated = member_update(flagged.filter(~wipe).drop("_prospect"), member, columns)
    return union_all([updated, wiped])


def email_hygiene(results: DataFrame, emails: DataFrame) -> DataFrame:
    """Validity updates, and corrected addresses: inserted when the member does not have them
    yet (not a loyalty address, valid), else marked valid."""
    low = lambda c: F.lower(F.trim(F.col(c)))
    res = results.select(low("email").alias("_e"), F.when(low("category") == "valid", "YES").when(low("category") == "invalid", "NO").alias("_valid"),
                         F.nullif(low("correction"), F.lit("")).alias("_fix")).distinct()
    hit = res.join(emails, F.col("_e") == low("email_address"))
    update = hit.withColumn("valid_email", F.col("_valid"))
    fixes = hit.filter(F.col("_fix").isNotNull())
    known = emails.select(F.col("member_key").alias("_m"), low("email_address").alias("_a"), F.col("email_address").alias("_own"))
    fixes = fixes.join(known, (F.col("member_key") == F.col("_m")) & (F.col("_fix") == F.col("_a")), "left")
    insert = fixes.filter(F.col("_m").isNull()).withColumns({
        "email_address": F.col("_fix"), "is_loyalty_email": F.lit("NO"), "valid_email": F.lit("YES")}).select(*emails.columns)
    again = fixes.filter(F.col("_m").isNotNull()).select("_m", "_own").distinct()
    marked = (emails.join(again, (F.col("member_key") == F.col("_m")) & (F.col("email_address") == F.col("_own")), "left_semi")
              .withColumn("valid_email", F.lit("YES")))
    out = union_all([insert.withColumn("action_flag", F.lit("I")), update.select(*emails.columns).withColumn("action_flag", F.lit("U")),
                     marked.select(*emails.columns).withColumn("action_flag", F.lit("U"))])
    return out.withColumn("source_key", F.lit(EMAIL_HYGIENE_SOURCE))


def reverse_append(rows: DataFrame, contacts: DataFrame, member: DataFrame, value: str, contact_value: str, flags: list[Column],
                   columns: list[str], source: int) -> DataFrame:
    """Addresses found by phone or e-mail: rows with last name, address and zip, one per member
    of their key list (best contact first), for members that lack a scrubbed address."""
    usable = _all([is_not_empty(F.col(c)) & (F.col(c) != "NULL") for c in ("last_name", "address1", "zip_code")])
    each = explode_key_list(rows.filter(usable).withColumnRenamed("member_key", "_keys"), "_keys", "member_key").drop("_keys")
    side = contacts.withColumnRenamed(contact_value, "_value")
    each = each.join(side, (each["member_key"] == side["member_key"]) & (F.col(value) == F.col("_value")), "left").drop(side["member_key"])
    rank = F.lit(len(flags) + 1)
    for i, f in reversed(list(enumerate(flags))):
        rank = F.when(F.coalesce(f, F.lit(False)), i).otherwise(rank)
    best = latest_per_key(each.withColumn("_rank", rank), "member_key", [F.col("_rank"), F.col(value), F.col("address1"), F.col("zip_code")])
    lacking = member.filter(F.col("last_name_scrubbed").isNull() & F.col("address1_scrubbed").isNull() & F.col("zip_code_scrubbed").isNull())
    picked = best.join(lacking.select("member_key"), "member_key", "left_semi").withColumns({
        "match_status": F.lit(True), "current_source_key": F.lit(source), "etl_unique_id": F.lit(None).cast("string")})
    return member_update(picked, member, columns)


# ---------------------------------------------------------------- e-mail and phone

def multi_email(rows: DataFrame, current: DataFrame, feed: str, on, order: list[Column]) -> DataFrame:
    """One row per (member, e-mail) of a feed with consents against the current row."""
    usable = rows.filter(is_not_empty(F.col("email_address")) & (F.col("member_key") > 0)).withColumn("_e", F.lower(F.trim("email_address")))
    one = latest_per_key(usable, ["member_key", "_e"], order)
    cur = current.select(F.col("member_key").alias("_m"), F.lower(F.trim("email_address")).alias("_ce"),
                         *[F.col(c).alias(f"dim_{c}") for c in consent.BRANDS + consent.BRAND_DATES + ["first_pos_consent_date", "valid_email"]],
                         F.col("is_loyalty_email").alias("dim_is_loyalty_email"))
    cur = latest_per_key(cur, ["_m", "_ce"], [F.col("dim_email_consent_date").desc_nulls_last()])
    joined = one.join(cur, (F.col("member_key") == F.col("_m")) & (F.col("_e") == F.col("_ce")), "left")
    out = consent.email_consent(joined, feed, on)
    valid = F.when(F.col("source_key") == 6, "YES").otherwise(F.col("dim_valid_email")) if feed == "till" else F.col("dim_valid_email")
    loyal = F.lit("YES") if feed == "loyalty" else F.coalesce("dim_is_loyalty_email", F.lit("NO"))
    return out.withColumns({"valid_email": valid, "is_loyalty_email": loyal}).drop("_e", "_m", "_ce")


def multi_phone(rows: DataFrame, current: DataFrame, phones: dict[str, str], on, order: list[Column]) -> DataFrame:
    """Phone columns stacked as rows (column -> phone type), one row per (member, phone)."""
    each = F.explode(F.array(*[F.struct(F.trim(F.col(c).cast("string")).alias("phone_number"), F.lit(t).alias("phone_type"))
                               for c, t in phones.items()]))
    keep = [c for c in rows.columns if c not in phones]
    stacked = rows.select(*keep, each.alias("p")).select(*keep, "p.*")
    usable = stacked.filter(is_not_empty(F.col("phone_number")) & (F.upper("phone_number") != "UNKNOWN"))
    one = latest_per_key(usable, ["member_key", "phone_number"], order + [F.col("phone_type")])
    cur = current.select("member_key", F.col("phone_number").cast("string").alias("phone_number"), F.col("phone_consent").alias("dim_phone_consent"),
                         F.col("consent_date").alias("dim_phone_consent_date"), F.col("is_loyalty_flag").alias("dim_is_loyalty_flag"))
    return consent.phone_consent(one.join(cur, ["member_key", "phone_number"], "left"), on)


# ---------------------------------------------------------------- household

HOUSE_DWELLINGS = ["MULTI_NO_APARTMENT", "MULTI_WITH_APARTMENT", "UNKNOWN", "SINGLE"]
HOUSE_KEY = ["last_name", "address1", "address2", "city", "state", "zip_code"]
HOUSE_DATES = ["first_trxn_date", "add_date", "introduction_date", "last_store_purch_date", "last_web_purch_date", "account_open_date"]


def household_rows(member: DataFrame, on) -> DataFrame:
    """Members with a complete address, their household key columns (scrubbed, else raw) and
    the overlay date that ranks existing household keys."""
    up = lambda c: F.upper(F.trim(F.col(c)))
    usable = lambda c: F.coalesce(~up(c).isin("", "NULL"), F.lit(False))
    text = {}
    for c in HOUSE_KEY:
        raw = F.coalesce(up(c), F.lit(""))
        if c == "zip_code":
            raw = F.coalesce(F.upper(F.trim(F.lpad(F.substring("zip_code", 1, 5), 5, "0"))), F.lit(""))
        value = F.when(usable(f"{c}_scrubbed"), up(f"{c}_scrubbed")).otherwise(raw)
        text[f"h_{c}"] = F.when(value == "NULL", "").otherwise(value)
    fresh = F.col("household_key").isNull() | (F.col("household_key") == UNKNOWN_KEY)
    date = F.col("overlay_date").cast("date")
    overlay = F.when(fresh & date.isNull(), as_date(on)).otherwise(F.coalesce(date, as_date(DATE_UNKNOWN)))
    rows = member.withColumns({**text, "h_overlay_date": overlay})
    complete = _all([F.col(f"h_{c}") != "" for c in HOUSE_KEY if c != "address2"])
    return rows.filter(complete & up("dwelling_type").isin(HOUSE_DWELLINGS))


def transform_household(member: DataFrame, households: DataFrame, dates: DataFrame, on) -> tuple[DataFrame, DataFrame]:
    """(households, members of each): members at one address under one name.

    A household keeps the key that its members held earliest; if that key is unknown or
    another household has the better claim (earlier overlay date), it gets a new one. The
    members of a household are a table of their own, so a crowded address is not one long
    text.
    """
    rows = household_rows(member, on)
    names = [f"h_{c}" for c in HOUSE_KEY]
    grouped = rows.groupBy(*names).agg(
        earliest_key("household_key", "h_overlay_date").cast("bigint").alias("_old"), F.count(F.lit(1)).alias("member_count"),
        F.min("member_key").alias("first_member_key"), F.min("first_trxn_date").alias("first_trxn_date"),
        F.coalesce(F.max(F.when(F.col("is_plcc") == "YES", "YES")), F.lit("NO")).alias("is_plcc"),
        F.min("customer_introduction_date").alias("introduction_date"), F.max("last_store_purch_date").alias("last_store_purch_date"),
        F.max("last_web_purch_date").alias("last_web_purch_date"), F.min("h_overlay_date").alias("overlay_date"),
        F.min("member_acct_open_date").alias("account_open_date"))
    claims = grouped.groupBy("_old").agg(F.min(F.struct("overlay_date", "first_member_key"))["first_member_key"].alias("_owner"))
    claimed = join_back(grouped, claims, ["_old"])
    keeps = (F.col("_old") > 0) & (F.col("_owner") == F.col("first_member_key"))
    kept = claimed.filter(F.coalesce(keeps, F.lit(False))).withColumn("household_key", F.col("_old")).drop("_old", "_owner")
    fresh = claimed.filter(~F.coalesce(keeps, F.lit(False))).drop("_old", "_owner")
    fresh = generate_sequence(fresh, "household_key", [F.col("first_member_key")], max_key(households, "household_key"))
    both = kept.unionByName(fresh).withColumns({
        "add_date": as_date(on), "zip_code": F.col("h_zip_code"), "valid_address": F.concat("h_address1", "h_address2")})
    out = update_keys(both, HOUSE_DATES, dates, "sdate", "date_key")
    best = latest_per_key(member.filter("best_household_member = 'YES'"), "household_key",
                          [F.col("last_updated_date").desc(), F.col("member_key")]).select("household_key", "valid_loose", "valid_strict")
    strict, loose = F.col("valid_strict"), F.col("valid_loose")
    state = (F.when(strict == "YES", "STRICT").when((loose == "YES") & (strict == "NO"), "LOOSE")
             .when((loose == "NO") & (strict == "NO"), "INVALID").when(loose.isNull() | strict.isNull(), "INVALID"))
    result = out.join(best, "household_key", "left").withColumn("address_validity", state).drop("valid_loose", "valid_strict")
    # every member finds its household by the address columns, not through the household's list
    members = join_back(rows.select("member_key", *names), result.select(*names, "household_key"), names).select("household_key", "member_key")
    return result.drop(*names), members
