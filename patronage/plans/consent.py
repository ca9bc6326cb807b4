"""Consent rules per feed and their dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import as_date
from ..functions.text import is_not_empty, norm_text
from ..operators.ranking import latest_per_key

# ---- fixed values: consent value per feed, as SQL over the feed row and the current row ----
# (current values are the columns dim_*; {cur} is the current value of the consent itself)
CARD_OPT_IN = ("case when upper(trim(email_opt_in_indicator)) = 'Y' then coalesce({cur}, 'YES') "
               "when upper(trim(email_opt_in_indicator)) = 'N' then 'NO' else {cur} end")
PREFERENCE = ("case when upper(trim(optinflag)) = 'Y' then 'YES' when upper(trim(optinflag)) = 'N' then 'NO' else {cur} end")
PREFERENCE_LOYAL = ("case when upper(trim(optinflag)) = 'Y' and upper(trim(is_loyalty_member)) = 'YES' then 'YES' "
                    "when upper(trim(optinflag)) = 'N' and upper(trim(is_loyalty_member)) = 'YES' then 'NO' else {cur} end")
LOYALTY_OPT_IN = ("case when {flag} = 1 and memberstatus in (1, 3, 4) then 'YES' "
                  "when {flag} = 0 and memberstatus in (1, 3, 4) then 'NO' else {cur} end")
BRAND_FLAG = "case when {flag} = 1 then 'YES' when {flag} = 0 then 'NO' else {cur} end"
TILL_ADDRESS = "case when lower(trim(email_address)) is not null then 'YES' else {cur} end"
CARRY = "{cur}"

DM_RULES = {
    "till": CARRY,
    "card_statement": "case when upper(trim(do_not_direct_mail)) = 'X' then 'NO' else {cur} end",
    "loyalty": LOYALTY_OPT_IN.replace("{flag}", "a_directmailoptin"),
    "employee": CARRY,
    "preference_center": ("case when upper(trim(optinflag)) = 'Y' then 'YES' when upper(trim(optinflag)) = 'N' then 'NO' "
                          "when upper(trim(optinflag)) = 'U' then 'UNKNOWN' else {cur} end"),
}
EMAIL_RULES = {  # feed -> rule of the retail, outlet, next and overall consent
    "employee": (CARRY, CARRY, CARRY, CARRY),
    "card_account": (CARD_OPT_IN, CARRY, CARRY, CARD_OPT_IN),
    "card_statement": (CARD_OPT_IN, CARRY, CARRY, CARD_OPT_IN),
    "till": (TILL_ADDRESS, CARRY, CARRY, TILL_ADDRESS),
    "email_update": (BRAND_FLAG.replace("{flag}", "consent_value_retail"), BRAND_FLAG.replace("{flag}", "consent_value_outlet"), CARRY,
                     "case when consent_value_retail = 1 or consent_value_outlet = 1 then 'YES' "
                     "when consent_value_retail = 0 and consent_value_outlet = 0 then 'NO' else {cur} end"),
    "preference_center": (PREFERENCE, CARRY, PREFERENCE_LOYAL, PREFERENCE),
    "loyalty": (LOYALTY_OPT_IN.replace("{flag}", "a_emailoptin"), CARRY, LOYALTY_OPT_IN.replace("{flag}", "a_emailoptin"),
                LOYALTY_OPT_IN.replace("{flag}", "a_emailoptin")),
}
EVENT_DATES = {"till": "transaction_date_iso", "email_update": "last_modified_date", "preference_center": "optdate"}
BRANDS = ["consent_value_retail", "consent_value_outlet", "consent_value_next", "email_consent"]
BRAND_DATES = ["consent_date_retail", "consent_date_outlet", "consent_date_next", "email_consent_date"]
MOBILE_SOURCE = 2226


def consent_update(new: Column, current: Column, current_date: Column, event_date: Column) -> Column:
    """Date of a consent: the current one while the value stays the same, else the event's."""
    same = F.coalesce(new, F.lit("")) == F.coalesce(current, F.lit(""))
    return F.when(same, current_date).otherwise(event_date)


def _event(df: DataFrame, feed: str, on) -> Column:
    name = EVENT_DATES.get(feed)
    if name is None or name not in df.columns:
        return as_date(on)
    return F.coalesce(F.col(name).cast("date"), as_date(on))


def dm_consent(rows: DataFrame, current: DataFrame, feed: str, on) -> DataFrame:
    """Direct mail consent of a feed: value and date after the feed, newest current row per member."""
    cur = latest_per_key(current.filter("consent_type = 'DM'"), "member_key",
                         [F.col("consent_date").desc(), F.col("consent_history_id").desc()])
    cur = cur.select("member_key", F.col("consent_value").alias("dim_consent_value"), F.col("consent_date").alias("dim_consent_date"))
    out = rows.join(cur, "member_key", "left")
    value = F.expr(DM_RULES[feed].replace("{cur}", "dim_consent_value"))
    return out.withColumns({
        "consent_value": value, "consent_type": F.lit("DM"), "consent_subtype": F.lit("DIRECTMAIL"),
        "consent_date": consent_update(value, F.col("dim_consent_value"), F.col("dim_consent_date"), _event(rows, feed, on))})


def email_consent(rows: DataFrame, feed: str, on) -> DataFrame:
    """All e-mail consents of a feed joined to its current row (columns dim_*): new values and
    dates per brand and overall, and the first till consent."""
    event = _event(rows, feed, on)
    values, dates = {}, {}
    for name, date, rule in zip(BRANDS, BRAND_DATES, EMAIL_RULES[feed]):
        new = F.expr(rule.replace("{cur}", f"dim_{name}"))
        values[name] = new
        dates[date] = consent_update(new, F.col(f"dim_{name}"), F.col(f"dim_{date}"), event)
    out = rows.select(*[c for c in rows.columns if c not in values and c not in dates],
                      *[v.alias(k) for k, v in {**values, **dates}.items()])
    return out.withColumn("first_pos_consent_date", first_pos_consent(feed))


def first_pos_consent(feed: str) -> Column:
    """Kept once set (and never set by the employee feed); otherwise the earlier of the retail
    and outlet dates that say YES."""
    known = F.col("dim_first_pos_consent_date")
    if feed == "employee":
        return known
    yes = lambda c: F.col(c) == "YES"
    no = lambda c: ~is_not_empty(F.col(c)) | (F.col(c) == "NO")
    retail, outlet = "consent_value_retail", "consent_value_outlet"
    first = (F.when(yes(outlet) & yes(retail), F.least("consent_date_retail", "consent_date_outlet"))
             .when(yes(outlet) & no(retail), F.col("consent_date_outlet"))
             .when(yes(retail) & no(outlet), F.col("consent_date_retail")))
    return F.when(known.isNull(), first).otherwise(known)


def phone_consent(rows: DataFrame, on) -> DataFrame:
    """Only the mobile consent feed sets phone consent; other feeds carry the current one."""
    mobile = F.col("source_key") == MOBILE_SOURCE
    opted = F.upper(F.trim("opt_in")) == "I"
    value = F.when(mobile, F.when(opted, "YES").otherwise("NO")).otherwise(F.col("dim_phone_consent"))
    return rows.withColumns({
        "phone_consent": value,
        "phone_consent_date": F.when(mobile, as_date(on)).otherwise(F.col("dim_phone_consent_date")),
        "phone_type": F.when(mobile, "MOBILE").otherwise(F.coalesce("phone_type", F.lit("UNKNOWN"))),
        "valid_phone": F.when(mobile, "YES").otherwise("NO"),
        "is_loyalty_flag": F.coalesce("dim_is_loyalty_flag", F.lit("NO"))})


def consent_changes(source: DataFrame, target: DataFrame, tiebreak: list[Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(source set, insert and update rows). One row per member on both sides, newest first;
    a member without a row is an insert, a changed row an update. On update blank source
    values keep the current ones, and the date moves only if the consent value changed.

    The load of the reference writes the source set; the change set is what its own steps
    compute and what a load needs.
    """
    newest = [F.col("consent_date").desc_nulls_last()] + (tiebreak or [])
    s = latest_per_key(source, "member_key", newest)
    t = latest_per_key(target, "member_key", newest)
    names = ["consent_date", "consent_type", "consent_value", "is_loyalty", "source_key"]
    j = s.alias("s").join(t.select("member_key", *names).alias("t"), F.col("s.member_key") == F.col("t.member_key"), "left")
    new = F.col("t.member_key").isNull()
    differs = F.lit(False)
    for c in ("consent_date", "source_key"):
        differs = differs | ~F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}"))
    for c in ("consent_value", "is_loyalty"):
        differs = differs | ~norm_text(F.col(f"s.{c}")).eqNullSafe(norm_text(F.col(f"t.{c}")))
    keep = lambda c: F.when(new | is_not_empty(F.col(f"s.{c}")), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
    moved = is_not_empty(F.col("s.consent_value")) & (F.lower(F.trim("s.consent_value")) != F.lower(F.trim("t.consent_value")))
    date = F.when(new | moved, F.coalesce("s.consent_date", "t.consent_date")).otherwise(F.col("t.consent_date"))
    out = j.filter(new | differs).select(
        F.col("s.member_key").alias("member_key"), date.alias("consent_date"),
        *[keep(c).alias(c) for c in names if c != "consent_date"], F.when(new, "I").otherwise("U").alias("action_cd"))
    return s, out
