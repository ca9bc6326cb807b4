"""Queries of customer matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..codes import MATCH_CODES
from ..functions.text import is_not_empty
from ..operators.filters import split_by
from ..operators.ranking import keep_best_ties
from ..operators.sequence import sort_key
from ..plans import feeds, matching as mt
from ..operators.sizing import broadcast_if_small
from ..registry import CHECK_VIEWS, query


def lookups(w) -> mt.Lookups:
    return mt.lookups(w.member, w.multi_email, w.multi_phone, w.card_history, w.card_type, w.tender_history,
                      w.tender_type, w.employee, w.trxn_head)


# ---------------------------------------------------------------- checking views

MARKET = """case (is_dm_marketable || '~' || is_em_marketable || '~' || is_sms_marketable)
  when 'YES~YES~YES' then 1 when 'YES~YES~NO' then 2 when 'YES~NO~NO' then 3 when 'NO~YES~YES' then 4
  when 'NO~YES~NO' then 5 when 'NO~NO~YES' then 6 else 99 end"""

CHECK_VIEWS["o_last"] = """
select member_key, trxn_date, trxn_time_key from (select member_key, trxn_date, trxn_time_key,
  row_number() over (partition by member_key order by trxn_date desc, trxn_time_key desc) as rn from w_trxn_head) t where rn = 1
"""
CHECK_VIEWS["o_order"] = f"""
select m.member_key, nullif(lower(trim(first_name)), '') as fn, nullif(lower(trim(last_name)), '') as ln,
  nullif(trim(loyalty_id), '') is not null as loyal, loyalty_id, ip_code,
  concat_ws(',', nullif(lower(trim(address1)), ''), nullif(lower(trim(address2)), '')) as addr,
  nullif(lower(trim(zip_code)), '') as zip,
  row_number() over (order by {MARKET}, t.trxn_date desc nulls last, t.trxn_time_key desc nulls last,
    customer_introduction_date asc nulls last, m.member_key) as pos
from w_member m left join o_last t on t.member_key = m.member_key
"""
CHECK_VIEWS["o_feed"] = """
select etl_unique_id as id, implied_loyalty_id as loy, lpad(employee_id, 11, '0') as emp, ip_code as ip,
  tender_number as card, cast(nullif(trim(tender_number), '') as bigint) as card_nbr,
  nullif(lower(trim(email_address)), '') as em, phone as ph_raw,
  cast(nullif(regexp_replace(phone, '[^0-9]', '', 'g'), '') as bigint) as ph,
  nullif(lower(trim(first_name)), '') as fn, nullif(lower(trim(last_name)), '') as ln,
  nullif(lower(trim(address_line_1)), '') as a1, nullif(lower(trim(address_line_2)), '') as a2,
  concat_ws(',', nullif(lower(trim(address_line_1)), ''), nullif(lower(trim(address_line_2)), '')) as addr,
  nullif(lower(trim(zip_code)), '') as zip
from w_feed
"""
VALID_PHONE = """(length({0}) = 10 or (length({0}) = 11 and {0} like '1%')) and length(replace({0}, substr({0}, 1, 1), '')) > 0
  and {0} not in ('0000000001', '1234567890', '1231231234', '1000000000', '0000000123', '2000000000', '0000000002', '8000000000')"""
CHECK_VIEWS["o_phone"] = f"""
select p.phone_number as ph, p.is_loyalty_flag as loyal_flag, o.* from w_multi_phone p
  left join o_order o on o.member_key = p.member_key where {VALID_PHONE.format('cast(phone_number as varchar)')}
"""
CHECK_VIEWS["o_email"] = """
select lower(trim(email_address)) as em, is_loyalty_email as loyal_flag, o.*
from w_multi_email e left join o_order o on o.member_key = e.member_key
"""
CHECK_VIEWS["o_plcc"] = """
select c.tokenized_cc_nbr as card, o.* from w_card_history c join w_card_type t on t.card_type_key = c.card_type_key
  join o_order o on o.member_key = c.member_key where t.is_plcc = 'YES' and c.tokenized_cc_nbr <> '000000000000000000'
"""
CHECK_VIEWS["o_holder"] = """
select distinct c.member_key from w_card_history c join w_card_type t on t.card_type_key = c.card_type_key
  where t.is_plcc = 'YES' and c.is_primary_account_holder = 'YES'
"""
CHECK_VIEWS["o_bank"] = """
select distinct c.tokenized_cc_nbr as card_nbr, o.* from w_tender_history c
  join w_tender_type t on t.tender_type_key = c.tender_type_key
  join o_order o on o.member_key = c.member_key where t.is_bank_card = 'YES' and c.tokenized_cc_nbr <> 0
"""

ANY_NAME = "(f.fn is not null or f.ln is not null)"
CANDIDATES = {
    "loyalty_id": "o_order c on f.loy = c.loyalty_id and trim(f.loy) <> ''",
    "employee_id": "w_employee c on f.emp = c.employee_id",
    "ip_code": "o_order c on f.ip = c.ip_code",
    "plcc_loyalty": "o_plcc c on f.card = c.card",
    "plcc_name": "o_plcc c on f.card = c.card and f.fn = c.fn and f.ln = c.ln",
    "plcc_name_loyalty": "o_plcc c on f.card = c.card and f.fn = c.fn and f.ln = c.ln",
    "bank_card": "o_bank c on f.card_nbr = c.card_nbr and f.fn is not null and f.ln is not null",
    "bank_card_name": "o_bank c on f.card_nbr = c.card_nbr and f.fn = c.fn and f.ln = c.ln",
    "email": "o_email c on f.em = c.em",
    "email_name": "o_email c on f.em = c.em and f.fn = c.fn and f.ln = c.ln",
    "phone": "o_phone c on f.ph_raw = cast(c.ph as varchar)",
    "phone_without_name": "o_phone c on f.ph_raw = cast(c.ph as varchar) and (f.fn is null or f.ln is null)",
    "phone_name": "o_phone c on f.ph = c.ph and f.fn = c.fn and f.ln = c.ln",
    "phone_email": "o_phone c on f.ph = c.ph join o_email e on e.em = f.em and e.member_key = c.member_key",
    "phone_email_loyalty": "o_phone c on f.ph = c.ph and c.loyal_flag = 'YES' join o_email e on e.em = f.em "
                           "and e.member_key = c.member_key and e.loyal_flag = 'YES'",
    "phone_email_name": "o_phone c on f.ph = c.ph and f.fn = c.fn and f.ln = c.ln "
                        "join o_email e on e.em = f.em and e.member_key = c.member_key",
    "name_address": "o_order c on f.fn = c.fn and f.ln = c.ln and f.addr = c.addr and f.zip = c.zip "
                    "and (f.a1 is not null or f.a2 is not null)",
}


def _pos(name: str) -> str:
    if name == "employee_id":
        return "0"
    if name == "plcc_loyalty":
        return "c.pos + case when c.member_key in (select member_key from o_holder) then 0 else 1000000000000 end"
    return "c.pos"


for _name, _cand in CANDIDATES.items():
    _sql = f"select f.id, arg_min(c.member_key, {_pos(_name)}) as member_key from o_feed f join {_cand} group by f.id"
    if mt.CRITERIA[_name].require_loyalty:
        _sql = f"select id, x.member_key from ({_sql}) x join o_order o on o.member_key = x.member_key and o.loyal"
    CHECK_VIEWS["o_hit_" + _name] = _sql

MATCH_SCHEMA = "etl_unique_id string, match_status boolean, match_key int, member_key bigint"


def waterfall_sql(names: list[str], where: str = "true") -> str:
    arms = " union all ".join(
        f"select id, {i} as prio, {mt.CRITERIA[n].code} as code, member_key from o_hit_{n}" for i, n in enumerate(names))
    return f"""select f.etl_unique_id, h.id is not null as match_status, coalesce(h.code, 92) as match_key,
      coalesce(h.member_key, -1) as member_key
    from w_feed f left join (select id, arg_min(code, prio) as code, arg_min(member_key, prio) as member_key
      from ({arms}) a group by id) h on h.id = f.etl_unique_id where {where}"""


def _register_criterion(key: str, name: str):
    @query(key, MATCH_SCHEMA, waterfall_sql([name]))
    def run(w, name=name):
        return mt.match_waterfall(w.feed, lookups(w), [name])


for _key, _crit in [("match_loyalty_id", "loyalty_id"), ("match_employee_id", "employee_id"),
                    ("match_ip_code", "ip_code"), ("match_plcc", "plcc_loyalty"), ("match_plcc_name", "plcc_name"),
                    ("match_plcc_name_loyalty", "plcc_name_loyalty"), ("match_bank_card", "bank_card"),
                    ("match_bank_card_name", "bank_card_name"), ("match_email", "email"),
                    ("match_email_name", "email_name"), ("match_phone", "phone"), ("match_phone_name", "phone_name"),
                    ("match_phone_email", "phone_email"), ("match_phone_email_loyalty", "phone_email_loyalty"),
                    ("match_phone_email_name", "phone_email_name"), ("match_name_address", "name_address")]:
    _register_criterion(_key, _crit)


@query("match_waterfall", MATCH_SCHEMA, waterfall_sql(feeds.TILL_ORDER), headline=True)
def match_waterfall(w):
    return mt.match_waterfall(w.feed, lookups(w), feeds.TILL_ORDER)


# ---------------------------------------------------------------- tie-breaking

@query("tie_identify", "email string, member_key bigint, member_count bigint", """
  select em as email, member_key, count(*) over (partition by em) as member_count
  from (select distinct em, member_key from o_email) x""")
def tie_identify(w):
    pairs = w.multi_email.select(F.lower(F.trim("email_address")).alias("email"), "member_key")
    return mt.tie_identify(pairs, ["email"])


@query("tie_primary_holder", "card string, member_key bigint", """
  select card, member_key from (select *, max(holder) over (partition by card) as top from (
    select distinct p.card, p.member_key, case when h.member_key is null then 0 else 1 end as holder
    from o_plcc p left join o_holder h on h.member_key = p.member_key) x) y where holder = top""")
def tie_primary_holder(w):
    lk = lookups(w)
    plcc = lk.card_type.filter("is_plcc = 'YES'")
    pairs = (lk.card_history.join(plcc, "card_type_key", "left_semi")
             .select(F.col("tokenized_cc_nbr").alias("card"), "member_key").distinct())
    held = pairs.join(mt.primary_holders(lk).withColumn("holder", F.lit(1)), "member_key", "left")
    return keep_best_ties(held, ["card"], F.when(F.col("holder") == 1, 0).otherwise(1))


@query("tie_marketability", "email string, member_key bigint", f"""
  select em as email, member_key from (select e.em, e.member_key, rank() over (partition by e.em order by {MARKET}) as r
    from (select distinct em, member_key from o_email) e join w_member m on m.member_key = e.member_key) x where r = 1""")
def tie_marketability(w):
    pairs = w.multi_email.select(F.lower(F.trim("email_address")).alias("email"), "member_key").distinct()
    flagged = pairs.join(w.member, "member_key")
    return keep_best_ties(flagged, ["email"], mt.marketability(
        F.col("is_dm_marketable"), F.col("is_em_marketable"), F.col("is_sms_marketable")))


@query("tie_recency", "email string, member_key bigint", """
  select em as email, member_key from (select e.em, e.member_key,
    rank() over (partition by e.em order by t.trxn_date desc nulls last, t.trxn_time_key desc nulls last) as r
    from (select distinct em, member_key from o_email) e left join o_last t on t.member_key = e.member_key) x where r = 1""")
def tie_recency(w):
    pairs = w.multi_email.select(F.lower(F.trim("email_address")).alias("email"), "member_key").distinct()
    dated = pairs.join(mt.last_transaction(w.trxn_head), "member_key", "left")
    far = F.lit(2147483647)
    return keep_best_ties(dated, ["email"], F.struct(F.coalesce(-F.unix_date("trxn_date"), far),
                                                     F.coalesce(-F.col("trxn_time_key"), far)))


@query("tie_oldest_member", "email string, member_key bigint", """
  select em as email, member_key from (select e.em, e.member_key, row_number() over (partition by e.em
      order by customer_introduction_date asc nulls last, e.member_key) as r
    from (select distinct em, member_key from o_email) e join w_member m on m.member_key = e.member_key) x where r = 1""")
def tie_oldest_member(w):
    pairs = w.multi_email.select(F.lower(F.trim("email_address")).alias("email"), "member_key").distinct()
    dated = pairs.join(w.member.select("member_key", "customer_introduction_date"), "member_key")
    oldest = F.min(F.struct(F.coalesce("customer_introduction_date", F.lit("9999-01-01").cast("date")), "member_key"))
    return dated.groupBy("email").agg(oldest["member_key"].alias("member_key"))


@query("tie_breaker", "email string, member_key bigint", """
  select em as email, arg_min(member_key, pos) as member_key from o_email group by em""")
def tie_breaker(w):
    pairs = w.multi_email.select(F.lower(F.trim("email_address")).alias("email"), "member_key")
    return mt.tie_breaker(pairs, ["email"], lookups(w))


# ---------------------------------------------------------------- new members

MCD_SQL = f"""case when trim(implied_loyalty_id) <> '' then 'mcd_loyaltyid'
  when trim(first_name) <> '' and trim(last_name) <> '' and trim(address_line_1) <> '' and trim(zip_code) <> ''
    then 'mcd_name_address_us'
  when trim(first_name) <> '' and trim(last_name) <> '' and trim(address_line_1) <> '' and trim(non_usa_postal_code) <> ''
    then 'mcd_name_address_canada'
  when cast(nullif(trim(tender_number), '') as bigint) <> 0 then 'mcd_bankcard'
  when trim(email_address) <> '' then 'mcd_email'
  when trim(phone) <> '' and {VALID_PHONE.format("regexp_replace(phone, '[^0-9]', '', 'g')")} then 'mcd_phone'
  else 'mcd_failed' end"""
CHECK_VIEWS["o_mcd"] = f"select *, {MCD_SQL} as mcd_criteria from w_feed"


@query("mcd_classify", "etl_unique_id string, mcd_criteria string", "select etl_unique_id, mcd_criteria from o_mcd")
def mcd_classify(w):
    return w.feed.withColumn("mcd_criteria", mt.mcd_classify(w.feed))


PEOPLE = ["address_line_1", "first_name", "last_name", "non_usa_postal_code", "zip_code"]


def _group_sql() -> str:
    mark = lambda cols: " || '|' || ".join(f"coalesce({c}, '~')" for c in cols)
    return f"""case mcd_criteria when 'mcd_loyaltyid' then mcd_criteria || '|' || {mark(['implied_loyalty_id'])}
      when 'mcd_name_address_us' then mcd_criteria || '|' || {mark(mt.US_COLUMNS)}
      when 'mcd_name_address_canada' then mcd_criteria || '|' || {mark(mt.CANADA_COLUMNS)}
      when 'mcd_bankcard' then mcd_criteria || '|' || {mark(['tender_number'] + PEOPLE)}
      when 'mcd_email' then mcd_criteria || '|' || {mark(['email_address'] + PEOPLE)}
      when 'mcd_phone' then mcd_criteria || '|' || {mark(['phone'] + PEOPLE)} end"""


CHECK_VIEWS["o_group"] = f"select *, {_group_sql()} as grp from o_mcd"


def new_keys_sql(rows: str) -> str:
    """Member keys that creation gives to the rows of a check view with columns of o_group."""
    return f"""select r.etl_unique_id, r.mcd_criteria, coalesce(k.member_key, -1) as member_key from ({rows}) r
      left join (select grp, (select max(member_key) from w_member) + row_number() over (order by grp) as member_key
        from (select distinct grp from ({rows}) d where grp is not null) g) k on k.grp = r.grp"""


@query("new_member_keys", "etl_unique_id string, mcd_criteria string, member_key bigint",
       new_keys_sql("select * from o_group"))
def new_member_keys(w):
    return mt.new_member_keys(w.feed, w.member)


def record_info_sql(member_key: str = "member_key") -> str:
    yes = lambda cond: f"case when {cond} then 'YES' else 'NO' end"
    filled = lambda c: f"coalesce(trim({c}), '') <> ''"
    carded = f"{filled('tender_number')} and {filled('tender_type')}"
    flags = " || ".join([
        yes(f"{filled('first_name')} or {filled('last_name')}"),
        yes(f"{filled('address_line_1')} or {filled('zip_code')} or {filled('non_usa_postal_code')}"),
        yes(filled("email_address")), yes(filled("phone")), "'NO'",
        yes(f"{carded} and t.is_plcc = 'YES'"), yes(f"{carded} and t.is_credit_card = 'YES'"),
        yes(filled("implied_loyalty_id")), yes(f"{member_key} <> -1")])
    dim = " || ".join(f"upper(trim({c}))" for c in mt.RECORD_INFO_COLUMNS)
    return f"""select x.etl_unique_id, coalesce(d.record_info_key, -1) as record_info_key from (
      select f.etl_unique_id, {flags} as flags from w_feed f left join w_card_type t on t.tender_type_code = f.tender_type
        left join o_hit_email h on h.id = f.etl_unique_id) x
      left join (select record_info_key, {dim} as flags from w_record_info) d on d.flags = x.flags"""


@query("record_info_key", "etl_unique_id string, record_info_key bigint", record_info_sql("coalesce(h.member_key, -1)"))
def record_info_key(w):
    return mt.record_info_key(mt.match_waterfall(w.feed, lookups(w), ["email"]), w.record_info, w.card_type)


@query("source_key_rule", "etl_unique_id string, till_source_key int, gender_source_key int", """
  select etl_unique_id, case when h.code in (4, 10, 7, 9, 13, 14, 11) then case when s.retail_web_flag = 'WEB' then 47 else 7 end
    when s.retail_web_flag = 'WEB' then 5 else 6 end as till_source_key,
    case when lower(gender) like 'm%' then 1561 else 1560 end as gender_source_key
  from w_feed f left join w_store s on s.store_key = f.store_key
    left join (select id, 14 as code from o_hit_email) h on h.id = f.etl_unique_id""")
def source_key_rule(w):
    matched = mt.match_waterfall(w.feed, lookups(w), ["email"])
    return (matched.join(broadcast_if_small(w.store.select("store_key", "retail_web_flag")), "store_key", "left")
            .withColumn("till_source_key", mt.till_source_key(F.col("retail_web_flag"), F.col("match_key")))
            .withColumn("gender_source_key", mt.gender_source_key(F.col("gender"), 1561, 1560)))
