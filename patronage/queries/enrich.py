"""Queries of enrichment and indicators."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.joins import explode_key_list
from ..operators.rewrite import read_by_key, store_by_key
from ..operators.sets import union_all
from ..operators.staging import staging_folder
from ..plans import enrich as en, kpi
from ..registry import CHECK_VIEWS, query
from ..warehouse import INLINE, VIEWS
from .core import MILES

DAY = "2001-08-01"

VIEWS["w_enr"] = """
select member_key, household_key, first_name, last_name, address1, zip_code, case when member_key % 2 = 0 then 'yes' else 'NO' end as valid_email, lower(email_address) as email_address,
  case when member_key % 3 = 0 then 'YES' else 'NO' end as email_consent, date '1999-01-01' as email_consent_date, direct_mail_consent, direct_mail_consent_date,
  is_dm_marketable, is_em_marketable, is_sms_marketable, case member_key % 5 when 0 then 'CUSTOMER' when 1 then 'PURCHASER' when 2 then 'REQUESTER' else null end as record_type,
  first_trxn_date, first_trxn_store_key, last_store_purchase_date as last_store_purch_date, last_web_purchase_date as last_web_purch_date, latitude, longitude, loyalty_id,
  case when member_key % 9 = 0 then cast(2229 as int) else original_source_key end as current_source_key, case when member_key % 10 = 0 then 'YES' else null end as is_plcc_request, 'NO' as is_plcc,
  case member_key % 7 when 0 then '1' when 1 then ' active' when 2 then '3' when 3 then 'merged' else 'odd' end as member_status, customer_introduction_date, ip_code,
  case when member_key % 4 = 0 then 'PROSPECT' else 'RECORD' end as old_type, date '2001-01-01' + cast(member_key % 200 as int) as customer_add_date, gender, tier_key, batch_id, status
from {w_member}
"""
VIEWS["w_src"] = """
select distinct p_size % 12 as source_key, case p_size % 12 when 3 then 'ADOBE' else 'X' end as source_code, case when p_size % 12 = 1 then 'YES' else 'NO' end as is_prospect,
  case when p_size % 12 = 2 then 'YES' else 'NO' end as is_mail_request, case when p_size % 12 = 4 then 'YES' else 'NO' end as is_sms_request from {part}
"""
VIEWS["w_scoring"] = """
select k + 1 as member_key, case when k % 17 = 0 then cast(-1 as bigint) else cast(floor(k / 3) as bigint) + 1 end as household_key, cast(k % 18 as int) as segment_rank,
  date '2001-07-04' as last_updated_date from {w_base} where k % 4 <> 3
union all
select k + 1 as member_key, cast(floor(k / 3) as bigint) + 1 as household_key, cast((k + 5) % 18 as int) as segment_rank, date '2001-06-04' as last_updated_date from {w_base}
"""
VIEWS["w_tierhist"] = """
select event_id as id, user_id + 1 as member_key, cast(event_id % 5 as bigint) as tier_key, cast(ts as date) as tier_begin_date from {events}
"""
VIEWS["w_tiernames"] = """
select cast(r_regionkey as bigint) as tier_key, case r_regionkey when 0 then ' ' when 1 then 'N/A' when 2 then 'A-List' else 'BaseTier' end as tier_name from {region}
"""
VIEWS["w_plcards"] = """
select tokenized_cc_nbr, cast(card_type_key as int) as card_type_key, member_key, is_primary_account_holder, last_updated_date, cast(8 + member_key % 2 as int) as source_key,
  case when open_close_ind = 'C' then date '2001-01-01' else null end as closed_date from {w_card_history}
union all
select tokenized_cc_nbr, cast(1 as int) as card_type_key, member_key, null as is_primary_account_holder, date '2001-07-07' as last_updated_date, cast(300 as int) as source_key, cast(null as date) as closed_date
from {w_card_history} where member_key % 6 = 0
"""
VIEWS["w_mail"] = """
select member_key, lower(trim(email_address)) as email_address, max(email_consent) as email_consent, max(valid_email) as valid_email, max(best_email_flag) as best_email_flag,
  max(is_loyalty_email) as is_loyalty_email, max(consent_date) as consent_date, member_key as mme_id from {w_multi_email} group by member_key, lower(trim(email_address))
"""
VIEWS["w_deliv"] = """
select member_key * 2 as fact_delivery_data_id, member_key, email_address, cast(1 + member_key % 2 as string) as status, cast(member_key % 7 as string) as failure_reason, mme_id,
  date '2001-07-01' as event_date, date '2001-04-01' + cast(member_key % 120 as int) as delivery_contact_date from {w_mail} where member_key % 5 <> 0
union all
select member_key * 2 + 1 as fact_delivery_data_id, member_key, email_address, '2' as status, '1' as failure_reason, mme_id, date '2001-07-02' as event_date, date '2001-07-02' as delivery_contact_date
from {w_mail} where member_key % 6 = 0
"""
VIEWS["w_clicks"] = """
select member_key as fact_click_data_id, member_key, email_address, mme_id, cast(member_key % 4 as int) as url_type, date '2000-06-01' + cast((member_key * 3) % 420 as int) as log_date
from {w_mail} where member_key % 3 <> 1
"""
for _n in ("w_src", "w_tierhist", "w_tiernames"):
    INLINE.add(_n)

LINES = "w_trxn"


def lines(w):
    return w.trxn


# ---------------------------------------------------------------- checking views, one per step

CHECK_VIEWS["o_mail"] = """
select * from (select *, row_number() over (partition by member_key order by consent_date desc nulls last, email_address) as rn from w_mail where best_email_flag = 'YES') x where rn = 1
"""
CHECK_VIEWS["o_phone_best"] = """
select * from (select *, row_number() over (partition by member_key order by consent_date desc nulls last, phone_number) as rn from w_multi_phone where best_mobile_flag = 'YES') x where rn = 1
"""
CHECK_VIEWS["o_market"] = """
select m.member_key, case when trim(address1) <> '' and trim(last_name) <> '' and trim(zip_code) <> '' then 'YES' else 'NO' end as dm,
  case when b.valid_email = 'YES' and b.email_consent = 'YES' then 'YES' else 'NO' end as em from w_enr m left join o_mail b on b.member_key = m.member_key
"""
CHECK_VIEWS["o_pref"] = """
select * from (select t.member_key, t.store_key, s.retail_web_flag, row_number() over (partition by t.member_key order by n desc, spend desc, last desc, t.store_key) as rn
  from (select member_key, store_key, count(distinct trxn_id) as n, sum(retail_amount) as spend, max(trxn_date) as last from w_trxn group by 1, 2) t
  join w_store s on s.store_key = t.store_key where s.open_closed_ind = 'OPEN') x where rn = 1
"""
CHECK_VIEWS["o_near"] = f"""
select member_key, max(store_key) filter (where r = 1) as k1, max(store_key) filter (where r = 2) as k2, max(d) filter (where r = 1) as d1, max(d) filter (where r = 2) as d2 from (
  select *, row_number() over (partition by member_key order by d, store_key) as r from (
    select m.member_key, s.store_key, {MILES} as d from w_enr m, w_store s where m.latitude is not null and s.open_closed_ind = 'OPEN') x) y group by member_key
"""
CHECK_VIEWS["o_dist"] = f"""
select m.member_key, p.store_key as pref, case when s.district_code = '97' then -1.0 when s.open_closed_ind = 'OPEN' then {MILES} end as pd, k1, k2, d1, d2, m.latitude, m.longitude
from w_enr m left join o_pref p on p.member_key = m.member_key left join w_store s on s.store_key = p.store_key left join o_near n on n.member_key = m.member_key
"""
CHECK_VIEWS["o_hhm"] = "select member_key, household_key from w_member where household_key <> -1"
CHECK_VIEWS["o_besthh"] = """
select member_key from (select m.member_key, row_number() over (partition by coalesce(h.household_key, -1) order by case when s.segment_rank > 0 then s.segment_rank else 99 end,
    t.last desc nulls last, m.member_key) as rn
  from w_enr m left join o_hhm h on h.member_key = m.member_key
  join (select * from (select *, row_number() over (partition by member_key order by last_updated_date desc, segment_rank) as q from w_scoring where household_key <> -1) a where q = 1) s on s.member_key = m.member_key
  left join (select member_key, max(trxn_date) as last from w_trxn group by 1) t on t.member_key = m.member_key) x where rn = 1
"""
CHECK_VIEWS["o_tier"] = """
select h.member_key, h.tier_key, case when trim(n.tier_name) in ('', 'N/A') then null else n.tier_name end as tier_name from (
  select *, row_number() over (partition by member_key order by id desc) as rn from w_tierhist) h left join w_tiernames n on n.tier_key = h.tier_key where rn = 1
"""
CHECK_VIEWS["o_plccard"] = """
select member_key, max(case when closed_date is null and is_primary_account_holder is not null then 1 else 0 end) as is_open from (
  select *, row_number() over (partition by member_key, tokenized_cc_nbr order by last_updated_date desc, card_type_key) as rn from w_plcards
  where source_key in (8, 9, 300) and card_type_key in (1, 2, 25)) x where rn = 1 group by member_key
"""
CHECK_VIEWS["o_gender"] = """
select member_key, case when m = n then 'MO' when w = n then 'WO' when m > w then 'DLM' else 'DLW' end as g from (
  select member_key, count(*) filter (where gender = 'M') as m, count(*) filter (where gender = 'W') as w, count(*) as n
  from (select distinct member_key, trxn_id, trxn_date, product_key from w_trxn) l join w_product p on p.product_key = l.product_key group by member_key) x
"""


# ---------------------------------------------------------------- member steps

@query("enrich_best_email", "member_key bigint, email_address string, valid_email string, email_consent string, email_consent_date date, action_flag string", """
  select m.member_key, coalesce(b.email_address, m.email_address) as email_address, case when b.valid_email = 'YES' then 'YES' else 'NO' end as valid_email,
    case when b.email_consent = 'YES' then 'YES' else 'NO' end as email_consent, coalesce(b.consent_date, m.email_consent_date) as email_consent_date,
    case when upper(m.valid_email) = b.valid_email and upper(m.email_address) = upper(b.email_address) and m.email_consent = b.email_consent and m.email_consent_date = b.consent_date
      then 'NC' else 'U' end as action_flag
  from w_enr m left join o_mail b on b.member_key = m.member_key""")
def enrich_best_email(w):
    return en.best_email(w.enr, w.mail)


@query("enrich_marketability", "member_key bigint, is_dm_marketable string, is_em_marketable string",
       "select member_key, dm as is_dm_marketable, em as is_em_marketable from o_market")
def enrich_marketability(w):
    return en.marketability(en.best_email(w.enr, w.mail))


AUDIENCE = """case when m.member_key in (select member_key from w_trxn) then case when {mk} then 'CUSTOMER' when record_type = 'CUSTOMER' then record_type else 'PURCHASER' end
    when record_type in ('CUSTOMER', 'PURCHASER') then record_type when s.is_prospect = 'YES' then 'PROSPECT'
    when s.is_mail_request = 'YES' or s.is_sms_request = 'YES' or s.source_code in ('ADOBE', '3C') then 'REQUESTER'
    when current_source_key in (2229, 1236, 1237, 1064, 1065) or record_type = 'REQUESTER' then record_type else 'RECORD' end"""


@query("enrich_audience", "member_key bigint, record_type string", f"""
  select m.member_key, {AUDIENCE.format(mk="is_dm_marketable = 'YES' or is_em_marketable = 'YES' or is_sms_marketable = 'YES'")} as record_type
  from w_enr m left join w_src s on s.source_key = m.current_source_key""")
def enrich_audience(w):
    return en.audience(w.enr, lines(w), w.src)


@query("enrich_phone", "member_key bigint, phone_nbr bigint, phone_type string, sms_consent string, sms_consent_date date", """
  select m.member_key, phone_number as phone_nbr, phone_type, phone_consent as sms_consent, consent_date as sms_consent_date
  from w_enr m left join o_phone_best b on b.member_key = m.member_key""")
def enrich_phone(w):
    return en.phone(w.enr, w.multi_phone)


@query("enrich_sms", "member_key bigint, is_sms_marketable string", """
  select member_key, case when member_key in (select member_key from w_multi_phone where lower(phone_consent) = 'yes') then 'YES' else 'NO' end as is_sms_marketable from w_enr""")
def enrich_sms(w):
    return en.sms(w.enr, w.multi_phone)


DM_CONSENT = """
  select m.member_key, case when m.direct_mail_consent = c.consent_value then m.direct_mail_consent else c.consent_value end as direct_mail_consent,
    case when m.direct_mail_consent = c.consent_value then m.direct_mail_consent_date else c.consent_date end as direct_mail_consent_date
  from w_enr m left join (select * from (select *, row_number() over (partition by member_key order by consent_date desc, consent_value) as rn from w_consent
    where consent_type = 'DM') x where rn = 1) c on c.member_key = m.member_key"""


@query("enrich_dm_consent", "member_key bigint, direct_mail_consent string, direct_mail_consent_date date", DM_CONSENT)
def enrich_dm_consent(w):
    return en.dm_consent(w.enr, w.consent)


TRXN_FLAGS = """
  select m.member_key, coalesce(f.d, m.first_trxn_date) as first_trxn_date, coalesce(f.s, m.first_trxn_store_key) as first_trxn_store_key,
    coalesce(f.shop, m.last_store_purch_date) as last_store_purch_date, coalesce(f.web, m.last_web_purch_date) as last_web_purch_date
  from w_enr m left join (select t.member_key, min(trxn_date) as d, arg_min(t.store_key, (trxn_date, t.store_key)) as s, max(trxn_date) filter (where district_code = '97') as web,
    max(trxn_date) filter (where district_code is distinct from '97') as shop from w_trxn t left join w_store s on s.store_key = t.store_key group by t.member_key) f on f.member_key = m.member_key"""


@query("enrich_trxn_flags", "member_key bigint, first_trxn_date date, first_trxn_store_key bigint, last_store_purch_date date, last_web_purch_date date", TRXN_FLAGS)
def enrich_trxn_flags(w):
    return en.trxn_flags(w.enr, lines(w), w.store)


@query("enrich_gender_merch", "member_key bigint, cm_gender_merch_descr string",
       "select m.member_key, g as cm_gender_merch_descr from w_enr m left join o_gender o on o.member_key = m.member_key")
def enrich_gender_merch(w):
    return en.gender_merch(w.enr, lines(w), w.product)


@query("enrich_preferred_store", "member_key bigint, preferred_store_key bigint, preferred_channel string",
       "select m.member_key, p.store_key as preferred_store_key, p.retail_web_flag as preferred_channel from w_enr m left join o_pref p on p.member_key = m.member_key", headline=True)
def enrich_preferred_store(w):
    return en.preferred_store(w.enr, lines(w), w.store)


@query("enrich_store_distance", "member_key bigint, distance_to_preferred_store double, closest_store_key bigint, second_closest_store_key bigint, distance_to_closest_store double, "
       "distance_to_sec_closest_store double", """
  select member_key, pd as distance_to_preferred_store, k1 as closest_store_key, k2 as second_closest_store_key, d1 as distance_to_closest_store, d2 as distance_to_sec_closest_store from o_dist""")
def enrich_store_distance(w):
    return en.store_distance(en.preferred_store(w.enr, lines(w), w.store), w.store, w.enr)


WEB_STORES = [10, 20, 30]
STATES = """case when pref in (10, 20, 30) and pd = -1 then 'E-COMMERCE' when pref > -1 and pref not in (10, 20, 30) and pd > -1 then 'CALCULATED'
    when pref = -1 and pd is null and latitude is null and longitude is null then 'NO PREFERRED STORE' when pref > -1 and pd is null and (latitude is null or longitude is null) then 'CANNOT MEASURE'
    else '(RE)CALCULATE' end as preferred_store_state, case when k1 > -1 and d1 is not null then 'CALCULATED' else '(RE)CALCULATE' end as closest_store_state,
    case when k2 > -1 and d2 is not null then 'CALCULATED' else '(RE)CALCULATE' end as second_closest_store_state"""


@query("enrich_store_state", "member_key bigint, preferred_store_state string, closest_store_state string, second_closest_store_state string", f"select member_key, {STATES} from o_dist")
def enrich_store_state(w):
    return en.store_states(en.store_distance(en.preferred_store(w.enr, lines(w), w.store), w.store, w.enr), WEB_STORES)


def _hhm(w):
    return explode_key_list(w.household, "associated_member_key", "member_key").select("household_key", "member_key")


@query("enrich_household", "member_key bigint, household_key bigint", "select m.member_key, coalesce(h.household_key, -1) as household_key from w_enr m left join o_hhm h on h.member_key = m.member_key")
def enrich_household(w):
    return en.household(w.enr, _hhm(w))


@query("enrich_best_household", "member_key bigint, best_household_member string", """
  select member_key, case when member_key in (select member_key from o_besthh) then 'YES' else 'NO' end as best_household_member from w_enr""")
def enrich_best_household(w):
    return en.best_household(en.household(w.enr, _hhm(w)), w.scoring, lines(w))


@query("enrich_loyalty_flag", "member_key bigint, is_loyalty_member string",
       "select member_key, case when trim(loyalty_id) <> '' then 'YES' else 'NO' end as is_loyalty_member from w_enr")
def enrich_loyalty_flag(w):
    return en.loyalty_flag(w.enr)


@query("enrich_global_opt_out", "member_key bigint, global_opt_out string", """
  select member_key, case when household_key <> -1 and household_key in (select household_key from w_work_kill_list) then 'YES' end as global_opt_out from w_enr""")
def enrich_global_opt_out(w):
    return en.global_opt_out(w.enr, w.work_kill_list)


@query("enrich_tier", "member_key bigint, current_tier_key bigint, tier_name string",
       "select m.member_key, t.tier_key as current_tier_key, t.tier_name from w_enr m left join o_tier t on t.member_key = m.member_key")
def enrich_tier(w):
    return en.tier(w.enr, w.tierhist, w.tiernames)


@query("enrich_plcc", "member_key bigint, is_plcc string", """
  select m.member_key, case when is_plcc_request = 'YES' or is_open = 1 then 'YES' else 'NO' end as is_plcc from w_enr m left join o_plccard p on p.member_key = m.member_key""")
def enrich_plcc(w):
    return en.plcc(w.enr, w.plcards, DAY)


# columns of w_enr that the steps may change
STORED = ["valid_email", "email_address", "email_consent", "email_consent_date", "direct_mail_consent", "direct_mail_consent_date", "is_dm_marketable",
          "is_em_marketable", "is_sms_marketable", "record_type", "first_trxn_date", "first_trxn_store_key", "last_store_purch_date",
          "last_web_purch_date", "household_key", "is_plcc", "member_status"]


@query("enrich_member", "member_key bigint, email_address string, phone_nbr bigint, is_dm_marketable string, is_em_marketable string, is_sms_marketable string, record_type string, "
       "first_trxn_date date, preferred_store_key bigint, closest_store_key bigint, preferred_store_state string, household_key bigint, best_household_member string, is_loyalty_member string, "
       "global_opt_out string, cm_gender_merch_descr string, current_tier_key bigint, is_plcc string, member_status string, first_trxn_date_key bigint, action_flag string", f"""
  with x as (select m.*, coalesce(b.email_address, m.email_address) as mail, k.dm, k.em, case when m.member_key in (select member_key from w_multi_phone where lower(phone_consent) = 'yes') then 'YES' else 'NO' end as sms,
      coalesce(h.household_key, -1) as hk, case when b.valid_email = 'YES' then 'YES' else 'NO' end as ve, case when b.email_consent = 'YES' then 'YES' else 'NO' end as ec,
      coalesce(b.consent_date, m.email_consent_date) as ed from w_enr m left join o_mail b on b.member_key = m.member_key left join o_market k on k.member_key = m.member_key left join o_hhm h on h.member_key = m.member_key)
  , y as (select m.member_key, mail as email_address, ve as valid_email, ec as email_consent, ed as email_consent_date, dc.direct_mail_consent, dc.direct_mail_consent_date,
    f.first_trxn_store_key, f.last_store_purch_date, f.last_web_purch_date, p.phone_number as phone_nbr, dm as is_dm_marketable, em as is_em_marketable, sms as is_sms_marketable,
    {AUDIENCE.format(mk="dm = 'YES' or em = 'YES' or sms = 'YES'")} as record_type, f.first_trxn_date, d.pref as preferred_store_key, d.k1 as closest_store_key, d.preferred_store_state, hk as household_key,
    case when m.member_key in (select member_key from o_besthh) then 'YES' else 'NO' end as best_household_member, case when trim(loyalty_id) <> '' then 'YES' else 'NO' end as is_loyalty_member,
    case when hk <> -1 and hk in (select household_key from w_work_kill_list) then 'YES' end as global_opt_out, g as cm_gender_merch_descr, t.tier_key as current_tier_key,
    case when is_plcc_request = 'YES' or is_open = 1 then 'YES' else 'NO' end as is_plcc,
    case upper(trim(member_status)) when '1' then 'ACTIVE' when 'ACTIVE' then 'ACTIVE' when '3' then 'CLOSED' when 'MERGED' then 'MERGED' end as member_status, coalesce(dd.date_key, -1) as first_trxn_date_key
  from x m left join w_src s on s.source_key = m.current_source_key left join o_phone_best p on p.member_key = m.member_key left join ({TRXN_FLAGS}) f on f.member_key = m.member_key
  left join (select *, {STATES} from o_dist) d on d.member_key = m.member_key left join o_gender o on o.member_key = m.member_key left join o_tier t on t.member_key = m.member_key
  left join o_plccard c on c.member_key = m.member_key left join w_date dd on dd.sdate = f.first_trxn_date left join ({DM_CONSENT}) dc on dc.member_key = m.member_key)
  select y.*, case when {' and '.join(f'y.{c} is not distinct from e.{c}' for c in en.ENRICHED if c in STORED)} then 'NC' else 'U' end as action_flag
  from y join w_enr e on e.member_key = y.member_key""", headline=True)
def enrich_member(w):
    return en.enrich_member(w.enr, w.mail, w.multi_phone, w.consent, lines(w), w.store, w.product, w.src, _hhm(w), w.scoring, w.work_kill_list,
                            w.tierhist, w.tiernames, w.plcards, w.date, ["first_trxn_date", "last_store_purch_date"], WEB_STORES, DAY)


@query("enrich_household_segment", "household_key bigint, record_type string, scoring_model_segment_key bigint, scoring_model_key bigint", """
  select h.household_key, k.record_type, s.scoring_model_segment_key, case when s.scoring_model_segment_key is not null then 41 end as scoring_model_key from w_household h
  left join (select household_key, min(segment_rank) as r from w_scoring group by 1) b on b.household_key = h.household_key
  left join w_work_segs s on s.segment_rank = b.r and s.model_id = 108
  left join (select household_key, case when count(distinct record_type) = 1 and count(*) = count(record_type) then min(record_type) when count(distinct record_type) = 1 then min(record_type) end as record_type
    from w_member where household_key <> -1 group by 1) k on k.household_key = h.household_key""")
def enrich_household_segment(w):
    return en.household_segment(w.household, w.scoring, w.work_segs.filter("model_id = 108"), w.work_mods.filter("model_id = 108"), w.member)


# ---------------------------------------------------------------- e-mails and phones

CHECK_VIEWS["o_flags"] = """
select e.*, case when d.status = '2' and d.failure_reason = '1' then 'NO' else 'YES' end as nhb, case when d.status = '2' and d.failure_reason in ('2', '3', '4', '5', '20') then 'NO' else 'YES' end as nsb,
  c.log_date, c.url_type, count(*) over (partition by e.member_key, c.log_date) as same_click, max(c.log_date) over (partition by e.member_key) as newest
from w_mail e left join (select * from (select *, row_number() over (partition by member_key, email_address order by fact_delivery_data_id) as rn from w_deliv) x where rn = 1) d
  on d.member_key = e.member_key and d.email_address = e.email_address
left join w_clicks c on c.member_key = e.member_key and c.email_address = e.email_address
"""
CHECK_VIEWS["o_flags2"] = """
select *, case when log_date is not distinct from newest and same_click > 1 and url_type = 2 then 'YES' else 'NO' end as ro, 'NO' as rc,
  case when date_diff('day', log_date, date '2001-08-01') <= 365 and url_type = 2 then 'YES' else 'NO' end as mo from o_flags
"""
CHECK_VIEWS["o_bestmail"] = """
select *, case when c1 = 1 then email_consent = 'YES' when c2 = 1 then valid_email = 'YES' when c3 = 1 then nhb = 'YES' when c4 = 1 then nsb = 'YES' when c5 = 1 then ro = 'YES'
  when c7 = 1 then mo = 'YES' else email_address = first end as is_best from (
  select *, count(*) filter (where email_consent = 'YES') over w as c1, count(*) filter (where valid_email = 'YES') over w as c2, count(*) filter (where nhb = 'YES') over w as c3,
    count(*) filter (where nsb = 'YES') over w as c4, count(*) filter (where ro = 'YES') over w as c5, count(*) filter (where mo = 'YES') over w as c7, min(email_address) over w as first
  from o_flags2 window w as (partition by member_key)) x
"""


@query("enrich_email_bounce", "member_key bigint, email_address string, no_hard_bounce string, no_soft_bounce string",
       "select member_key, email_address, nhb as no_hard_bounce, nsb as no_soft_bounce from o_flags")
def enrich_email_bounce(w):
    return en.email_bounce(w.mail, w.deliv)


@query("enrich_email_flags", "member_key bigint, email_address string, recently_opened_flag string, recent_email_consent_flag string, most_opened_12_months string",
       "select member_key, email_address, ro as recently_opened_flag, rc as recent_email_consent_flag, mo as most_opened_12_months from o_flags2")
def enrich_email_flags(w):
    return en.email_flags(w.mail, w.deliv, w.clicks, DAY)


@query("enrich_email_best", "member_key bigint, email_address string, best_email_flag string, action_flag string", """
  select member_key, email_address, case when is_best then 'YES' else 'NO' end as best_email_flag,
    case when case when is_best then 'YES' else 'NO' end = best_email_flag then 'NCD' else 'U' end as action_flag from o_bestmail""")
def enrich_email_best(w):
    return en.email_best(en.email_flags(w.mail, w.deliv, w.clicks, DAY))


@query("enrich_email_activity", "member_key bigint, email_address string, active_inactive_flag string", """
  select member_key, email_address, case when (mme_id, email_address) in (select (mme_id, email_address) from w_deliv where delivery_contact_date >= date '2001-05-03')
    and mme_id in (select mme_id from w_clicks where log_date >= date '2001-05-03' and url_type in (1, 2)) then 'ACTIVE' else 'INACTIVE' end as active_inactive_flag from w_mail""")
def enrich_email_activity(w):
    return en.email_activity(w.mail, w.deliv, w.clicks, DAY)


CHECK_VIEWS["o_lastbuy"] = """
select member_key, trxn_date, trxn_time_key, sum(total_line_amnt_after_discount) as last_spend from (
  select *, rank() over (partition by member_key order by trxn_date desc, trxn_time_key desc) as r from w_trxn) x where r = 1 group by 1, 2, 3
"""
CHECK_VIEWS["o_seg"] = """
select member_key, segment_rank from (select *, row_number() over (partition by member_key order by last_updated_date desc, segment_rank) as rn from w_scoring) x where rn = 1
"""


def latest_scores(w):
    from ..operators.ranking import latest_per_key, newest
    return latest_per_key(w.scoring, "member_key", [newest("last_updated_date"), F.col("segment_rank")])


@query("enrich_email_best_member", "member_key bigint, email_address string, best_member string", """
  select member_key, email_address, case when rn = 1 then 'YES' else 'NO' end as best_member from (
    select e.member_key, e.email_address, row_number() over (partition by e.email_address order by coalesce(s.segment_rank, 999), b.trxn_date desc nulls last, b.trxn_time_key desc nulls last,
      b.last_spend desc nulls last, e.member_key) as rn from w_mail e left join o_lastbuy b on b.member_key = e.member_key left join o_seg s on s.member_key = e.member_key) x""")
def enrich_email_best_member(w):
    return en.email_best_member(w.mail, en.last_purchase(lines(w), "trxn_time_key", "total_line_amnt_after_discount"), latest_scores(w))


@query("enrich_email_loyalty_unique", "member_key bigint, email_address string, is_loyalty_email string", """
  with n as (select member_key, email_address, is_loyalty_email, case when (member_key, email_address) in (select (member_key, email_address) from w_enr) then 0 else 1 end as new from w_mail),
  a as (select *, case when is_loyalty_email = 'YES' and row_number() over (partition by member_key, is_loyalty_email order by new, member_key, email_address) > 1 then 'NO' else is_loyalty_email end as l1 from n)
  select member_key, email_address, case when l1 = 'YES' and row_number() over (partition by email_address, l1 order by new, member_key, email_address) > 1 then 'NO' else l1 end as is_loyalty_email from a""")
def enrich_email_loyalty_unique(w):
    return en.email_loyalty_unique(w.mail, w.enr)


@query("enrich_phone_best", "member_key bigint, phone_number bigint, phone_type string, best_mobile_flag string", """
  select member_key, phone_number, phone_type, case when phone_type = 'MOBILE' and row_number() over (partition by member_key, phone_type order by acknowledgements desc, consent_date desc nulls last,
    best_mobile_flag desc, phone_number) = 1 then 'YES' else 'NO' end as best_mobile_flag from w_multi_phone""")
def enrich_phone_best(w):
    return en.phone_best(w.multi_phone)


@query("enrich_phone_best_member", "member_key bigint, phone_number bigint, phone_type string, best_member string", """
  select member_key, phone_number, phone_type, case when phone_type = 'MOBILE' and rn = 1 then 'YES' else 'NO' end as best_member from (
    select p.*, row_number() over (partition by p.phone_number, phone_type order by s.segment_rank nulls first, b.trxn_date desc nulls last, b.trxn_time_key desc nulls last,
      b.last_spend desc nulls last, p.member_key) as rn from w_multi_phone p left join o_lastbuy b on b.member_key = p.member_key left join o_seg s on s.member_key = p.member_key) x""")
def enrich_phone_best_member(w):
    return en.phone_best_member(w.multi_phone, en.last_purchase(lines(w), "trxn_time_key", "total_line_amnt_after_discount"), latest_scores(w))


SCRUB = ("part string, member_key bigint, first_name string, household_key bigint, current_source_key int, direct_mail_consent string, gender string, purge_record_count bigint", """
  with m as (select *, old_type = 'PROSPECT' and customer_add_date >= date '2001-02-01' and date_diff('day', customer_add_date, date '2001-08-01') >= 90 as purge from w_enr)
  select 'current' as part, member_key, case when purge then null else first_name end as first_name, case when purge then -1 else household_key end as household_key,
    case when purge then 776 else current_source_key end as current_source_key, case when purge then 'UNKNOWN' else direct_mail_consent end as direct_mail_consent,
    case when purge then 'UNKNOWN' else gender end as gender, cast(null as bigint) as purge_record_count from m
  union all select 'history', member_key, case when purge then null else first_name end, case when purge then -1 else household_key end, case when purge then 776 else current_source_key end,
    case when purge then 'UNKNOWN' else direct_mail_consent end, case when purge then 'UNKNOWN' else gender end, null from m
  union all select 'counts', date_diff('day', date '2001-01-01', customer_add_date), null, null, null, null, null, count(*) from m where purge group by customer_add_date""")


def _scrubbed(current, history, counts):
    cols = ["member_key", "first_name", "household_key", "current_source_key", "direct_mail_consent", "gender"]
    counted = counts.select(F.lit("counts").alias("part"), F.datediff("customer_add_date", F.lit("2001-01-01").cast("date")).cast("bigint").alias("member_key"), "purge_record_count")
    return union_all([current.select(F.lit("current").alias("part"), *cols), history.select(F.lit("history").alias("part"), *cols), counted], allow_missing=True)


@query("scrub_prospects", *SCRUB)
def scrub_prospects(w):
    member = w.enr.drop("record_type").withColumnRenamed("old_type", "record_type")
    return _scrubbed(*en.scrub_prospects(member, member, "2001-02-01", 90, DAY))


@query("scrub_stored", *SCRUB)
def scrub_stored(w):
    member = w.enr.drop("record_type").withColumnRenamed("old_type", "record_type")
    paths = [f"{staging_folder(w.spark)}/member-{part}-{uuid.uuid4().hex}" for part in ("current", "history")]
    for path in paths:
        store_by_key(member, "member_key", path, 64)
    counts = en.scrub_stored(w.spark, *paths, "2001-02-01", 90, DAY, 64)
    return _scrubbed(*[read_by_key(w.spark, path) for path in paths], counts)


# ---------------------------------------------------------------- indicators

VIEWS["w_kpi_member"] = """
select member_key, loyalty_id, ip_code, case member_key % 3 when 0 then 'YES' when 1 then 'NO' else null end as is_plcc,
  case member_key % 4 when 0 then 'A-List' when 1 then 'BaseTier' else null end as tier_name from {w_member}
"""
VIEWS["w_kpi_old"] = "select member_key, case member_key % 5 when 0 then 'A-List' when 1 then 'BaseTier' else null end as tier_name from {w_member}"
VIEWS["w_kpi_line"] = """
select trxn_id, trxn_date, member_key, store_key, purchase_qty, discount_amount, ring_code_used, case when is_captured_loyalty = 'YES' then 'L' else null end as captured_loyalty_id,
  case when trxn_seq_nbr = 4 then 'I' else null end as implied_loyalty_id from {w_trxn}
"""
VIEWS["w_kpi_sum"] = """
select trxn_id, trxn_date, tender_amount as ttl_amount_after_discount, case when trxn_id % 9 = 0 then 0 else tender_amount end as ttl_amount, case when trxn_id % 4 = 0 then 'NO' else 'YES' end as has_tender,
  cast(trxn_id % 3 as int) as reward_certs_qty from {w_tender_history}
"""
VIEWS["w_kpi_ttype"] = "select tender_type_key, 'type ' || tender_type_code as tender_type_description from {w_tender_type} where tender_type_key <> 4"
for _n in ("w_kpi_member", "w_kpi_old", "w_kpi_line", "w_kpi_sum", "w_kpi_ttype"):
    INLINE.add(_n)
CHECK_VIEWS["o_kpi_base"] = """
select 'CONSENT VALUE RETAIL' as kpi_name, consent_value_retail as kpi_attribute_name, count(*) as v, date '2001-08-01' as business_date from w_brand_consent group by 2
union all select 'CONSENT VALUE OUTLET', consent_value_outlet, count(*), date '2001-08-01' from w_brand_consent group by 2
union all select 'CONSENT VALUE NEXT', consent_value_next, count(*), date '2001-08-01' from w_brand_consent group by 2
union all select 'IS PLCC', is_plcc, count(*), date '2001-08-01' from w_kpi_member group by 2
union all select 'MEMBER COUNT', null, count(*), date '2001-08-01' from w_kpi_member
union all select 'LOYALTY MEMBERS COUNT', null, count(*), date '2001-08-01' from w_kpi_member where trim(loyalty_id) <> ''
union all select 'LOYALTY MEMBERS WITH LENGTH OF LOYALTY ID=13 AND IPCODE NOT NULL COUNT', null, count(*), date '2001-08-01' from w_kpi_member where length(loyalty_id) = 13 and ip_code is not null
union all select 'A-LIST TIER', null, count(*), date '2001-08-01' from w_kpi_member where tier_name = 'A-List'
union all select 'BASE TIER', null, count(*), date '2001-08-01' from w_kpi_member where tier_name = 'BaseTier'
union all select 'MOVEMENT FROM BASE TIER TO A-LIST TIER', null, count(*), date '2001-08-01' from w_kpi_member a join w_kpi_old b on a.member_key = b.member_key where a.tier_name = 'A-List' and b.tier_name = 'BaseTier'
union all select 'MOVEMENT FROM A-LIST TIER TO BASE TIER', null, count(*), date '2001-08-01' from w_kpi_member a join w_kpi_old b on a.member_key = b.member_key where a.tier_name = 'BaseTier' and b.tier_name = 'A-List'
union all select 'TENDER TYPE', tender_type_description, count(distinct trxn_id), trxn_date from w_tender_history t left join w_kpi_ttype y on y.tender_type_key = t.tender_type_key group by 2, trxn_date
union all select 'EMPLOYEE TRANSACTIONS', null, count(distinct trxn_id), trxn_date from w_kpi_line where member_key in (select member_key from w_employee where employee_status <> 'T') group by trxn_date
union all select 'TRANSACTION CHANNEL', case zone_code when 8 then 'EFO' when 1 then 'RETAIL' when 2 then 'RETAIL' when 6 then 'EComm' end, count(*), trxn_date
  from w_kpi_line l left join w_store s on s.store_key = l.store_key and open_closed_ind = 'OPEN' group by zone_code, trxn_date
union all select 'LOYALTY TRANSACTIONS BY TIER', tier_name, count(distinct trxn_id), trxn_date from w_kpi_line l join w_kpi_member m on m.member_key = l.member_key
  where trim(loyalty_id) <> '' and (captured_loyalty_id is not null or implied_loyalty_id is not null) group by tier_name, trxn_date
"""
CHECK_VIEWS["o_kpi_trxn"] = """
select 'PRODUCTS SOLD' as kpi_name, sum(purchase_qty) as v, trxn_date as business_date from w_kpi_line group by trxn_date
union all select 'DISCOUNTS', sum(discount_amount), trxn_date from w_kpi_line group by trxn_date
union all select 'CAPTURED LOYALTY TRANSACTIONS', count(distinct trxn_id), trxn_date from w_kpi_line where captured_loyalty_id is not null group by trxn_date
union all select 'IMPLIED LOYALTY TRANSACTIONS', count(distinct trxn_id), trxn_date from w_kpi_line where implied_loyalty_id is not null group by trxn_date
union all select 'TRANSACTIONS WITH REWARD APPLIED – DETAIL', count(distinct trxn_id), trxn_date from w_kpi_line where ring_code_used = '1417' group by trxn_date
union all select 'TRANSACTIONS WITH RING CODE 8888', count(distinct trxn_id), trxn_date from w_kpi_line where ring_code_used = '8888' group by trxn_date
union all select 'TOTAL SALE AFTER DISCOUNT', sum(ttl_amount_after_discount), trxn_date from w_kpi_sum group by trxn_date
union all select 'TRANSACTIONS WITH REWARD APPLIED - SUMMARY', count(*), trxn_date from w_kpi_sum where reward_certs_qty > 0 group by trxn_date
union all select 'TRANSACTIONS WITH NO TENDER', count(*), trxn_date from w_kpi_sum where ttl_amount = 0 and has_tender = 'NO' group by trxn_date
"""
KPI = "kpi_name string, kpi_attribute_name string, kpi_attribute_value double, business_date date"


@query("kpi_base", KPI, "select kpi_name, kpi_attribute_name, v as kpi_attribute_value, business_date from o_kpi_base")
def kpi_base(w):
    return kpi.kpi_base(w.kpi_member, w.kpi_old, w.brand_consent, w.tender_history, w.kpi_ttype, w.employee, w.kpi_line, w.store, DAY)


@query("kpi_transaction", KPI, "select kpi_name, cast(null as varchar) as kpi_attribute_name, v as kpi_attribute_value, business_date from o_kpi_trxn", headline=True)
def kpi_transaction(w):
    return kpi.kpi_transaction(w.kpi_line, w.kpi_sum)


@query("kpi_periods", "kpi_name string, kpi_attribute_name string, business_date_cnt double, business_date_minus_one double, sdlw double, wtd_val double, last_week_wtd_val double, mtd double, "
       "ytd double, change_per_wtd double", """
  select kpi_name, 'null' as kpi_attribute_name, d0 as business_date_cnt, d1 as business_date_minus_one, d7 as sdlw, wtd as wtd_val, lwtd as last_week_wtd_val, mtd, ytd,
    (cast(wtd as double) / cast(lwtd as double) - 1) * 100 as change_per_wtd from (
    select kpi_name, sum(v) filter (where business_date = date '2001-07-26') as d0, sum(v) filter (where business_date = date '2001-07-25') as d1, sum(v) filter (where business_date = date '2001-07-19') as d7,
      sum(v) filter (where business_date between date '2001-07-22' and date '2001-07-26') as wtd, sum(v) filter (where business_date between date '2001-07-15' and date '2001-07-19') as lwtd,
      sum(v) filter (where business_date between date '2001-07-01' and date '2001-07-26') as mtd, sum(v) filter (where business_date between date '2001-01-01' and date '2001-07-26') as ytd
    from o_kpi_trxn where business_date between date '2001-01-01' and date '2001-07-26' group by kpi_name) x""")
def kpi_periods(w):
    return kpi.kpi_periods(w.staged("kpi_report", kpi_transaction), "2001-07-26")
