"""Queries of the export layer, first loads and comparison."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.filters import newest_batch
from ..operators.sets import union_all
from ..plans import edw, history as hs
from ..registry import CHECK_VIEWS, query
from ..sources import readers as rd, writers as wr
from ..warehouse import INLINE, VIEWS
from .core import MILES, fresh

DAY, BUSINESS, RUN = "2001-08-01", "2001-03-01", "2001-08-02"

VIEWS["w_exp_member"] = """
select member_key, household_key, loyalty_id, birth_date, gender, record_type, latitude, longitude, last_store_purchase_date as last_store_purch_date,
  last_web_purchase_date as last_web_purch_date, member_status, case when member_key % 3 = 0 then 'YES' else 'NO' end as is_plcc, date '2000-06-01' + cast(member_key % 400 as int) as customer_add_date,
  case when member_key % 4 = 0 then date '2000-06-01' + cast(member_key % 400 as int) else date '2001-02-01' + cast(member_key % 60 as int) end as last_updated_date, first_name, last_name, zip_code
from {w_member}
"""
VIEWS["w_exp_sum"] = """
select trxn_id, max(member_key) as member_key, max(trxn_date) as trxn_date, min(store_key) as store_key,
  sum(case when product_key % 2 = 0 then units else 0 end) as w_units, sum(case when product_key % 2 = 1 then units else 0 end) as m_units,
  sum(case when product_key % 2 = 0 then total_line_amnt_after_discount else 0 end) as w_amount_after_discount,
  sum(case when product_key % 2 = 1 then total_line_amnt_after_discount else 0 end) as m_amount_after_discount, cast(max(trxn_id % 9) as string) as register_nbr, cast(max(trxn_id % 777) as string) as trxn_nbr,
  case when max(trxn_id % 3) = 0 then 'Y' when max(trxn_id % 3) = 1 then 'N' else null end as gift_card_sales_only_ind, max(trxn_date) as last_updated_date
from {w_trxn} group by trxn_id
"""
VIEWS["w_exp_trans"] = """
select trxn_id, 'X' || cast(trxn_id as string) as exp_order_id, case trxn_id % 4 when 0 then 'NULL' when 1 then cast(100 + trxn_id % 60 as string) else null end as demandloc, trxn_date as order_date, trxn_date as ingest_date
from {w_trxn_head} where trxn_id % 5 = 0
"""
VIEWS["w_exp_order"] = """
select lpad(cast(store_key + 99 as string), 8, '0') || cast(year(trxn_date) as string) || lpad(cast(month(trxn_date) as string), 2, '0') || lpad(cast(day(trxn_date) as string), 2, '0')
    || lpad(register_nbr, 10, '0') || '#' || lpad(trxn_nbr, 6, '0') as id_trn, 'INV' || cast(trxn_id as string) as invoicenumber, trxn_date as ingest_date
from {w_exp_sum} where trxn_id % 2 = 0
"""
VIEWS["w_exp_cards"] = """
select member_key, cast(1 + member_key % 2 as int) as card_type_key, cast(8 + member_key % 3 as int) as source_key, date '2000-01-01' + cast(member_key % 900 as int) as account_open_date,
  case when member_key % 5 = 0 then date '2001-05-05' when member_key % 5 = 1 then date '2002-01-01' else null end as closed_date from {w_card_history}
"""
VIEWS["w_visits"] = """
select case when user_id % 3 = 0 then ' LY' || lpad(cast(user_id as string), 11, '0') else null end as loyalty_id, 'm' || cast(user_id as string) as mail_id, cast(ts as date) as visit_date from {events}
"""
VIEWS["w_mailids"] = "select member_key, 'M' || cast(member_key - 1 as string) as mme_id from {w_member}"
VIEWS["w_snap"] = "select member_key, date '2000-12-12' as last_browse_date from {w_member} where member_key % 2 = 0"
VIEWS["w_dedup_hist"] = """
select member_key as old_member_key, member_key - 1 as new_member_key, member_key % 5 = 0 as is_invalid, last_updated_date from {w_member} where member_key % 10 in (4, 8)
"""
VIEWS["w_exp_const"] = """
select constant_id, constant_type, constant_value, date '2001-07-01' as run_date from {w_constant}
union all select constant_id + 500 as constant_id, constant_type, constant_value, date '2001-08-01' as run_date from {w_constant}
"""
for _n in ("w_exp_member", "w_exp_trans", "w_exp_order", "w_exp_cards", "w_visits", "w_mailids", "w_snap", "w_dedup_hist", "w_exp_const"):
    INLINE.add(_n)

# of w_trxn: what the extracts read of each line, and what the summary adds up
HEAD = ["trxn_id", "member_key", "store_key", "trxn_date"]
LINE = [*HEAD, "trxn_seq_nbr", "gift_card_sales_ind"]
SUMMED = ["product_key", "units", "total_line_amnt_after_discount"]


def _translation(w):
    return w.view("w_exp_trans", w_trxn_head=w.view("w_trxn_head"))


FLAG = f"case when last_updated_date <= date '{BUSINESS}' then 'NC' when {{added}} = last_updated_date then 'A' else 'C' end as cc_flag"


@query("edw_change_flag", "member_key bigint, ingest_date date, cc_flag string, run_date date",
       f"select member_key, last_updated_date as ingest_date, {FLAG.format(added='customer_add_date')}, date '{RUN}' as run_date from w_exp_member")
def edw_change_flag(w):
    return edw.change_flag(w.exp_member, BUSINESS, RUN, "customer_add_date")


@query("edw_household", "household_key bigint, ingest_date date, cc_flag string", """
  select household_key, date '2001-08-01' as ingest_date, case when add_date = date '2001-08-01' then 'A' else 'C' end as cc_flag from w_household where record_type <> 'PROSPECT' or record_type is null""")
def edw_household(w):
    return edw.household(w.household.withColumn("last_updated_date", F.lit(DAY).cast("date")), BUSINESS, RUN)


CHECK_VIEWS["o_xrow"] = """
select m.*, o.demandloc, o.order_date, s.store_id, s.retail_web_flag, s.zone_code, s.open_closed_ind = 'OPEN' as is_open,
  case when s.open_closed_ind = 'OPEN' and retail_web_flag = 'RETAIL' then coalesce(case when upper(demandloc) <> 'NULL' then demandloc end, cast(s.store_id as varchar)) end as place
from w_exp_sum m left join w_exp_trans o on o.trxn_id = m.trxn_id left join w_store s on s.store_key = m.store_key
"""
CHECK_VIEWS["o_xagg"] = """
select member_key, max(case when is_open and retail_web_flag = 'RETAIL' then coalesce(order_date, trxn_date) end) as last_store, max(case when is_open and retail_web_flag = 'WEB' then coalesce(order_date, trxn_date) end) as last_web,
  min(case when trxn_date >= date '1999-08-01' then trxn_date end) as brand_first, sum(w_units) as wu, sum(m_units) as mu, sum(w_amount_after_discount) as wa, sum(m_amount_after_discount) as ma
from o_xrow group by member_key
"""
_VISIT = """select member_key, {p} as p, row_number() over (partition by member_key order by n desc, trxn_date desc, {p} asc nulls last, trxn_id) as r from (
  select member_key, trxn_id, trxn_date, {p}, count(*) over (partition by member_key, {p}) as n from o_xrow where {w}) x"""
CHECK_VIEWS["o_xpref"] = _VISIT.format(p="place", w="true")
CHECK_VIEWS["o_xprim"] = _VISIT.format(p="place", w="trxn_date >= date '2000-08-01'")
CHECK_VIEWS["o_xzone"] = _VISIT.format(p="zone_code", w="trxn_date >= date '2000-08-01'")
CHECK_VIEWS["o_browse"] = """
select mk as member_key, max(visit_date) as d from (
  select v.visit_date, coalesce(c.member_key, i.member_key) as mk from w_visits v left join (select * from w_exp_member where (record_type <> 'PROSPECT' or record_type is null) and length(loyalty_id) = 13) c
    on c.loyalty_id = trim(v.loyalty_id) left join w_mailids i on i.mme_id = upper(trim(v.mail_id))) x where mk is not null group by mk
"""
_PREF = "case when {m} = 0 and {w} > 0 then 'WO' when {w} = 0 and {m} > 0 then 'MO' when {w} > 0 and {m} > 0 then case when {w} >= {m} then 'DLW' else 'DLM' end end"


@query("edw_customer", "member_key bigint, customer_age int, customer_age_qualifier string, plcc_open_date date, plcc_closed_date date, last_store_trxn_date date, last_web_trxn_date date, "
       "brand_first_trxn_date date, gender_merch_units string, gender_merch_spend string, preferred_store_id string, primary_store_id string, secondary_store_id string, "
       "dominant_shopping_channel string, distance_to_preferred_store double, last_browse_date date, last_trxn_date date, gender string, cc_flag string", f"""
  select m.member_key, round((12 * (2001 - year(birth_date)) + (8 - month(birth_date)) + (1 - day(birth_date)) / 31.0) / 12) as customer_age,
    case when round((12 * (2001 - year(birth_date)) + (8 - month(birth_date)) + (1 - day(birth_date)) / 31.0) / 12) > 0 then 'X' else 'U' end as customer_age_qualifier,
    p.o as plcc_open_date, p.c as plcc_closed_date, last_store as last_store_trxn_date, last_web as last_web_trxn_date, brand_first as brand_first_trxn_date,
    {_PREF.format(w='wu', m='mu')} as gender_merch_units, {_PREF.format(w='wa', m='ma')} as gender_merch_spend, f.p as preferred_store_id, r1.p as primary_store_id, r2.p as secondary_store_id,
    case z.p when 8 then 'EFO' when 6 then 'Ecomm' when 1 then 'Retail' when 2 then 'Retail' end as dominant_shopping_channel,
    case when s.district_code = '97' then -1.0 when s.open_closed_ind = 'OPEN' then {MILES} end as distance_to_preferred_store, coalesce(b.d, n.last_browse_date) as last_browse_date,
    case when last_store_purch_date is null or last_store_purch_date < last_web_purch_date then last_web_purch_date else last_store_purch_date end as last_trxn_date, gender,
    {FLAG.format(added='customer_add_date')}
  from w_exp_member m left join (select member_key, max(case when account_open_date < date '2001-08-01' then account_open_date end) as o, max(case when closed_date < date '2001-08-01' then closed_date end) as c
    from w_exp_cards where card_type_key = 1 and source_key in (8, 9) group by 1) p on p.member_key = m.member_key
  left join o_xagg a on a.member_key = m.member_key left join (select * from o_xpref where r = 1) f on f.member_key = m.member_key
  left join (select * from o_xprim where r = 1) r1 on r1.member_key = m.member_key left join (select * from o_xprim where r = 2) r2 on r2.member_key = m.member_key
  left join (select * from o_xzone where r = 1) z on z.member_key = m.member_key left join w_store s on cast(s.store_id as varchar) = f.p
  left join o_browse b on b.member_key = m.member_key left join w_snap n on n.member_key = m.member_key where m.record_type <> 'PROSPECT' or m.record_type is null""", headline=True)
def edw_customer(w):
    return edw.customer(w.exp_member, w.view("w_exp_sum", w_trxn=w.narrow("w_trxn", [*HEAD, *SUMMED])), _translation(w), w.store, w.exp_cards, w.visits, w.mailids, w.snap, BUSINESS, RUN, DAY)


TRX_SQL = """
  select t.trxn_id, case when length(x.demandloc) > 0 and upper(x.demandloc) <> 'NULL' then x.demandloc else cast(s.store_id as varchar) end as store_id, x.exp_order_id, o.inv as invoicenumber,
    case t.{gift} when 'Y' then 'YES' when 'N' then 'NO' else null end as gift, 'A' as cc_flag, t.last_updated_date as ingest_date
  from {rows} t left join w_store s on s.store_key = t.store_key left join w_exp_trans x on x.trxn_id = t.trxn_id
  left join (select id_trn, min(invoicenumber) as inv from w_exp_order group by id_trn) o on o.id_trn = lpad(cast(s.store_id as varchar), 8, '0') || strftime(t.trxn_date, '%Y%m%d') || lpad(t.register_nbr, 10, '0') || '#' || lpad(t.trxn_nbr, 6, '0')
  where t.last_updated_date > date '2001-03-01'"""
VIEWS["w_exp_line"] = """
select trxn_id, trxn_seq_nbr, member_key, store_key, trxn_date, cast(trxn_id % 9 as string) as register_nbr, cast(trxn_id % 777 as string) as trxn_nbr,
  case when gift_card_sales_ind = 'YES' then 'Y' else 'N' end as gift_card_sales_ind, trxn_date as last_updated_date from {w_trxn}
"""
INLINE.add("w_exp_line")


@query("edw_transaction_detail", "trxn_id bigint, store_id string, exp_order_id string, invoicenumber string, gift string, cc_flag string, ingest_date date", TRX_SQL.format(gift="gift_card_sales_ind", rows="w_exp_line"))
def edw_transaction_detail(w):
    lines = w.narrow("w_trxn", LINE)
    # an order's reference holds none of the sums
    sums = w.view("w_exp_sum", w_trxn=lines.withColumns({c: F.lit(None).cast("int") for c in SUMMED}))
    orders = w.view("w_exp_order", w_exp_sum=sums)
    return edw.transactions(w.view("w_exp_line", w_trxn=lines), _translation(w), orders, w.store, BUSINESS, RUN, "gift_card_sales_ind").withColumnRenamed("gift_card_sales_ind", "gift")


@query("edw_transaction_summary", "trxn_id bigint, store_id string, exp_order_id string, invoicenumber string, gift string, cc_flag string, ingest_date date", TRX_SQL.format(gift="gift_card_sales_only_ind", rows="w_exp_sum"))
def edw_transaction_summary(w):
    return edw.transactions(w.exp_sum, w.exp_trans, w.exp_order, w.store, BUSINESS, RUN, "gift_card_sales_only_ind").withColumnRenamed("gift_card_sales_only_ind", "gift")


@query("edw_dedup_map", "old_member_key bigint, new_member_key bigint, ingest_date date, cc_flag string", """
  select old_member_key, new_member_key, last_updated_date as ingest_date, 'A' as cc_flag from w_dedup_hist where not is_invalid and last_updated_date > date '2001-03-01'""")
def edw_dedup_map(w):
    return edw.dedup_map(w.dedup_hist, BUSINESS, RUN)


@query("edw_dedup_trxn", "member_key bigint, trxn_date date, store_id bigint, trxn_nbr string, exp_order_id string, register_nbr string", """
  select distinct l.member_key, l.trxn_date, s.store_id, l.trxn_nbr, x.exp_order_id, l.register_nbr from w_exp_line l
  join (select new_member_key, max(last_updated_date) as d from w_dedup_hist where not is_invalid and last_updated_date > date '2001-03-01' group by 1) h on h.new_member_key = l.member_key
  left join w_store s on s.store_key = l.store_key left join w_exp_trans x on x.trxn_id = l.trxn_id""")
def edw_dedup_trxn(w):
    return edw.dedup_transactions(w.exp_line, w.dedup_hist, w.store, w.exp_trans, BUSINESS, RUN)


@query("edw_lookups", "name string, key bigint, run_date date", f"""
  select 'loyalty' as name, tier_key as key, date '{RUN}' as run_date from w_tiernames union all select 'scoring_model_segment', scoring_model_segment_key, date '{RUN}' from w_work_segs
  union all select 'scoring_model', scoring_model_key, date '{RUN}' from w_work_scoring_model where status = 'current'
  union all select 'transaction_type', transaction_type_key, date '{RUN}' from w_work_types union all select 'discount_type', discount_type_key, date '{RUN}' from w_work_disctypes""")
def edw_lookups(w):
    cur = lambda d: d.withColumn("status", F.lit("current"))
    disc = cur(w.work_disctypes).withColumns({c: F.lit(None).cast("string") for c in ("discount_deal_code", "discount_type_description")})
    tables = {"loyalty": cur(w.tiernames), "scoring_model_segment": cur(w.work_segs), "scoring_model": w.work_scoring_model, "transaction_type": cur(w.work_types), "discount_type": disc}
    out = []
    for name, df in tables.items():
        where, cols = edw.LOOKUPS[name]
        out.append(edw.lookup(df, where, cols, RUN).select(F.lit(name).alias("name"), F.col(cols[0]).cast("bigint").alias("key"), "run_date"))
    return union_all(out)


@query("edw_lookup_generic", "store_key bigint, store_name string, run_date date", f"select store_key, store_name, date '{RUN}' as run_date from w_store where open_closed_ind = 'OPEN'")
def edw_lookup_generic(w):
    return edw.lookup(w.store, "open_closed_ind = 'OPEN'", ["store_key", "store_name"], RUN)


FEED_COLUMNS = ["member_key", "first_name", "gender", "member_status", "ingest_date"]


def _feed(w):
    extract = edw.change_flag(w.exp_member, BUSINESS, RUN, "customer_add_date").withColumn("first_name", F.concat(F.lit("|"), "first_name"))
    return edw.feed(extract, w.exp_const, {"gender": ["GENDER", "UNKNOWN"], "member_status": ["STATUS"]}, ["first_name"], FEED_COLUMNS, RUN)


FEED_SQL = """select member_key, coalesce(first_name, '') as first_name, coalesce(g.id, -1) as gender, coalesce(s.id, -1) as member_status, last_updated_date as ingest_date from w_exp_member m
  left join (select lower(trim(constant_value)) as v, constant_id as id from w_exp_const where run_date = date '2001-08-01' and constant_type = 'GENDER') g on g.v = lower(m.gender)
  left join (select lower(trim(constant_value)) as v, constant_id as id from w_exp_const where run_date = date '2001-08-01' and constant_type = 'STATUS') s on s.v = lower(m.member_status)"""


@query("edw_feed", "member_key bigint, first_name string, gender int, member_status int, ingest_date date", FEED_SQL)
def edw_feed(w):
    return _feed(w)


@query("edw_feed_file", "value string", f"""
  select cast(member_key as varchar) || '|' || first_name || '|' || gender || '|' || member_status || '|' || cast(ingest_date as varchar) as value from ({FEED_SQL}) x""")
def edw_feed_file(w):
    path = wr.write_csv_feed(_feed(w), fresh(w, "edw"), RUN)
    return rd.read_lines(w.spark, path)


@query("edw_feed_snapshot", "constant_id int, constant_type string, constant_value string, run_date date", f"""
  select constant_id, constant_type, constant_value, date '{RUN}' as run_date from w_exp_const where run_date = date '2001-08-01'""")
def edw_feed_snapshot(w):
    return edw.snapshot_feed(w.exp_const, ["constant_value"], ["constant_id", "constant_type", "constant_value", "run_date"], RUN)


VIEWS["w_feed_household"] = """
select household_key, cast(household_key % 5 as int) as member_count, case household_key % 3 when 0 then 'M' when 1 then ' f ' else 'none' end as record_type, 'a|b' || cast(household_key % 90 as string) as zip_code,
  date '2001-07-01' + cast(household_key % 20 as int) as ingest_date, 'A' as cc_flag, case when household_key % 7 = 0 then date '2001-07-01' else date '2001-08-01' end as run_date from {w_household}
"""
VIEWS["w_feed_detail"] = """
select trxn_id as transaction_detail_id, member_key, case trxn_id % 3 when 0 then 'MALE' when 1 then 'x' else null end as markdown_type, trxn_date as ingest_date, date '2001-08-01' as run_date from {w_trxn_head}
"""
INLINE.update({"w_feed_household", "w_feed_detail"})
_GENDERS = "(select lower(trim(constant_value)) as v, constant_id as id from w_exp_const where run_date = date '2001-08-01' and constant_type = 'GENDER')"


def _as_type(constants, kind: str):
    """The stored constants with one type under the name that a feed asks for."""
    return constants.withColumn("constant_type", F.when(F.col("constant_type") == "GENDER", F.lit(kind)).otherwise(F.col("constant_type")))


@query("edw_feed_household", "household_key bigint, member_count int, record_type int, zip_code string, add_date date, ingest_date date, cc_flag string", f"""
  select household_key, member_count, coalesce(id, -1) as record_type, replace(zip_code, '|', '') as zip_code, cast(null as date) as add_date, ingest_date, cc_flag
  from w_feed_household left join {_GENDERS} g on v = lower(trim(record_type)) where run_date = date '2001-08-01'""")
def edw_feed_household(w):
    rows = w["w_feed_household"]
    filled = rows.withColumns({c: F.lit(None).cast("date" if c.endswith("date") else "string") for c in edw.FEEDS["household"].columns if c not in rows.columns})
    return edw.export_feed("household", filled, _as_type(w.exp_const, "RECORD TYPE"), "2001-08-01")


@query("edw_feed_detail", "transaction_detail_id bigint, member_key bigint, markdown_type int, ingest_date date", f"""
  select transaction_detail_id, member_key, coalesce(id, -1) as markdown_type, ingest_date from w_feed_detail left join {_GENDERS} g on v = lower(trim(markdown_type))""")
def edw_feed_detail(w):
    return edw.export_feed("transaction_detail", w["w_feed_detail"], _as_type(w.exp_const, "MARKDOWN TYPE"), "2001-08-01")


@query("edw_feed_lookups", "feed string, rows bigint, columns string", f"""
  select 'constants' as feed, count(*) as rows, 'constant_id,constant_value,constant_desc,constant_type,run_date' as columns from w_exp_const where run_date = date '2001-08-01'
  union all select 'lkp_transaction_type', count(*), 'transaction_type_key,run_date' from w_work_types""")
def edw_feed_lookups(w):
    constants = w.exp_const.withColumn("constant_desc", F.lit(None).cast("string"))
    types = w.work_types.select("transaction_type_key", F.lit("2001-08-01").cast("date").alias("run_date"))
    feeds = {"constants": edw.export_feed("constants", constants, constants, RUN), "lkp_transaction_type": edw.export_feed("lkp_transaction_type", types, constants, RUN)}
    return union_all([d.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("feed"), "rows", F.lit(",".join(d.columns)).alias("columns")) for n, d in feeds.items()])


@query("edw_validation", "distinct_member_count bigint, loyalty_records_count bigint, active_records_count bigint, plcc_records_yes bigint, plcc_records_no bigint", """
  select count(distinct member_key) as distinct_member_count, count(loyalty_id) as loyalty_records_count, sum(case when upper(trim(member_status)) = 'ACTIVE' then 1 else 0 end) as active_records_count,
    sum(case when upper(trim(is_plcc)) = 'YES' then 1 else 0 end) as plcc_records_yes, sum(case when upper(trim(is_plcc)) = 'NO' then 1 else 0 end) as plcc_records_no from w_exp_member""")
def edw_validation(w):
    return edw.validate_customer(w.exp_member)


@query("edw_validation_household", "distinct_household_count bigint, valid_address_strict bigint, valid_address_loose bigint", """
  select count(distinct household_key) as distinct_household_count, sum(case when household_key % 3 = 0 then 1 else 0 end) as valid_address_strict,
    sum(case when household_key % 3 = 1 then 1 else 0 end) as valid_address_loose from w_household""")
def edw_validation_household(w):
    kinds = F.when(F.col("household_key") % 3 == 0, "strict ").when(F.col("household_key") % 3 == 1, "LOOSE")
    return edw.validate_household(w.household.withColumn("valid_address", kinds))


# ---------------------------------------------------------------- first loads

VIEWS["w_landed"] = """
select cast(k + 1 as string) as member_id, fn as given, case k % 4 when 0 then 'y' when 1 then 'No' when 2 then 'Unknown' else ' ' end as opt,
  lpad(cast(1 + k % 12 as string), 2, '0') || '/' || lpad(cast(1 + k % 28 as string), 2, '0') || '/2000 10:11:12' as joined, case when k % 6 = 0 then 'bad date' else '02/03/2001 00:00:00' end as closed, date '2001-07-01' as ingest_date
from {w_person}
union all
select cast(k + 1 as string) as member_id, upper(fn) as given, 'N' as opt, '01/02/1999 00:00:00' as joined, null as closed, date '2001-06-01' as ingest_date from {w_person} where k % 3 = 0
"""
HIST = "member_sk bigint, member_key bigint, first_name string, opt string, status string"
_HIST_EXPR = [("member_key", "cast(member_id as bigint)"),
              ("opt", "case when trim(opt) = '' then null when lower(opt) in ('y', 'yes', '1') then 'YES' when lower(opt) in ('n', 'no', '0') then 'NO' when lower(opt) = 'unknown' then 'UNKNOWN' else opt end")]
CHECK_VIEWS["o_land"] = """
select cast(member_id as bigint) as member_key, given as first_name, case when trim(opt) = '' then null when lower(opt) in ('y', 'yes', '1') then 'YES' when lower(opt) in ('n', 'no', '0') then 'NO'
  when lower(opt) = 'unknown' then 'UNKNOWN' else opt end as opt, ingest_date, row_number() over (partition by member_id order by ingest_date desc) = 1 as cur from w_landed
"""
_DEFAULTS = "union all select k, cast(null as bigint), cast(null as varchar), cast(null as varchar), s from (values (-1), (0)) a(k), (values ('current'), ('history')) b(s)"


@query("hist_dim_load", HIST, f"""
  with n as (select *, row_number() over (order by cur, member_key, ingest_date desc) as sk from o_land)
  select sk as member_sk, member_key, first_name, opt, 'current' as status from n where cur union all select sk, member_key, first_name, opt, 'history' from n {_DEFAULTS}""", headline=True)
def hist_dim_load(w):
    out = hs.hist_dim_load(w.landed.withColumn("member_sk", F.lit(None).cast("bigint")), "member_sk", ["member_key"], [-F.unix_date("ingest_date")], "20010801",
                           renames={"given": "first_name"}, expressions=_HIST_EXPR)
    return out


@query("hist_dim_load_per_key", HIST, """
  with k as (select member_key, (select max(member_sk) from w_scd_backup) + row_number() over (order by member_key) as sk from (select distinct member_key from o_land) x),
  n as (select o.*, k.sk from o_land o join k on k.member_key = o.member_key)
  select sk as member_sk, member_key, first_name, opt, 'current' as status from n where cur union all select sk, member_key, first_name, opt, 'history' from n""")
def hist_dim_load_per_key(w):
    return hs.hist_dim_load(w.landed.withColumn("member_sk", F.lit(None).cast("bigint")), "member_sk", ["member_key"], [-F.unix_date("ingest_date")], "20010801",
                            mode="per_key", renames={"given": "first_name"}, expressions=_HIST_EXPR, stored=w.scd_backup, defaults=False)


@query("hist_dim_load_keep", HIST, f"""
  select member_key * 2 as member_sk, member_key, first_name, opt, 'current' as status from o_land where cur union all select member_key * 2, member_key, first_name, opt, 'history' from o_land {_DEFAULTS}""")
def hist_dim_load_keep(w):
    return hs.hist_dim_load(w.landed.withColumn("member_sk", F.expr("cast(cast(member_id as bigint) * 2 as string)")), "member_sk", ["member_key"], [-F.unix_date("ingest_date")], "20010801",
                            mode="keep", renames={"given": "first_name"}, expressions=_HIST_EXPR)


# landed files of three dimensions, one for each way of giving keys
VIEWS["w_land_store"] = """
select cast(store_key as string) as store_key, store_id, store_name as name, case store_key % 4 when 0 then 'y' when 1 then ' No' when 2 then 'unknown' else ' ' end as rtl_flag,
  'X' as price_group_code, date '2001-01-01' + cast(store_key % 30 as int) as create_date from {w_store}
union all select cast(store_key + 100000 as string) as store_key, store_id, upper(store_name) as name, 'YES' as rtl_flag, 'Y' as price_group_code, date '2000-01-01' as create_date
from {w_store} where store_key % 3 = 0
union all select '0' as store_key, store_id + 900000 as store_id, store_name as name, 'n' as rtl_flag, 'Z' as price_group_code, date '2000-01-01' as create_date from {w_store} where store_key = 2
"""
VIEWS["w_land_agent"] = """
select s_suppkey as cs_agent_id, s_name as agent_name, date '2001-01-01' + cast(s_suppkey % 30 as int) as createdate from {supplier}
union all select s_suppkey as cs_agent_id, 'former ' || s_name as agent_name, date '2000-06-01' as createdate from {supplier} where s_suppkey % 4 = 1
"""
VIEWS["w_land_phone"] = """
select member_key, phone_number, case phone_consent when 'YES' then 'Y' when 'NO' then '0' else 'Unknown' end as consent, last_updated_date as create_date from {w_multi_phone}
union all select member_key, phone_number, ' ' as consent, date '1998-01-01' as create_date from {w_multi_phone} where member_key % 5 = 0
"""
for _n in ("w_land_store", "w_land_agent", "w_land_phone"):
    INLINE.add(_n)
MAPS = """{
  "store_master": {"renames": {"name": "store_name"}, "nulls": ["price_group_code"], "unknown": ["district_key"], "flags": {"rtl_flag": {"y": "Y", "yes": "Y", "1": "Y", "n": "N", "no": "N", "0": "N", "unknown": "UNKNOWN"}}},
  "cs_agent": {"expressions": {"agent_name": "upper(agent_name)"}},
  "member_multi_phone": {"renames": {"consent": "phone_consent"}, "flags": {"phone_consent": null}}
}"""


def _first_load(w, name: str, table: str, **more):
    return hs.first_load(name, w[table], "20010801", hs.ColumnMap.from_json(MAPS)[name], **more)


_KEYS = "(values (-1), (0)) a(k), (values ('current'), ('history')) b(s)"


@query("hist_load_store_master", "store_key bigint, store_id bigint, store_name string, rtl_flag string, price_group_code string, district_key bigint, status string", f"""
  with n as (select cast(store_key as bigint) as store_key, store_id, name as store_name, case lower(trim(rtl_flag)) when 'y' then 'Y' when 'yes' then 'Y' when 'no' then 'N' when 'n' then 'N'
      when 'unknown' then 'UNKNOWN' when '' then null end as rtl_flag, row_number() over (partition by store_id order by create_date desc) as rn from w_land_store),
  r as (select store_key, store_id, store_name, rtl_flag, cast(null as varchar) as price_group_code, -1 as district_key, rn from n where store_key not in (-1, 0))
  select * exclude (rn), 'current' as status from r where rn = 1 union all select * exclude (rn), 'history' from r
  union all select k, null, null, null, null, null, s from {_KEYS}""")
def hist_load_store_master(w):
    return _first_load(w, "store_master", "w_land_store")


@query("hist_load_cs_agent", "cs_agent_key bigint, cs_agent_id bigint, agent_name string, status string", f"""
  with k as (select cs_agent_id, (select max(member_sk) from w_scd_backup) + row_number() over (order by cs_agent_id) as cs_agent_key from (select distinct cs_agent_id from w_land_agent) d),
  r as (select cs_agent_key, cs_agent_id, upper(agent_name) as agent_name, row_number() over (partition by cs_agent_id order by createdate desc) as rn from w_land_agent join k using (cs_agent_id))
  select * exclude (rn), 'current' as status from r where rn = 1 union all select * exclude (rn), 'history' from r union all select k, null, null, s from {_KEYS}""")
def hist_load_cs_agent(w):
    return _first_load(w, "cs_agent", "w_land_agent", stored=w.scd_backup.select(F.col("member_sk").alias("cs_agent_key")))


@query("hist_load_multi_phone", "rows bigint, keys bigint, smallest bigint, largest bigint, status string, phone_consent string", """
  with r as (select *, row_number() over (partition by member_key, phone_number order by create_date desc) = 1 as cur,
      case consent when 'Y' then 'YES' when '0' then 'NO' when 'Unknown' then 'UNKNOWN' end as phone_consent from w_land_phone),
  n as (select *, row_number() over (order by cur, member_key, phone_number, create_date desc) as sk from r)
  select count(*) as rows, count(distinct sk) as keys, min(sk) as smallest, max(sk) as largest, 'current' as status, phone_consent from n where cur group by phone_consent
  union all select count(*), count(distinct sk), min(sk), max(sk), 'history', phone_consent from n group by phone_consent""")
def hist_load_multi_phone(w):
    out = _first_load(w, "member_multi_phone", "w_land_phone", defaults=False)
    key = F.col("member_multi_phone_key")
    each = out.groupBy("status", "phone_consent", key).agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy("status", "phone_consent").agg(F.sum("n").alias("rows"), F.count(key).alias("keys"), F.min(key).alias("smallest"), F.max(key).alias("largest"))


@query("hist_date_parse", "member_id string, joined date, closed date, joined_key bigint, closed_key bigint", """
  select member_id, j as joined, c as closed, coalesce(a.date_key, -1) as joined_key, coalesce(b.date_key, -1) as closed_key from (
    select member_id, cast(try_strptime(joined, '%m/%d/%Y %H:%M:%S') as date) as j, cast(try_strptime(closed, '%m/%d/%Y %H:%M:%S') as date) as c from w_landed) x
  left join w_date a on a.sdate = j left join w_date b on b.sdate = c""")
def hist_date_parse(w):
    return hs.with_date_keys(w.landed, ["joined", "closed"], w.date)


@query("hist_consent_seed", "member_key bigint, email_address string, email_consent string, email_consent_date date, last_updated_date date", """
  select member_key, email_address, c as email_consent, d as email_consent_date, greatest(consent_date_retail, consent_date_outlet, d) as last_updated_date from (
    select *, case when consent_value_retail = 'YES' or consent_value_outlet = 'YES' then 'YES' else 'NO' end as c,
      case when consent_value_retail = 'YES' and consent_value_outlet = 'YES' then greatest(consent_date_retail, consent_date_outlet) when consent_value_retail = 'YES' then consent_date_retail
        when consent_value_outlet = 'YES' then consent_date_outlet end as d from w_brand_consent) x""")
def hist_consent_seed(w):
    return hs.consent_seed(w.brand_consent)


VIEWS["w_mobile_file"] = "select member_key, phone_number, 'A' as consent_status, 'Y' as loyalty_flag, date '2000-02-02' as create_date from {w_multi_phone} where member_key % 3 <> 0"
VIEWS["w_phone_file"] = "select member_key, phone_number, 'N' as loyalty_flag, date '2000-01-01' as create_date from {w_multi_phone} where member_key % 4 <> 0"
VIEWS["w_mme_ids"] = """
select member_key, email_address, mme_id, date '2001-01-01' as ingest_date from {w_mail} where member_key % 5 <> 0
union all select member_key, email_address, mme_id + 1000000 as mme_id, date '2001-02-01' as ingest_date from {w_mail} where member_key % 7 = 0
"""
for _n in ("w_landed", "w_mobile_file", "w_phone_file", "w_mme_ids"):
    INLINE.add(_n)


@query("hist_dim_special", "kind string, member_key bigint, value string, extra string", """
  select 'phone' as kind, coalesce(a.member_key, b.member_key) as member_key, cast(coalesce(a.phone_number, b.phone_number) as varchar) as value, case when b.consent_status is null then 'UNKNOWN' else 'MOBILE' end as extra
    from w_phone_file a full join w_mobile_file b on a.member_key = b.member_key and a.phone_number = b.phone_number
  union all select 'email', m.member_key, m.email_address, cast(i.mme_id as varchar) from w_mail m left join (select member_key, email_address, arg_max(mme_id, ingest_date) as mme_id from w_mme_ids group by 1, 2) i
    on i.member_key = m.member_key and i.email_address = m.email_address
  union all select 'consent', c.member_key, c.consent_value, m.loyalty_id from w_consent c left join w_member m on m.member_key = c.member_key where consent_type = 'DM'
  union all select 'employee', member_key, employee_id, employee_status from w_employee""")
def hist_dim_special(w):
    text = lambda c: F.col(c).cast("string")
    return union_all([
        hs.phones(w.phone_file, w.mobile_file).select(F.lit("phone").alias("kind"), "member_key", text("phone_number").alias("value"), F.col("phone_type").alias("extra")),
        hs.emails(w.mail.drop("mme_id"), w.mme_ids).select(F.lit("email").alias("kind"), "member_key", F.col("email_address").alias("value"), text("mme_id").alias("extra")),
        hs.dm_consents(w.consent, w.member).select(F.lit("consent").alias("kind"), "member_key", F.col("consent_value").alias("value"), F.col("loyalty_id").alias("extra")),
        hs.employees(w.employee.withColumn("employee_id", F.expr("cast(cast(employee_id as bigint) as string)"))).select(
            F.lit("employee").alias("kind"), "member_key", F.col("employee_id").alias("value"), F.col("employee_status").alias("extra"))])


@query("hist_fact_load", "trxn_id bigint, trxn_date_key bigint, currency_key bigint, max_tender_id bigint, fact_id bigint", """
  select row_number() over (order by h.trxn_id) + 77 as fact_id, h.trxn_id, coalesce(d.date_key, -1) as trxn_date_key, s.currency_key, h.trxn_id * 3 as max_tender_id
  from w_exp_sum h left join w_date d on d.sdate = h.trxn_date left join w_work_shops s on s.store_key = h.store_key""")
def hist_fact_load(w):
    rows = w.exp_sum.withColumn("trxn_date", F.col("trxn_date").cast("string"))
    tender = w.work_tsum.select("trxn_id", F.col("tender_id").alias("fact_tender_hist_id"))
    out = hs.fact_transaction_summary(rows, tender, w.date, w.work_shops)
    stored = w.region.select((F.col("r_regionkey") + 73).cast("bigint").alias("fact_id"))
    return hs.fact_sequence(out, "fact_id", [F.col("trxn_id")], stored, "20010801")


@query("hist_fact_detail", "trxn_id bigint, trxn_seq_nbr int, trxn_date date, trxn_date_key bigint", """
  select trxn_id, trxn_seq_nbr, trxn_date, coalesce(date_key, -1) as trxn_date_key from w_exp_line left join w_date on sdate = trxn_date""")
def hist_fact_detail(w):
    return hs.fact_transaction_detail(w.exp_line.withColumn("trxn_date", F.col("trxn_date").cast("string")), w.date)


@query("hist_fact_scoring", "member_key bigint, segment_rank int, model_id int", """
  select g.member_key, s.segment_rank, s.model_id from (select member_key, segment_rank * 10 + 104 as k from w_scoring) g left join w_work_segs s on s.scoring_model_segment_key = g.k""")
def hist_fact_scoring(w):
    rows = w.scoring.select("member_key", (F.col("segment_rank") * 10 + 104).cast("bigint").alias("scoring_model_segment_key"))
    return hs.fact_scoring(rows, w.work_segs)


@query("hist_fact_tender", "fact_tender_hist_id string, member_key string, trxn_date string", """
  select fact_tender_hist_id, member_key, trxn_date from (select cast(trxn_id % 5000 as varchar) as fact_tender_hist_id, cast(member_key as varchar) as member_key, cast(trxn_date as varchar) as trxn_date,
    row_number() over (partition by trxn_id % 5000 order by trxn_date desc, cast(member_key as varchar)) as rn from w_tender_history) x where rn = 1""")
def hist_fact_tender(w):
    path = fresh(w, "tender")
    w.tender_history.select((F.col("trxn_id") % 5000).alias("a"), "member_key", "trxn_date").write.options(sep="|", header=False, nullValue="NULL").csv(path)
    rows = rd.read_headerless_csv(w.spark, path, "fact_tender_hist_id|member_key|trxn_date")
    return hs.fact_tender(rows, [F.col("member_key")])


VIEWS["w_hist_tier"] = """
select event_id as id, cast(event_id % 6 as bigint) as tier_id, 'IP' || cast(user_id * 5 as string) as ipcode, '2001' || lpad(cast(1 + event_id % 12 as string), 2, '0') || '05123456' as tier_begin_date,
  '2099' || lpad(cast(1 + event_id % 12 as string), 2, '0') || '11000000' as tier_end_date, 'V' || cast(user_id as string) as vckey, 'IP' || cast(user_id * 5 as string) as memberid, 'C' || cast(event_id % 400 as string) as certificate_nbr, cast(event_id % 9 as bigint) as reward_def_id
from {events}
"""
INLINE.add("w_hist_tier")
_IP = "(select ip_code, max(member_key) as member_key from w_member where ip_code is not null group by 1)"
_BEGIN = "strptime(substr(tier_begin_date, 1, 8), '%Y%m%d')"


@query("hist_fact_tier", "id bigint, member_key bigint, tier_key bigint, tier_begin_date_key bigint", f"""
  select t.id, coalesce(m.member_key, -1) as member_key, coalesce(d.tier_key, -1) as tier_key, coalesce(a.date_key, -1) as tier_begin_date_key from w_hist_tier t
  left join {_IP} m on m.ip_code = t.ipcode left join w_work_tierdim d on d.tier_id = t.tier_id left join w_date a on a.sdate = cast({_BEGIN} as date)""")
def hist_fact_tier(w):
    return hs.fact_tier(w.hist_tier, w.date, w.work_tierdim, w.member)


@query("hist_fact_point", "id bigint, member_key bigint, transactiondate_key bigint", f"""
  select t.id, c.member_key, coalesce(a.date_key, -1) as transactiondate_key from w_hist_tier t left join (select vc_key, arg_max(member_key, card_history_id) as member_key from w_work_vcards group by 1) c on c.vc_key = t.vckey
  left join w_date a on a.sdate = cast({_BEGIN} as date)""")
def hist_fact_point(w):
    rows = w.hist_tier.select("id", "vckey", F.col("tier_begin_date").alias("transactiondate"), F.col("tier_begin_date").alias("pointawarddate"), F.col("tier_end_date").alias("expirationdate"))
    return hs.fact_point(rows, w.work_vcards, w.date)


@query("hist_fact_reward", "id bigint, member_key bigint, reward_def_key bigint, trxn_id bigint, dateissued_key bigint", f"""
  select t.id, coalesce(m.member_key, -1) as member_key, d.reward_def_key, u.trxn_id, coalesce(a.date_key, -1) as dateissued_key from w_hist_tier t left join {_IP} m on m.ip_code = t.memberid
  left join w_work_rdefs d on d.reward_def_id = t.reward_def_id
  left join (select certificate_nbr, max(trxn_id) as trxn_id from w_work_rtrxn group by 1) u on u.certificate_nbr = t.certificate_nbr left join w_date a on a.sdate = cast({_BEGIN} as date)""")
def hist_fact_reward(w):
    begin = F.col("tier_begin_date")
    rows = w.hist_tier.select("id", "memberid", "certificate_nbr", "reward_def_id", begin.alias("dateissued"), begin.alias("expiration"), begin.alias("fulfillmentdate"), begin.alias("redemptiondate"))
    used = w.work_rtrxn.select("certificate_nbr", "trxn_id", F.lit(DAY).cast("date").alias("trxn_date"))
    return hs.fact_reward(rows, used, w.date, w.work_rdefs, w.member)


for _key in ("hist_fact_coupons", "hist_fact_campaign", "hist_fact_notes"):
    @query(_key, "id bigint, member_key bigint", f"select t.id, coalesce(m.member_key, -1) as member_key from w_hist_tier t left join {_IP} m on m.ip_code = t.memberid")
    def hist_by_member(w):
        return hs.fact_by_member(w.hist_tier.select("id", "memberid"), w.member)


VIEWS["w_audit"] = """
select household_key, record_type, case when household_key % 2 = 0 then 'I' else 'U' end as status, date '2000-01-01' + cast(household_key % 50 as int) as ingest_date from {w_household}
union all select household_key, record_type, 'U' as status, date '2000-01-01' + cast(household_key % 50 as int) as ingest_date from {w_household} where household_key % 4 = 0
"""
VIEWS["w_gold_hh"] = """
select household_key, record_type, date '2001-01-01' + cast(household_key % 90 as int) as last_updated_date from {w_household}
union all select household_key + 100000000 as household_key, record_type, date '2001-02-01' + cast(household_key % 9 as int) as last_updated_date from {w_household}
"""
for _n in ("w_audit", "w_gold_hh"):
    INLINE.add(_n)


@query("hist_edw_load", "household_key bigint, ingest_date date, cc_flag string", """
  with a as (select household_key, ingest_date, case when min(status) = 'I' then 'A' else 'C' end as f from w_audit where record_type <> 'PROSPECT' or record_type is null group by 1, 2),
  g as (select household_key, last_updated_date as ingest_date, cast(null as varchar) as f from w_gold_hh where (record_type <> 'PROSPECT' or record_type is null) and last_updated_date > date '2001-01-15')
  select household_key, ingest_date, coalesce(f, case when row_number() over (partition by household_key order by ingest_date) = 1 then 'A' else 'C' end) as cc_flag from (select * from a union all select * from g) x""")
def hist_edw_load(w):
    return hs.edw_history(w.audit, w.gold_hh, "household_key", "2001-01-15")


# ---------------------------------------------------------------- comparison

CHECK_VIEWS["o_cmp"] = """
select b.member_key, nullif(trim(o.city), '') as oc, nullif(trim(b.city), '') as nc, o.state as os, b.state as ns, o.first_name as f1, b.first_name as f2 from
  (select member_key, min(city) as city, max(state) as state, min(first_name) as first_name from w_scd_batch group by 1) b join o_cur o on o.member_key = b.member_key
"""


def _compare(w):
    new = w.scd_batch.groupBy("member_key").agg(F.min("city").alias("city"), F.max("state").alias("state"), F.min("first_name").alias("first_name"))
    old = newest_batch(w.scd_backup).select("member_key", "city", "state", "first_name", "status")
    return hs.compare_tables(old, new, ["member_key"])


_DIFF = "(lower(oc) is distinct from lower(nc) or lower(os) is distinct from lower(ns) or lower(f1) is distinct from lower(f2))"


@query("compare_tables", "old_count bigint, new_count bigint, matched_keys bigint, different_rows bigint", f"""
  select (select count(*) from o_cur) as old_count, (select count(distinct member_key) from w_scd_batch) as new_count, count(*) as matched_keys, count(*) filter (where {_DIFF}) as different_rows from o_cmp""")
def compare_tables(w):
    return _compare(w)[0]


@query("compare_rows", "member_key bigint, city string, state string", f"""
  select member_key, case when lower(oc) is distinct from lower(nc) then concat_ws(':', oc, nc) end as city, case when lower(os) is distinct from lower(ns) then concat_ws(':', os, ns) end as state
  from o_cmp where {_DIFF}""")
def compare_rows(w):
    return _compare(w)[1]


@query("compare_columns", "city bigint, state bigint, first_name bigint", """
  select count(*) filter (where lower(oc) is distinct from lower(nc)) as city, count(*) filter (where lower(os) is distinct from lower(ns)) as state,
    count(*) filter (where lower(f1) is distinct from lower(f2)) as first_name from o_cmp""")
def compare_columns(w):
    return _compare(w)[2]
