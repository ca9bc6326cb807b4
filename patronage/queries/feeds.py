"""Queries of the feed jobs and till-table operators."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions.text import is_not_empty
from ..operators.sets import union_all
from ..operators.staging import stage
from ..plans import feeds as fd, matching as mt
from ..registry import CHECK_VIEWS, query
from ..warehouse import INLINE, VIEWS
from .matching import MATCH_SCHEMA, lookups, new_keys_sql

FEED_SCHEMA = "etl_unique_id string, match_status boolean, match_key int, member_key bigint, mcd_criteria string, record_info_key bigint, source_key int"


def hits(names: list[str], where: str = "true") -> str:
    """Checking SQL: first criterion that hits each feed row."""
    arms = " union all ".join(f"select id, {i} as prio, {mt.CRITERIA[n].code} as code, member_key from o_hit_{n}" for i, n in enumerate(names))
    return f"""select f.*, h.id is not null as match_status, coalesce(h.code, 92) as match_key, coalesce(h.member_key, -1) as found
      from o_group f left join (select id, arg_min(code, prio) as code, arg_min(member_key, prio) as member_key from ({arms}) a group by id) h on h.id = f.etl_unique_id where {where}"""


def complete_sql(matched: str, source: str, carded: bool = True) -> str:
    """Checking SQL: new keys, record info key and source key for matched rows."""
    yes = lambda cond: f"case when {cond} then 'YES' else 'NO' end"
    filled = lambda c: f"coalesce(trim({c}), '') <> ''"
    card = f"{filled('tender_number')} and {filled('tender_type')}"
    plcc, bank = (f"{card} and t.is_plcc = 'YES'", f"{card} and t.is_credit_card = 'YES'") if carded else ("false", "false")
    flags = " || ".join([yes(f"{filled('first_name')} or {filled('last_name')}"),
                         yes(f"{filled('address_line_1')} or {filled('zip_code')} or {filled('non_usa_postal_code')}"),
                         yes(filled("email_address")), yes(filled("phone")), "'NO'", yes(plcc), yes(bank), yes(filled("implied_loyalty_id")), yes("x.mk <> -1")])
    dim = " || ".join(f"upper(trim({c}))" for c in mt.RECORD_INFO_COLUMNS)
    return f"""with m as ({matched}), n as ({new_keys_sql('select * from m where not match_status')}),
      x as (select m.*, case when m.match_status then m.found else n.member_key end as mk, case when m.match_status then 'matched' else n.mcd_criteria end as mcd
        from m left join n on n.etl_unique_id = m.etl_unique_id and not m.match_status),
      y as (select x.*, {flags} as flags from x left join w_card_type t on t.tender_type_code = x.tender_type)
      select y.etl_unique_id, match_status, match_key, mk as member_key, mcd as mcd_criteria, coalesce(d.record_info_key, -1) as record_info_key, {source} as source_key, y.store_key as st
      from y left join (select record_info_key, {dim} as flags from w_record_info) d on d.flags = y.flags"""


# ---------------------------------------------------------------- till tables

VIEWS["w_till_head"] = """
select trxn_id, cast(trxn_id as string) as transaction_id, trxn_date, trxn_date as transaction_date_iso, store_key as store_id, trxn_seq_nbr from {w_trxn}
"""
VIEWS["w_till_cust"] = "select 'C' || cast(o_custkey as string) as customer_nbr, cast(case when o_orderkey % 5 = 0 then o_orderkey + 900000000 else o_orderkey end as string) as transaction_id from {orders}"
# the same records in the columns of their files, as far as the test tables have them; a till number of
# more than five digits goes on in the register
_TILL_DAY = "replace(cast({day} as string), '-', '') as {column}"
_TILL_NUMBER = "cast(floor({id} / 100000) as bigint) % 1000 as register_id, {id} % 100000 as transaction_number"
_TILL_CENTS = "cast(abs({amount}) * 100 as bigint)"
VIEWS["w_till_line"] = f"""
select cast(trxn_id as string) as transaction_id,
  case when trxn_seq_nbr in (1, 4) then 'sale' when trxn_seq_nbr = 5 then 'discount' else 'non_merchandise' end as line_type,
  store_key as store_id, {_TILL_NUMBER.format(id='trxn_id')}, {_TILL_DAY.format(day='trxn_date', column='transaction_date_iso')},
  cast(floor(trxn_time_key / 60) * 10000 + trxn_time_key % 60 * 100 as bigint) as transaction_time, trxn_seq_nbr as transaction_sequence_number,
  product_key as sku, product_key as non_merchandise_number, product_key - 1 as item_number,
  abs(units) as retail_quantity, abs(units) as non_merchandise_quantity,
  case when purchase_qty < 0 then '-' end as retail_amount_sign, {_TILL_CENTS.format(amount='retail_amount')} as retail_amount,
  {_TILL_CENTS.format(amount='discount_amount')} as retail_sales_discount_amount,
  case when purchase_qty < 0 then '-' end as non_merchandise_amount_sign, {_TILL_CENTS.format(amount='retail_amount')} as non_merchandise_amount,
  {_TILL_CENTS.format(amount='discount_amount')} as discount_amount, ring_code_used as ring_code
from {{w_trxn}}
"""
VIEWS["w_till_tender"] = f"""
select cast(trxn_id as string) as transaction_id, 'tender' as line_type, {_TILL_NUMBER.format(id='trxn_id')},
  {_TILL_DAY.format(day='trxn_date', column='transaction_date_iso')}, cast(tender_type_key as string) as tender_type,
  {_TILL_CENTS.format(amount='tender_amount')} as tender_amount, cast(tokenized_cc_nbr as string) as tender_number
from {{w_tender_history}}
"""
VIEWS["w_till_admin"] = f"""
select cast(o_orderkey as string) as transaction_id, 'admin' as line_type, {_TILL_NUMBER.format(id='o_orderkey')},
  {_TILL_DAY.format(day='cast(o_orderdate as date)', column='transaction_date_iso')}, cast(o_custkey as string) as employee_id
from {{orders}}
"""
VIEWS["w_till_record"] = f"""
select transaction_id, customer_number, {_TILL_DAY.format(day='trxn_date', column='transaction_date')},
  cast(floor(nbr / 100000) as bigint) as transaction_register, nbr % 100000 as transaction_nbr
from (select 'C' || cast(o_custkey as string) as customer_number, cast(o_orderdate as date) as trxn_date,
    case when o_orderkey % 5 = 0 then o_orderkey + 900000000 else o_orderkey end as nbr,
    cast(case when o_orderkey % 5 = 0 then o_orderkey + 900000000 else o_orderkey end as string) as transaction_id from {{orders}}) x
"""
for _n in ("w_till_head", "w_till_cust", "w_till_line", "w_till_tender", "w_till_admin", "w_till_record"):
    INLINE.add(_n)
CHECK_VIEWS["o_heads"] = "select distinct transaction_id, transaction_date_iso, store_id from w_till_head"


def _lines(w):
    head = w.view("w_till_head", w_trxn=w.narrow("w_trxn", ["trxn_id", "trxn_seq_nbr", "trxn_date", "store_key"]))
    cols = ["transaction_id", "transaction_date_iso", "store_id"]
    return [head.filter("trxn_seq_nbr in (1, 4)").select(*cols), head.filter("trxn_seq_nbr = 5").select(*cols), head.filter("trxn_seq_nbr not in (1, 4, 5)").select(*cols)]


def _admin(w):
    return w.orders.select(F.col("o_orderkey").cast("string").alias("transaction_id"), F.col("o_custkey").cast("string").alias("employee_id"))


@query("trxn_unify", "transaction_id string, transaction_date_iso date, store_id bigint, employee_id string, tender_number string, tender_type string, customer_nbr string", """
  select distinct h.transaction_id, h.transaction_date_iso, h.store_id, cast(a.o_custkey as varchar) as employee_id, cast(t.tokenized_cc_nbr as varchar) as tender_number,
    cast(t.tender_type_key as varchar) as tender_type, c.customer_nbr
  from (select * from o_heads union select cast(trxn_id as varchar), trxn_date, tender_type_key from w_tender_history) h
  left join orders a on cast(a.o_orderkey as varchar) = h.transaction_id left join w_tender_history t on cast(t.trxn_id as varchar) = h.transaction_id
  join w_till_cust c on c.transaction_id = h.transaction_id""")
def trxn_unify(w):
    tender = w.view("w_tender_history").select(F.col("trxn_id").cast("string").alias("transaction_id"), F.col("trxn_date").alias("transaction_date_iso"),
                                     F.col("tender_type_key").alias("store_id"), F.col("tokenized_cc_nbr").cast("string").alias("tender_number"),
                                     F.col("tender_type_key").cast("string").alias("tender_type"))
    return mt.trxn_unify(_lines(w), _admin(w), tender, w.till_cust)


def _width_sql(layout: list, view: str) -> str:
    """Checking SQL: text of a record, blank where its view lacks a column."""
    cols = re.findall(r"\bas (\w+)", VIEWS[view])
    return " || ".join(f"lpad(coalesce(cast({c} as varchar), ''), {n}, '{pad}')" if c in cols else f"'{pad * n}'" for c, n, pad in layout)


def _unlisted(kind: str, text: str, view: str, others: list[str], where: str = "true") -> str:
    """Checking SQL: text of the records of a view whose transaction no other view has."""
    return f"select '{kind}' as kind, {text} as line from {view} t where {where}" + "".join(
        f" and not exists (select 1 from {o} x where x.transaction_id = t.transaction_id)" for o in others)


_KILL_SQL = " union all ".join([
    _unlisted("customer", _width_sql(mt.CUSTOMER_LAYOUT, "w_till_record"), "w_till_record", ["w_till_line", "w_till_tender"]),
    *[_unlisted("line", _width_sql(layout, view), view, ["w_till_record"], f"line_type = '{name}'") for name, layout in mt.LINE_LAYOUTS.items()
      for view in [f"w_till_{name}" if name in ("admin", "tender") else "w_till_line"]]])


@query("kill_list", "kind string, line string, rows bigint", f"select kind, line, count(*) over (partition by kind) as rows from ({_KILL_SQL}) k")
def kill_list(w):
    """The lines of the two exception files, each with the number of lines that its file has."""
    tender = w.view("w_till_tender", w_tender_history=w.view("w_tender_history"))
    heads = [w.view("w_trxn").select(F.col("trxn_id").cast("string").alias("transaction_id")), tender]
    items = w.lineitem.withColumn("transaction_id", F.col("l_orderkey").cast("string"))
    customers, (items, tender, admin) = mt.kill_lists(w.till_record, heads, [items, tender, w.till_admin])
    # only lines on the list meet their orders and get the columns of their file
    till = w.view("w_till_line", w_trxn=w.view("w_trxn", lineitem=items))
    lines = union_all([till, tender, admin], allow_missing=True)
    out = stage(union_all([customers.select(F.lit("customer").alias("kind"), mt.customer_text(customers).alias("line")),
                           lines.select(F.lit("line").alias("kind"), mt.line_text(lines).alias("line"))]))
    return out.join(F.broadcast(out.groupBy("kind").agg(F.count(F.lit(1)).alias("rows"))), "kind")


@query("exclude_loaded", "transaction_id string, customer_nbr string", "select transaction_id, customer_nbr from w_till_cust where transaction_id not in (select cast(trxn_id as varchar) from w_trxn)")
def exclude_loaded(w):
    return mt.exclude_loaded(w.till_cust, w.trxn.select(F.col("trxn_id").cast("string").alias("trxn_id")))


# ---------------------------------------------------------------- feeds

@query("feed_tlog", FEED_SCHEMA + ", member_loyalty string", f"""
  with r as ({complete_sql(hits(fd.TILL_ORDER[:1], "trim(implied_loyalty_id) <> ''") + " union all " + hits(fd.TILL_ORDER[1:], "coalesce(trim(implied_loyalty_id), '') = ''"), "0")})
  select r.etl_unique_id, match_status, match_key, r.member_key, mcd_criteria, record_info_key, case when match_key in (4, 10, 7, 9, 13, 14, 11) then case when s.retail_web_flag = 'WEB' then 47 else 7 end
    when s.retail_web_flag = 'WEB' then 5 else 6 end as source_key, m.loyalty_id as member_loyalty
  from r left join w_store s on s.store_key = r.st left join w_member m on m.member_key = r.member_key""", headline=True)
def feed_tlog(w):
    return fd.till(w.feed, lookups(w), w.store, w.record_info, w.card_type)


CHECK_VIEWS["o_newest"] = """
select etl_unique_id from (select etl_unique_id, row_number() over (partition by tender_number order by right(etl_unique_id, 8) desc, etl_unique_id) as rn from w_feed where trim(tender_number) <> '') x where rn = 1
"""


@query("feed_ads400", FEED_SCHEMA, complete_sql(hits(fd.CARD_ORDER, "f.etl_unique_id in (select etl_unique_id from o_newest)"), "9"))
def feed_ads400(w):
    return fd.card_account(w.feed, lookups(w), w.record_info, w.card_type)


VIEWS["w_statement"] = """
select etl_unique_id, tender_number, tender_type, first_name, last_name, address_line_1, zip_code, email_address, phone as home_phone,
  case when feed_nbr % 3 = 0 then cast(2125550000 + feed_nbr % 900 * 13 as string) else phone end as mobile_phone from {w_feed} where tender_number is not null
"""
VIEWS["w_authorised"] = """
select 'A' || etl_unique_id as etl_unique_id, case when feed_nbr % 2 = 0 then tender_number else 'X' || cast(feed_nbr as string) end as tender_number, 'Auth' as first_name, last_name, phone
from {w_feed} where tender_number is not null
"""


@query("ads600_merge", "etl_unique_id string, tender_number string, first_name string, phone string", """
  select distinct etl_unique_id, tender_number, first_name, phone from (
    select etl_unique_id, tender_number, first_name, unnest([home_phone, mobile_phone]) as phone, tender_type, email_address, address_line_1, last_name, zip_code from w_statement
    union all select etl_unique_id, tender_number, first_name, phone, null, null, null, last_name, null from w_authorised where tender_number not in (select tender_number from w_statement)) x""")
def ads600_merge(w):
    return fd.merge_statement(w.statement, w.authorised)


def _of_statement(sql: str) -> str:
    """A checking view over the till feed as one over the rows of the card statement, some of
    whose card numbers are no numbers."""
    sql = sql.replace(" cast(nullif(", " try_cast(nullif(")
    return re.sub(r"\bw_feed\b", "o_st_rows", re.sub(r"\bo_(feed|group|mcd|hit_\w+)\b", r"o_st_\1", sql))


CHECK_VIEWS["o_st_rows"] = """
select concat_ws('|', etl_unique_id, phone) as etl_unique_id, etl_unique_id as own_id, tender_number, tender_type, first_name, last_name, address_line_1,
  zip_code, email_address, phone, null::varchar as implied_loyalty_id, null::varchar as employee_id, null::varchar as ip_code, null::varchar as address_line_2,
  null::varchar as non_usa_postal_code, null::bigint as known_member_key, null::bigint as store_key from (
  select distinct * from (
    select etl_unique_id, tender_number, tender_type, first_name, last_name, address_line_1, zip_code, email_address, unnest([home_phone, mobile_phone]) as phone,
      home_phone, mobile_phone from w_statement
    union all select etl_unique_id, tender_number, null, first_name, last_name, null, null, null, phone, null, null from w_authorised
      where tender_number not in (select tender_number from w_statement)) u) r
"""
for _name in [n for n in CHECK_VIEWS if n in ("o_feed", "o_group", "o_mcd") or n.startswith("o_hit_")]:
    CHECK_VIEWS[_of_statement(_name)] = _of_statement(CHECK_VIEWS[_name])
STATEMENT_SQL = f"""
  select * exclude (etl_unique_id, own_id, rn), own_id as etl_unique_id from (
    select *, row_number() over (partition by own_id order by found desc, etl_unique_id) as rn from ({_of_statement(hits(fd.CARD_ORDER))}) h) b where rn = 1"""


@query("feed_ads600", FEED_SCHEMA, complete_sql(STATEMENT_SQL, str(fd.FEED_SOURCES["card_statement"])))
def feed_ads600(w):
    return fd.card_statement(w.statement, w.authorised, lookups(w), w.record_info, w.card_type)


def simple(key: str, order: list[str], source: str, build):
    @query(key, FEED_SCHEMA, complete_sql(hits(order), source, carded=False))
    def run(w):
        return build(w)


def _plain(w):
    return w.feed


simple("feed_employee", fd.EMPLOYEE_ORDER, "144", lambda w: fd.simple(_plain(w), lookups(w), w.record_info, None, fd.EMPLOYEE_ORDER, F.lit(144)))
simple("feed_mobile_consent", fd.MOBILE_ORDER, "2226", lambda w: fd.simple(_plain(w), lookups(w), w.record_info, None, fd.MOBILE_ORDER, F.lit(2226)))
simple("feed_rental_experian", fd.RENTAL_ORDER, "case when lower(gender) like 'm%' then 1561 else 1560 end",
       lambda w: fd.rental(_plain(w), lookups(w), w.record_info, mt.gender_source_key(F.col("gender"), fd.EXPERIAN_MALE, fd.EXPERIAN_FEMALE)))
simple("feed_rental_jcrew", fd.RENTAL_ORDER, "264", lambda w: fd.rental(_plain(w), lookups(w), w.record_info, F.lit(264)))
simple("feed_rental_venus", fd.RENTAL_ORDER, "2112", lambda w: fd.rental(_plain(w), lookups(w), w.record_info, F.lit(2112)))


@query("feed_rental_anthem", FEED_SCHEMA, "select * from (" + complete_sql(hits(fd.RENTAL_ORDER), "2199", carded=False) + ") z where not match_status")
def feed_rental_anthem(w):
    return fd.rental(w.feed, lookups(w), w.record_info, F.lit(2199), only_new=True)


@query("match_known_keys", MATCH_SCHEMA, """
  select etl_unique_id, known_member_key > 0 as match_status, 0 as match_key, known_member_key as member_key from w_feed where known_member_key > 0""")
def match_known_keys(w):
    return mt.split_known_keys(w.feed.withColumnRenamed("known_member_key", "member_key"))[0]


EMAIL_SQL = complete_sql(hits(fd.EMAIL_UPDATE_ORDER, "coalesce(known_member_key, 0) < 1"), "2225", carded=False)
_flags = " || ".join(["case when coalesce(trim(first_name), '') <> '' or coalesce(trim(last_name), '') <> '' then 'YES' else 'NO' end",
                      "case when coalesce(trim(address_line_1), '') <> '' or coalesce(trim(zip_code), '') <> '' or coalesce(trim(non_usa_postal_code), '') <> '' then 'YES' else 'NO' end",
                      "case when coalesce(trim(email_address), '') <> '' then 'YES' else 'NO' end", "case when coalesce(trim(phone), '') <> '' then 'YES' else 'NO' end", "'NONONO'",
                      "case when coalesce(trim(implied_loyalty_id), '') <> '' then 'YES' else 'NO' end", "'YES'"])
_dim = " || ".join(f"upper(trim({c}))" for c in mt.RECORD_INFO_COLUMNS)


@query("feed_email_update", FEED_SCHEMA, f"""
  select etl_unique_id, match_status, match_key, member_key, mcd_criteria, record_info_key, source_key from ({EMAIL_SQL}) z
  union all select k.etl_unique_id, true, 0, known_member_key, 'matched', coalesce(d.record_info_key, -1), 2225 from (select *, {_flags} as flags from w_feed where known_member_key > 0) k
    left join (select record_info_key, {_dim} as flags from w_record_info) d on d.flags = k.flags""")
def feed_email_update(w):
    return fd.email_update(w.feed.withColumnRenamed("known_member_key", "member_key"), lookups(w), w.record_info)


VIEWS["w_loyal_feed"] = """
select etl_unique_id, implied_loyalty_id, ip_code, case when feed_nbr % 4 = 0 then known_member_key when feed_nbr % 7 = 0 then feed_nbr + 1 else null end as loyalty_member_key,
  first_name, last_name, address_line_1, zip_code, non_usa_postal_code, email_address, phone, cast(feed_nbr % 6 as int) as memberstatus, date '2001-01-01' + cast(feed_nbr % 90 as int) as enroll_date,
  100 + feed_nbr % 150 as enroll_store from {w_feed} where implied_loyalty_id is not null or ip_code is not null
"""
CHECK_VIEWS["o_route"] = """
select l.*, h.member_key is not null as match_status, coalesce(h.member_key, -1) as found, case when h.member_key is not null and (loyalty_member_key is null or loyalty_member_key = h.member_key) then 'matched'
  when trim(implied_loyalty_id) <> '' and h.member_key is null and loyalty_member_key is null then 'new' else 'rejected' end as route
from w_loyal_feed l left join (select * from o_hit_loyalty_id union all select i.* from o_hit_ip_code i join w_loyal_feed x on x.etl_unique_id = i.id and coalesce(trim(x.implied_loyalty_id), '') = '') h
  on h.id = l.etl_unique_id
"""


@query("loyalty_reject_router", "etl_unique_id string, match_status boolean, member_key bigint, route string",
       "select etl_unique_id, match_status, found as member_key, route from o_route")
def loyalty_reject_router(w):
    return fd.loyalty_router(w.loyal_feed, lookups(w))


CHECK_VIEWS["o_loyal_one"] = """
select etl_unique_id from (select etl_unique_id, row_number() over (partition by loyalty_member_key, ip_code, implied_loyalty_id order by enroll_date desc, etl_unique_id) as rn
  from w_loyal_feed where memberstatus <> 5) x where rn = 1
"""


@query("feed_loyalty", "etl_unique_id string, route string, member_key bigint, enroll_store_key bigint", """
  with r as (select o.*, g.grp, g.mcd_criteria as mcd from o_route o join o_group g on g.etl_unique_id = o.etl_unique_id where o.etl_unique_id in (select etl_unique_id from o_loyal_one)),
  k as (select 'mcd_loyaltyid|' || implied_loyalty_id as grp, (select max(member_key) from w_member) + row_number() over (order by implied_loyalty_id) as mk
    from (select distinct implied_loyalty_id from r where route = 'new') x)
  select etl_unique_id, route, case when route = 'matched' then found when route = 'new' then k.mk end as member_key, case when route = 'rejected' then null else coalesce(s.store_key, -1) end as enroll_store_key
  from r left join k on k.grp = 'mcd_loyaltyid|' || r.implied_loyalty_id left join w_store s on s.store_id = r.enroll_store""")
def feed_loyalty(w):
    loaded, rejected = fd.loyalty(w.loyal_feed, lookups(w), w.store, w.record_info)
    out = loaded.select("etl_unique_id", "route", "member_key", "enroll_store_key")
    return out.unionByName(rejected.select("etl_unique_id", "route", F.lit(None).cast("bigint").alias("member_key"), F.lit(None).cast("bigint").alias("enroll_store_key")))
