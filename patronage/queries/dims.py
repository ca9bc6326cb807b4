"""Queries of dimension loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.sets import union_all
from ..plans import dims as dm, scd
from ..registry import CHECK_VIEWS, query
from ..warehouse import INLINE, VIEWS

# Work tables of the rename-only dimensions, as feeds land them
WORK = {
    "cs_agent": """select s_suppkey as id, s_suppkey * 7 as agentnumber, s_nationkey as groupid, s_name as firstname, 'agent' as lastname,
      'a' || cast(s_suppkey as string) || '@desk.example' as emailaddress, '614' || cast(s_suppkey as string) as phonenumber,
      s_suppkey % 100 as extension, 'u' || cast(s_suppkey as string) as username, 'A' as status, s_nationkey as roleid from {supplier}""",
    "currency": """select case when n_regionkey = 0 then 'EUR' else 'USD' end as base, n_name as quote, date '2001-08-01' as effective_date,
      1.0 + n_nationkey / 8.0 as bid from {nation}""",
    "employee": """select employee_id, case when member_key % 4 = 0 then '' else employee_status end as employee_status, 'L1' as location,
      'D1' as division_code, 30 as discount_percentage, case when member_key % 3 = 0 then '' else 'F' end as full_part_time_indicator,
      member_key % 9 as home_store_number from {w_employee}""",
    "experian": "select member_key, gender, birth_date from {w_member}",
    "household": """select household_key, household_key as household_id, add_date, zip_code, record_type, date '2001-08-01' as last_updated_date,
      'U' as action_flag from {w_household}""",
    "kill_list": """select ip_code, household_key, member_key, first_name, last_name, address1 as address_line_one, zip_code
      from {w_member} where ip_code is not null""",
    "point_event": "select p_partkey as point_event_id, p_name as name, p_type as description from {part}",
    "point_type": """select p_partkey as point_type_id, p_name as name, p_type as description, p_size % 2 as money_backed,
      p_size as consumption_priority from {part}""",
    "reward_def": """select p_partkey as id, p_name as name, p_size * 10 as how_many_points_to_earn, p_size as thresh_hold, 1 as active,
      case p_partkey % 3 when 0 then ' appeasement' when 1 then 'BASE' else null end as certificate_type_code, p_partkey % 7 as tier_id from {part}""",
    "ring_code": """select case when p_partkey % 5 = 0 then '' when p_partkey % 5 = 1 then 'null' else cast(p_partkey as string) end as campaign_key,
      p_type as rcl_cell_name, case when p_size % 4 = 0 then '' else p_brand end as cell_code, cast(1000 + p_partkey % 9000 as string) as ring_code,
      'WEB' as ring_code_channel, p_brand as campaign_reporting_group, p_name as rcl_campaign_name from {part}""",
    "store_group": """select case when s_suppkey % 6 = 0 then ' ' else cast(s_suppkey as string) end as record_key,
      s_suppkey + 100 + case when s_suppkey % 8 = 0 then 100000000 else 0 end as active_store_number, s_name as selection_name from {supplier}""",
    "tier": """select cast(r_regionkey as int) as tier_id, r_name as description, r_regionkey * 100 as entry_points,
      r_regionkey * 100 + 99 as exit_points, 1 as last_dml_id, 'x' as etl_unique_id from {region}""",
    "discount": """select cast(l_linenumber as int) - 1 as discount_type, cast(l_partkey % 16 as int) as discount_deal from {lineitem}""",
    "scoring_model": """select r_regionkey + 50 as scoring_model_key, case r_regionkey when 0 then 104 when 1 then 108 else cast(200 + r_regionkey as int) end as model_id,
      cast(r_regionkey + 3 as int) as model_version_id, r_name as model_description, case when r_regionkey < 4 then 'Yes ' else 'NO' end as current_model_ind, date '2001-07-04' as effective_date,
      date '2099-12-31' as expiration_date, cast(7 as bigint) as scored_record_count, date '2001-06-30' as data_through_date, 'current' as status from {region}
      union all select r_regionkey + 60 as scoring_model_key, case r_regionkey when 0 then 104 when 1 then 108 else cast(200 + r_regionkey as int) end as model_id,
      cast(r_regionkey + 3 as int) as model_version_id, r_name as model_description, case when r_regionkey < 4 then 'Yes ' else 'NO' end as current_model_ind, date '2001-07-04' as effective_date,
      date '2099-12-31' as expiration_date, cast(7 as bigint) as scored_record_count, date '2001-06-30' as data_through_date, 'history' as status from {region}""",
    "item": """select cast(product_key as string) as item_number, case when product_key % 5 = 0 then '' else 'PG' || cast(product_key % 3 as string) end as price_group,
      p_size % 10 as class_code_1, p_name as item_description, 'D' || cast(p_size % 4 as string) as department, cast(p_size % 6 as string) as division,
      p_size % 7 as color, p_size % 5 as size, p_size % 8 as style, p_retailprice as ticket_price from {w_product}""",
    "item_class": "select distinct p_size % 10 as class_code, 'class ' || cast(p_size % 10 as string) as class_name from {part} where p_size % 10 <> 3",
    "item_style": """select p_size % 10 as class, p_size % 8 as style, min(p_size) as vendor from {part} group by p_size % 10, p_size % 8""",
    "item_color": "select distinct p_size % 7 as color_code, 'color ' || cast(p_size % 7 as string) as color_name from {part} where p_size % 7 <> 2",
    "item_size": "select distinct p_size % 5 as size, 'size ' || cast(p_size % 5 as string) as size_name from {part}",
    "item_hier": """select distinct p_size % 10 as class_number, 'division ' || cast(p_size % 2 as string) as division_name,
      'department ' || cast(p_size % 10 as string) as department_name, case when p_size % 2 = 0 then 'W ' else 'M' end as department_stat_code from {part}""",
    "item_uda": """select cast(product_key as string) as item_number, cast(1 + product_key % 2 as int) as uda_id,
      case product_key % 3 when 0 then 'WOMENS' when 1 then '' else 'MENS' end as uda_value_desc from {w_product}""",
    "shop": """select store_id as shop_number, cast(case when district_code = '97' then 97 else 5 end as int) as district_number, store_name as shop_name,
      cast(s_nationkey % 11 as int) as shop_profile_code, 'Y' as rtl_flag, latitude, longitude from {w_store}""",
    "shop_hier": """select store_id as site_code, 'district ' || district_code as district_name, 'region' as region_name, 'zone' as zone_name,
      district_code, '1' as region_code, cast(zone_code as string) as zone_code from {w_store} where store_id % 9 <> 4""",
    "shop_owner": """select store_id as shop_nbr, cast(store_id % 18 as int) as shop_dsgn_cd, case store_id % 4 when 0 then 'D' when 1 then 'W' when 2 then 'M' else 'X' end as shop_type_cd,
      case store_id % 3 when 0 then 'OPN' when 1 then 'LGL' else 'ZZZ' end as shop_stat_cd, open_date as act_open_date,
      case when open_closed_ind = 'CLOSED' then date '2000-01-01' else null end as last_close_date, cast(floor(sq_ft) as int) as sell_sq_ft,
      case store_id % 4 when 0 then 'A' when 1 then 'A+' when 2 then 'C' else 'Q' end as vol_class_cd from {w_store}""",
    "process": """select member_key, segment_group, first_name, city, state, original_source, etl_unique_id,
      case when member_key % 4 = 0 then 'dedup' else 'till' end as process from {w_scd_batch}""",
}
for _n, _sql in WORK.items():
    VIEWS[f"w_work_{_n}"] = _sql
    INLINE.add(f"w_work_{_n}")


# ---------------------------------------------------------------- SCD-2

NATURAL, SK, DERIVED = ["member_key"], "member_sk", ["original_source"]
DAY, BATCH = "2001-08-01", "20010801000000"

CHECK_VIEWS["o_src"] = """
select * from (select *, row_number() over (partition by member_key order by right(etl_unique_id, 8) desc, city, etl_unique_id,
  first_name, original_source, segment_group, state) as rn from w_scd_batch) x where rn = 1
"""
CHECK_VIEWS["o_cur"] = """
select * from w_scd_backup where status = 'current' and batch_id = (select max(batch_id) from w_scd_backup where status = 'current')
"""
CHECK_VIEWS["o_chg"] = """
select t.member_sk, coalesce(s.member_key, t.member_key) as member_key,
  case when act = 'NCD' then t.segment_group else s.segment_group end as segment_group,
  case when act = 'NCD' then t.first_name else s.first_name end as first_name,
  case when act = 'NCD' then t.city else s.city end as city, case when act = 'NCD' then t.state else s.state end as state,
  case when act = 'I' then s.original_source else t.original_source end as original_source,
  t.last_updated_date, act as action_cd, s.member_key is not null as in_source
from (select coalesce(s.member_key, t.member_key) as k, case when t.member_key is null then 'I' when s.member_key is null then 'NCD'
    when lower(s.segment_group) is distinct from lower(t.segment_group) or lower(s.first_name) is distinct from lower(t.first_name)
      or lower(s.city) is distinct from lower(t.city) or lower(s.state) is distinct from lower(t.state) then 'U' else 'NCD' end as act
  from o_src s full join o_cur t on s.member_key = t.member_key) a
left join o_src s on s.member_key = a.k left join o_cur t on t.member_key = a.k
"""


def stored(w):
    return w.stored_dimension("w_scd_backup", NATURAL)


@query("scd2_dedup_source", "member_key bigint, city string, etl_unique_id string", "select member_key, city, etl_unique_id from o_src")
def scd2_dedup_source(w):
    return scd.dedup_source(w.scd_batch, NATURAL)


CHANGE = "member_sk bigint, member_key bigint, first_name string, city string, state string, original_source string, action_cd string"


@query("scd2_change_set", CHANGE, "select member_sk, member_key, first_name, city, state, original_source, action_cd from o_chg", headline=True)
def scd2_change_set(w):
    from ..operators.filters import newest_batch
    return scd.change_set(scd.dedup_source(w.scd_batch, NATURAL), newest_batch(stored(w)), NATURAL, SK, DERIVED)


@query("scd2_load", CHANGE + ", last_updated_date date, batch_id string, status string", f"""
  with k as (select member_key, (select max(member_sk) from w_scd_backup where status = 'current') + row_number() over (order by member_key) as sk
    from o_chg where action_cd = 'I'),
  r as (select coalesce(k.sk, c.member_sk) as member_sk, c.member_key, first_name, city, state, original_source, action_cd,
    case when action_cd = 'NCD' then last_updated_date else date '{DAY}' end as last_updated_date, '{BATCH}' as batch_id
    from o_chg c left join k on k.member_key = c.member_key)
  select *, 'current' as status from r union all select *, 'history' from r where action_cd <> 'NCD'""", headline=True)
def scd2_load(w):
    return union_all(scd.scd2_load(w.scd_batch, stored(w), NATURAL, SK, BATCH, DAY, DERIVED))


@query("scd2_process_load", "member_sk bigint, member_key bigint, city string, action_cd string, status string, process string", """
  with src as (select * from (select *, row_number() over (partition by member_key order by right(etl_unique_id, 8) desc, city, etl_unique_id,
      first_name, original_source, segment_group, state) as rn from w_work_process where process = 'dedup') x where rn = 1),
  c as (select t.member_sk, s.member_key, case when t.member_key is null then 'I'
      when lower(s.segment_group) is distinct from lower(t.segment_group) or lower(s.first_name) is distinct from lower(t.first_name)
        or lower(s.city) is distinct from lower(t.city) or lower(s.state) is distinct from lower(t.state) then 'U' else 'NCD' end as action_cd,
      s.city as s_city, t.city as t_city from src s left join o_cur t on t.member_key = s.member_key),
  k as (select member_key, (select max(member_sk) from w_scd_backup where status = 'current') + row_number() over (order by member_key) as sk
    from c where action_cd <> 'NCD'),
  r as (select coalesce(k.sk, c.member_sk) as member_sk, c.member_key, case when action_cd = 'NCD' then t_city else s_city end as city, action_cd
    from c left join k on k.member_key = c.member_key)
  select *, 'current' as status, 'dedup' as process from r union all select *, 'history', 'dedup' from r where action_cd <> 'NCD'""")
def scd2_process_load(w):
    return union_all(scd.scd2_process_load(w.work_process, stored(w), "dedup", NATURAL, SK, BATCH, DAY, DERIVED))


@query("stub_members", "store_key bigint, store_name string, district_code string, zone_code int", """
  select distinct l_partkey + 1 as store_key, 'UNKNOWN' as store_name, '0' as district_code, 0 as zone_code from lineitem
  where l_partkey + 1 not in (select store_key from w_store)""")
def stub_members(w):
    lines = [w.trxn.select(F.col("product_key").alias("shop"))]
    return scd.stub_members(lines, "shop", [w.store], w.store.select("store_key", "store_name", "district_code", "zone_code"),
                            "store_key", {**dm.STORE_STUB, "zone_code": 0})


# ---------------------------------------------------------------- rename-only dimensions

def simple(name: str, schema: str, check: str, build=None):
    @query(f"dim_{name}", schema, check)
    def run(w):
        work = w[f"w_work_{name}"]
        out = build(w, work) if build else dm.dimension_source(name, work)
        return scd.dedup_source(out, list(dm.DIMENSIONS[name].natural))


simple("cs_agent", "cs_agent_id bigint, cs_agent_nbr bigint, cs_agent_email_addr string, cs_agent_status_cd string, cs_agent_role_id int", """
  select id as cs_agent_id, agentnumber as cs_agent_nbr, emailaddress as cs_agent_email_addr, status as cs_agent_status_cd, roleid as cs_agent_role_id
  from w_work_cs_agent""")
simple("currency", "currency_code string, currency_date date, usd_rate double", """
  select quote as currency_code, effective_date as currency_date, bid as usd_rate from w_work_currency where base = 'USD'""",
       lambda w, work: dm.currency(work))
simple("employee", "employee_id string, employee_status string, full_part_time_ind string, home_store_key bigint", """
  select employee_id, nullif(employee_status, '') as employee_status, nullif(full_part_time_indicator, '') as full_part_time_ind,
    home_store_number as home_store_key from w_work_employee""")
simple("experian", "member_key bigint, gender string, birth_date date", "select member_key, gender, birth_date from w_member")
simple("household", "household_key bigint, add_date date, zip_code string, record_type string",
       "select household_key, add_date, zip_code, record_type from w_household")
simple("kill_list", "member_id string, household_key bigint, member_key bigint, zipcode string", """
  select member_id, household_key, member_key, zipcode from (select ip_code as member_id, household_key, member_key, zip_code as zipcode,
    row_number() over (partition by ip_code, household_key, lower(trim(first_name)), lower(trim(last_name)), address_line_one, zip_code
      order by member_key) as rn from w_work_kill_list) x where rn = 1""")
simple("point_event", "point_event_id bigint, point_event_name string, point_event_descr string",
       "select p_partkey as point_event_id, p_name as point_event_name, p_type as point_event_descr from part")
simple("point_type", "point_type_id bigint, point_txn_type_id int, point_type string, money_backed_points int, point_basis string", """
  select p_partkey as point_type_id, 1 as point_txn_type_id, p_name as point_type, p_size % 2 as money_backed_points,
    cast(null as varchar) as point_basis from part""")
simple("reward_def", "reward_def_id bigint, reward_name string, points_required_to_earn int, is_appeasement string, tier_key bigint", """
  select id as reward_def_id, name as reward_name, how_many_points_to_earn as points_required_to_earn,
    case when certificate_type_code = ' appeasement' then 'YES' else 'NO' end as is_appeasement,
    case when tier_id < 5 then tier_id + 1 else -1 end as tier_key from w_work_reward_def""",
       lambda w, work: dm.reward_def(work, w.region.select(F.col("r_regionkey").cast("bigint").alias("tier_id"),
                                                           (F.col("r_regionkey") + 1).cast("bigint").alias("tier_key"),
                                                           F.lit("current").alias("status"))))
simple("ring_code", "campaign_key string, campaign_code string, cell_code string, campaign_segment_key int, ring_code string, channel string", """
  select distinct case when campaign_key in ('', 'null') then null else campaign_key end as campaign_key, rcl_cell_name as campaign_code,
    nullif(cell_code, '') as cell_code, -1 as campaign_segment_key, ring_code, 'WEB' as channel from w_work_ring_code""")
simple("store_group", "record_key int, active_store_number bigint, group_selection_name string, store_key bigint", """
  select try_cast(trim(g.record_key) as int) as record_key, active_store_number, selection_name as group_selection_name,
    coalesce(s.store_key, -1) as store_key from w_work_store_group g left join w_store s on s.store_id = g.active_store_number""",
       lambda w, work: dm.store_group(work, w.store))
simple("tier", "tier_id int, tier_source string, tier_descr string, min_points_for_tier int, expire_date_expr string", """
  select r_regionkey as tier_id, 'LW' as tier_source, r_name as tier_descr, r_regionkey * 100 as min_points_for_tier,
    cast(null as varchar) as expire_date_expr from region""")


@query("dim_discount_type", "discount_type_code string, discount_deal_code string, discount_type_description string, "
       "discount_deal_description string", """
  select distinct lpad(cast(t as varchar), 2, '0') as discount_type_code, lpad(cast(d as varchar), 2, '0') as discount_deal_code,
    case t when 0 then 'Group Coupon' when 1 then 'Line Coupon' when 2 then 'Group Damage' when 3 then 'Line Damage' when 4 then 'Group Promo'
      when 5 then 'Line Promo' when 6 then 'Associate' else 'Unknown' end as discount_type_description,
    case when td in ('00', '40') then 'Group Coupon' when td in ('11', '61') then 'Item Discount % Off' when td in ('12', '62') then 'Item Discount $ Off'
      when td in ('63', '03') then 'Group Discount % Off' when td in ('04', '14', '64') then 'Group Discount $ Off'
      when td in ('65', '15') then 'Free Item (Always % off)' when td in ('66', '06') then 'Promo Discount % Off'
      when td in ('07', '67') then 'Promo Discount $ Off' when td = '610' then 'Associate Discount % Off' when td in ('013', '613') then 'Deal Pricing Qty Break'
      when td in ('614', '014') then 'Deal Pricing % Off' when td in ('41', '51') then 'Line Coupon' when td in ('42', '52') then 'Group Damage'
      when td = '45' then 'Line Promo' when td in ('10', '60') then 'Default' when td in ('19', '114', '413', '441') then 'UNKNOWN' end as discount_deal_description
  from (select l_linenumber - 1 as t, l_partkey % 16 as d, cast(l_linenumber - 1 as varchar) || cast(l_partkey % 16 as varchar) as td from lineitem) x""")
def dim_discount_type(w):
    return dm.discount_type(w.work_discount)


PASS_THROUGH = "member_key bigint, {0} {1}, action_cd string, status string"


def loaded(name: str, key: str, kind: str, table: str, value: str, value_kind: str, derived: list[str]):
    """A member table of the work layer loaded into an empty dimension: everything is new."""
    @query(f"dim_{name}", f"member_key bigint, {key} {kind}, {value} {value_kind}, action_cd string, status string, surrogate bigint", f"""
      with r as (select member_key, {key}, {value}, 'I' as action_cd, row_number() over (order by lower(trim(cast({key} as varchar))), member_key, {key}) as surrogate
        from (select *, row_number() over (partition by member_key, lower(trim(cast({key} as varchar))) order by last_updated_date, {value}) as rn
          from w_{table}) x where rn = 1)
      select member_key, {key}, {value}, action_cd, 'current' as status, 0 as surrogate from r
      union all select member_key, {key}, {value}, action_cd, 'history' as status, 0 from r""")
    def run(w):
        rows = w[f"w_{table}"].select("member_key", key, value, F.col("last_updated_date").alias("changed"))
        target = rows.limit(0).select(F.lit(1).cast("bigint").alias("surrogate"), "member_key", key, value, "changed",
                                      F.col("changed").alias("last_updated_date"), F.lit("current").alias("status"), F.lit("0").alias("batch_id"))
        parts = scd.scd2_load(rows, target, ["member_key", key], "surrogate", BATCH, DAY, derived)
        return union_all(parts).withColumn("surrogate", F.lit(0))


loaded("member_multi_email", "email_address", "string", "multi_email", "email_consent", "string", [])
loaded("member_multi_phone", "phone_number", "bigint", "multi_phone", "phone_consent", "string", [])
loaded("member_consent", "consent_type", "string", "consent", "consent_value", "string", [])


def daily(name: str, table: str, key: str, kind: str, values: str, number: str):
    """A day of a stored member table: new, changed and untouched rows, and rows the day does not
    hold. Keys of stored rows follow from member and kind of row, those of new ones go on from there."""
    natural, surrogate, derived = dm.MEMBER_TABLES[name]
    origin = ", ".join(f"cast(member_key % {7 + i} as int) as {c}" for i, c in enumerate(derived))
    fresh = ", ".join(f"cast(100 + member_key % {7 + i} as int) as {c}" for i, c in enumerate(derived))
    value, *others = values.split(", ")
    names = ", ".join([value, *others])
    VIEWS[f"w_stored_{name}"] = f"""
      select {number} as {surrogate}, member_key, {key}, case when member_key % 5 = 0 then 'OLD' else {value} end as {value}, {"".join(o + ", " for o in others)}{origin},
        last_updated_date, 'current' as status, '20010731000000' as batch_id from {{w_{table}}} where member_key % 4 <> 0"""
    VIEWS[f"w_day_{name}"] = f"""
      select 0 as {surrogate}, member_key, {key}, {names}, {fresh}, last_updated_date, 'X' as action_flag,
        case when member_key % 9 = 1 then 'other' else 'till' end as process from {{w_{table}}} where member_key % 11 <> 0"""
    differ = " or ".join(f"lower(cast(s.{c} as varchar)) is distinct from lower(cast(t.{c} as varchar))" for c in [value, *others])
    taken = ", ".join(f"case when act = 'NCD' then t.{c} else s.{c} end as {c}" for c in [value, *others])
    first = ", ".join(f"case when act = 'I' then s.{c} else t.{c} end as {c}" for c in derived)
    sort = f"lower(trim({key}))" if kind == "string" else key
    columns = ", ".join([f"{surrogate} bigint", "member_key bigint", f"{key} {kind}", *[f"{c} {'date' if c.endswith('date') else 'string'}" for c in [value, *others]],
                         *[f"{c} int" for c in derived], "action_cd string", "last_updated_date date", "status string"])

    @query(f"dim_member_{name}_daily", columns, f"""
      with s as (select * from w_day_{name} where process = 'till'),
      c as (select t.{surrogate} as old_key, coalesce(s.member_key, t.member_key) as member_key, coalesce(s.{key}, t.{key}) as {key}, {taken}, {first}, act as action_cd, t.last_updated_date as was
        from (select s.member_key as sm, s.{key} as sk, t.member_key as tm, t.{key} as tk,
            case when t.member_key is null then 'I' when s.member_key is null then 'NCD' when {differ} then 'U' else 'NCD' end as act
          from s full join w_stored_{name} t on s.member_key = t.member_key and s.{key} = t.{key}) a
        left join s on s.member_key = sm and s.{key} = sk left join w_stored_{name} t on t.member_key = tm and t.{key} = tk),
      n as (select member_key, {key}, (select max({surrogate}) from w_stored_{name}) + row_number() over (order by member_key, {sort}, {key}) as new_key from c where action_cd <> 'NCD'),
      r as (select c.* exclude (old_key, was), coalesce(new_key, old_key) as {surrogate}, case when action_cd = 'NCD' then was else date '{DAY}' end as last_updated_date
        from c left join n on n.member_key = c.member_key and n.{key} = c.{key})
      select *, 'current' as status from r union all select *, 'history' from r where action_cd <> 'NCD'""")
    def run(w):
        stored_table = w.stored_dimension(f"w_stored_{name}", natural)
        return union_all(dm.member_table_load(name, w[f"w_day_{name}"], stored_table, "till", BATCH, DAY))


daily("multi_email", "multi_email", "email_address", "string", "email_consent, valid_email, consent_date",
      "member_key * 4 + case when email_address like 'alt%' then 1 else 0 end")
daily("multi_phone", "multi_phone", "phone_number", "bigint", "phone_consent, phone_type, consent_date",
      "member_key * 4 + case when phone_type = 'HOME' then 1 else 0 end")
daily("consent", "consent", "consent_type", "string", "consent_value, consent_date", "member_key * 4 + case when consent_type = 'SMS' then 1 else 0 end")


@query("dim_member", CHANGE + ", status string", """
  with k as (select member_key, (select max(member_sk) from w_scd_backup where status = 'current') + row_number() over (order by member_key) as sk
    from o_chg where action_cd <> 'NCD'),
  r as (select coalesce(k.sk, c.member_sk) as member_sk, c.member_key, first_name, city, state, original_source, action_cd
    from o_chg c left join k on k.member_key = c.member_key)
  select *, 'current' as status from r union all select *, 'history' from r where action_cd <> 'NCD'""")
def dim_member(w):
    work = w.scd_batch.withColumn("process", F.lit("till"))
    return union_all(scd.scd2_process_load(work, stored(w), "till", NATURAL, SK, BATCH, DAY, DERIVED))


# ---------------------------------------------------------------- joined dimensions

@query("dim_product", "item_nbr bigint, price_group_code string, class_cd int, class_name string, color_name string, size_name string, "
       "vendor_cd int, department_descr string, gender string, ticket_price double", """
  select cast(item_number as bigint) as item_nbr, nullif(price_group, '') as price_group_code, c.class_code as class_cd, class_name, color_name, size_name,
    vendor as vendor_cd, department_name as department_descr,
    case when coalesce(uda_value_desc, '') = '' then trim(department_stat_code) else substr(uda_value_desc, 1, 1) end as gender, ticket_price
  from w_work_item i left join w_work_item_class c on c.class_code = i.class_code_1
  left join w_work_item_style s on s.class = i.class_code_1 and s.style = i.style
  left join w_work_item_color o on o.color_code = i.color left join w_work_item_size z on z.size = i.size
  left join w_work_item_hier h on h.class_number = i.class_code_1
  left join (select item_number as u, uda_value_desc from w_work_item_uda where uda_id = 1) a on a.u = i.item_number""")
def dim_product(w):
    return dm.product(w.work_item, w.work_item_class, w.work_item_style, w.work_item_color, w.work_item_size,
                      w.work_item_hier, w.work_item_uda)


@query("dim_store_master", "store_id string, retail_web_flag string, open_closed_ind string, profile_description string, "
       "store_design_description string, store_type_description string, store_status_code string, sales_volume_class string, district_name string", """
  select cast(shop_number as varchar) as store_id, case when district_number = 97 then 'WEB' else 'RETAIL' end as retail_web_flag,
    case when act_open_date < date '2001-08-01' and last_close_date is null and sell_sq_ft > 1 then 'OPEN' else 'CLOSED' end as open_closed_ind,
    case shop_profile_code when 0 then 'No Profile Defined' when 1 then 'Single Entrance' when 2 then 'Multiple Entrances' when 3 then 'EXPBBW SXS'
      when 4 then 'EXPSTR SXS' when 5 then 'EXP/STR/BBW SXS' when 6 then 'EXP/LTD SXS' when 7 then 'EXP/LTD/STR SXS' when 8 then 'STR/BBW SXS'
      else 'UNKNOWN' end as profile_description,
    ['Undefined', 'White EXP', 'White EXP', 'Black & White', 'Slatwall', 'French', 'Old', 'Old Italian', 'New Italian', 'Industrial',
      'Brown Leather', 'Gen XY', 'Gen X', 'Gen Y', 'Haywood', 'Outlet', 'UNKNOWN', 'UNKNOWN'][shop_dsgn_cd + 1] as store_design_description,
    case shop_type_cd when 'D' then 'dual gender' when 'W' then 'womens' when 'M' then 'mens' else 'UNKNOWN' end as store_type_description,
    case shop_stat_cd when 'OPN' then 'Open' when 'LGL' then 'Legal Hold' else 'UNKNOWN' end as store_status_code,
    case vol_class_cd when 'A' then '$3.00 - $4.99 | 3,000,000' when 'A+' then '$5.00 and higher | 5,000,000' when 'C' then '$0.00 - $1.80 | 0'
      else 'UNKNOWN' end as sales_volume_class, district_name
  from w_work_shop s left join w_work_shop_hier h on h.site_code = s.shop_number left join w_work_shop_owner o on o.shop_nbr = s.shop_number""")
def dim_store_master(w):
    return dm.store_master(w.work_shop, w.work_shop_hier, w.work_shop_owner, DAY)


CHECK_VIEWS["o_fiscal"] = "select sdate, cast(date_trunc('month', sdate) as date) as fiscal_month_begin_date from w_date"


@query("dim_scoring_model", "scoring_model_key bigint, model_id int, model_version_id int, current_model_ind string, effective_date date, "
       "expiration_date date, scored_record_count bigint, data_through_date date, status string", """
  with day as (select min(sdate) as d, min(fiscal_month_begin_date) - 1 as t from o_fiscal where dayofweek(sdate) = 3
      and strftime(fiscal_month_begin_date, '%Y-%m') = '2001-05'),
  fresh as (select (select max(scoring_model_key) from w_work_scoring_model where status = 'current') + case model_id when 104 then 1 else 2 end as scoring_model_key,
      model_id, model_version_id + 1 as model_version_id, current_model_ind, d as effective_date, date '2099-12-31' as expiration_date,
      case model_id when 104 then 1200 else 400 end as scored_record_count, t as data_through_date
    from w_work_scoring_model, day where status = 'current' and model_id in (104, 108) and upper(trim(current_model_ind)) = 'YES')
  select scoring_model_key, model_id, model_version_id, current_model_ind, effective_date, expiration_date, scored_record_count, data_through_date, status
    from w_work_scoring_model where status = 'current' and model_id not in (104, 108)
  union all select *, 'current' from fresh union all select *, 'history' from fresh
  union all select scoring_model_key, model_id, model_version_id, case when model_id in (104, 108) then 'NO' else current_model_ind end, effective_date,
    case when model_id in (104, 108) then (select d - 1 from day) else expiration_date end, scored_record_count, data_through_date, status
    from w_work_scoring_model where status = 'history'""")
def dim_scoring_model(w):
    calendar = w.date.withColumn("fiscal_month_begin_date", F.trunc("sdate", "month"))
    day = dm.first_fiscal_wednesday(calendar, "2001-05-10").first()
    return union_all(dm.scoring_model(w.work_scoring_model, {104: 1200, 108: 400}, day["scoring_day"].isoformat(),
                                      day["data_through_date"].isoformat()))


VIEWS["w_work_hist_household"] = """
select household_key, address1, add_date, add_date as first_trxn_date, add_date as introduction_date, date '2000-02-01' as last_store_purch_date,
  date '2099-02-01' as last_web_purch_date, cast(null as date) as account_open_date, date '2001-07-01' as ingest_date from {w_household}
union all
select household_key, address1, add_date, add_date, add_date, date '2000-03-01', date '2099-02-01', cast(null as date), date '2001-06-01'
from {w_household} where household_key % 2 = 0
"""
INLINE.add("w_work_hist_household")
CHECK_VIEWS["o_hh"] = """
select row_number() over (order by household_key, ingest_date) as household_id, household_key, ingest_date,
  coalesce(a.date_key, -1) as add_date_key, coalesce(l.date_key, -1) as last_store_purch_date_key, -1 as account_open_date_key
from w_work_hist_household left join w_date a on a.sdate = add_date left join w_date l on l.sdate = last_store_purch_date
"""


@query("hist_household", "household_id bigint, household_key bigint, add_date_key bigint, last_store_purch_date_key bigint, "
       "account_open_date_key bigint, status string", """
  select household_id, household_key, add_date_key, last_store_purch_date_key, account_open_date_key, 'history' as status from o_hh
  union all select household_id, household_key, add_date_key, last_store_purch_date_key, account_open_date_key, 'current' from o_hh
    where ingest_date = date '2001-07-01'""")
def hist_household(w):
    current, history = dm.household_history(w.work_hist_household, w.date)
    return union_all([current.withColumn("status", F.lit("current")), history.withColumn("status", F.lit("history"))])


@query("hist_member", "member_id bigint, member_key bigint, status string", """
  select row_number() over (order by member_key) as member_id, member_key, status from w_member, (select unnest(['current', 'history']) as s) x
  where s = 'current' union all select row_number() over (order by member_key), member_key, 'history' from w_member""")
def hist_member(w):
    return dm.member_history(w.member.drop("status"), "member_id", [F.col("member_key")])


@query("hist_member_email", "email_id bigint, member_key bigint, email_address string, status string", """
  with r as (select row_number() over (order by member_key, email_address) as email_id, member_key, email_address from w_multi_email)
  select *, 'current' as status from r union all select *, 'history' from r""")
def hist_member_email(w):
    return dm.member_history(w.multi_email.drop("status"), "email_id", [F.col("member_key"), F.col("email_address")])
