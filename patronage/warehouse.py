"""A customer warehouse derived from the test tables.

Every view is one SELECT in the dialect that Spark SQL and DuckDB share, so the same text
feeds the Spark jobs (as DataFrames) and the checking SQL (as CTEs). Each view is a narrow
projection of its base table, so its size grows with the data.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession

from .operators.sizing import plan_bytes
from .operators.staging import stage_table, staging_folder
from .plans.scd import store_dimension

BASE = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

DAY0 = "date '2001-08-01'"  # the newest order date at every scale

VIEWS: dict[str, str] = {}

# k: customer; p: the person behind it (3, 7 and 17 repeat the customer before);
# e / h: whose e-mail and phone it uses
VIEWS["w_base"] = """
select c_custkey as k, c_nationkey as nk, c_acctbal as bal, c_mktsegment as seg,
  case when c_custkey % 10 in (3, 7) then c_custkey - 1 else c_custkey end as p,
  case when c_custkey % 6 = 5 then c_custkey - 1 else c_custkey end as e,
  case when c_custkey % 8 = 7 then c_custkey - 2 else c_custkey end as h
from {customer}
"""

VIEWS["w_person"] = """
select k, p, e, h, nk, bal, seg,
  trim(substr('Anna Bert Carl Dora Emma Fred Gina Hugo Iris John ', 1 + 5 * cast(p % 10 as int), 5)) as fn,
  substr('barkelmonrudsentol', 1 + 3 * cast(p % 6 as int), 3)
    || substr('tamwiskorpelvonlin', 1 + 3 * cast(floor(p / 10) % 6 as int), 3)
    || substr('erdalmosnixpunzek', 1 + 3 * cast(floor(p / 60) % 5 as int), 3)
    || case when k % 20 = 7 then 'a' else '' end as ln,
  cast(p % 900 + 1 as string) || ' ' || trim(substr('Main Oak  Pine Lake Hill ', 1 + 5 * cast(p % 5 as int), 5))
    || case when k % 20 = 17 then ' STT' else ' ST' end as addr1,
  case when p % 5 = 0 then 'Apt ' || cast(p % 30 as string) else null end as addr2,
  trim(substr('Avon Bath Cork Deal Eton Fife ', 1 + 5 * cast(p % 6 as int), 5)) as cty,
  substr('OHNYCATXMIFL', 1 + 2 * cast(p % 6 as int), 2) as st,
  case when p % 11 = 0 then '4' || lpad(cast(p % 9999 as string), 8, '0')
       else lpad(cast(10000 + (p % 800) * 7 as string), 5, '0') end as zip,
  'user' || cast(e as string) || '@mail.example' as mail,
  case when k % 23 = 0 then '5555555555' when k % 53 = 0 then '123456789' when k % 59 = 0 then '1234567890'
       else cast(2125550000 + h * 13 as string) end as ph
from {w_base}
"""

VIEWS["w_member"] = """
select k + 1 as member_key,
  case when k % 17 = 0 then cast(-1 as bigint) else cast(floor(k / 3) as bigint) + 1 end as household_key,
  case when k % 41 = 0 then null when k % 7 = 0 then upper(fn) else fn end as first_name,
  case when k % 43 = 0 then '  ' else ln end as last_name,
  case when k % 47 = 0 then '' else addr1 end as address1, addr2 as address2, cty as city, st as state, zip as zip_code,
  case when k % 4 = 0 then 'LY' || lpad(cast(k as string), 11, '0')
       when k % 12 = 1 then 'LY' || lpad(cast(k - 1 as string), 11, '0')
       when k % 12 = 5 then ' ' else null end as loyalty_id,
  case when k % 5 = 0 then 'IP' || cast(k as string) else null end as ip_code,
  case when k % 37 = 0 then null else mail end as email_address, ph as phone_nbr,
  case when k % 3 = 0 then 'YES' else 'NO' end as is_dm_marketable,
  case when k % 4 < 2 then 'YES' else 'NO' end as is_em_marketable,
  case when k % 5 = 0 then 'YES' else 'NO' end as is_sms_marketable,
  case when k % 29 = 0 then null else date '1996-01-01' + cast((k * 7) % 2000 as int) end as customer_introduction_date,
  case when k % 13 = 0 then null else cast(k % 9 - 1 as int) end as source_overlay_rank,
  case when k % 19 = 0 then null else cast(k % 4 as int) end as dpv_key,
  date '2000-01-01' + cast((k * 11) % 500 as int) as last_updated_date,
  case when k % 31 = 0 then null else 28.0 + (k * 37 % 1800) / 100.0 end as latitude,
  case when k % 31 = 0 then null else -120.0 + (k * 53 % 4500) / 100.0 end as longitude,
  case when k % 6 = 0 then 'PROSPECT' when k % 6 = 1 then 'REQUESTER' else 'CUSTOMER' end as record_type,
  case k % 5 when 0 then 'ACTIVE' when 1 then 'INACTIVE' when 2 then 'CLOSED' else null end as member_status,
  case k % 4 when 0 then 'MALE' when 1 then 'FEMALE' when 2 then 'UNKNOWN' else null end as gender,
  case when k % 6 = 0 then 'YES' when k % 6 < 4 then 'NO' else null end as deceased,
  case when k % 7 = 0 then null else date '1950-01-01' + cast((p * 97) % 14000 as int) end as birth_date,
  case when k % 5 = 4 then null else 'YES' end as direct_mail_consent_raw,
  case k % 3 when 0 then 'YES' when 1 then 'NO' else 'UNKNOWN' end as direct_mail_consent,
  case when k % 8 = 0 then null else date '1999-01-01' + cast((k * 3) % 700 as int) end as direct_mail_consent_date,
  cast(k % 12 as int) as original_source_key, cast(k % 10 as int) as current_source_key,
  case k % 3 when 0 then 'O' when 1 then 'C' else null end as open_close_ind,
  case when k % 9 = 0 then null else date '1997-01-01' + cast((k * 5) % 1500 as int) end as first_trxn_date,
  k % 40 + 1 as first_trxn_store_key,
  date '1998-01-01' + cast((k * 17) % 900 as int) as last_store_purchase_date,
  case when k % 10 = 0 then null else date '1998-01-01' + cast((k * 19) % 900 as int) end as last_web_purchase_date,
  date '1997-06-01' + cast((k * 23) % 1200 as int) as enrollment_date,
  cast(k % 5 as int) as promotion_count, cast(1 + k % 3 as int) as tier_key,
  k % 7 as overlay_rank_key, 'current' as status, '20010731000000' as batch_id
from {w_person}
"""

VIEWS["w_multi_email"] = """
select k + 1 as member_key, case when k % 10 = 9 then upper(mail) else mail end as email_address,
  case k % 3 when 0 then 'YES' when 1 then 'NO' else 'UNKNOWN' end as email_consent,
  case when k % 5 = 0 then 'NO' else 'YES' end as valid_email,
  case when k % 2 = 0 then 'YES' else 'NO' end as best_email_flag,
  case when k % 4 = 0 then 'YES' else 'NO' end as is_loyalty_email,
  date '1999-01-01' + cast((k * 3) % 900 as int) as consent_date,
  date '2000-01-01' + cast((k * 7) % 500 as int) as last_updated_date, 'current' as status
from {w_person} where k % 37 <> 0
union all
select k + 1 as member_key, 'alt' || cast(floor(k / 2) as bigint) || '@mail.example' as email_address,
  case k % 4 when 0 then 'YES' else 'NO' end as email_consent,
  'YES' as valid_email, 'NO' as best_email_flag, 'NO' as is_loyalty_email,
  date '1999-06-01' + cast((k * 5) % 900 as int) as consent_date,
  date '2000-03-01' + cast((k * 13) % 500 as int) as last_updated_date, 'current' as status
from {w_person} where k % 3 <> 0
"""

VIEWS["w_multi_phone"] = """
select k + 1 as member_key, cast(ph as bigint) as phone_number, 'MOBILE' as phone_type,
  case k % 3 when 0 then 'YES' when 1 then 'NO' else 'UNKNOWN' end as phone_consent,
  case when k % 4 = 0 then 'YES' else 'NO' end as is_loyalty_flag,
  case when k % 2 = 0 then 'YES' else 'NO' end as best_mobile_flag,
  cast(k % 4 as int) as acknowledgements,
  case when k % 7 = 0 then null else date '1999-01-01' + cast((k * 3) % 900 as int) end as consent_date,
  date '2000-01-01' + cast((k * 7) % 500 as int) as last_updated_date, 'current' as status
from {w_person}
union all
select k + 1 as member_key, 6145550000 + cast(floor(k / 4) as bigint) as phone_number, 'HOME' as phone_type,
  'UNKNOWN' as phone_consent, 'NO' as is_loyalty_flag, 'NO' as best_mobile_flag, 0 as acknowledgements,
  cast(null as date) as consent_date,
  date '2000-03-01' + cast((k * 13) % 500 as int) as last_updated_date, 'current' as status
from {w_person} where k % 2 = 1
"""

VIEWS["w_card_type"] = """
select cast(r_regionkey + 1 as bigint) as card_type_key, 'CT' || cast(r_regionkey as string) as tender_type_code,
  case when r_regionkey % 2 = 0 then 'YES' else 'NO' end as is_plcc,
  case when r_regionkey % 2 = 1 then 'YES' else 'NO' end as is_credit_card, 'current' as status
from {region}
"""

VIEWS["w_tender_type"] = """
select cast(r_regionkey + 1 as bigint) as tender_type_key, 'TT' || cast(r_regionkey as string) as tender_type_code,
  case when r_regionkey in (1, 2, 4) then 'YES' else 'NO' end as is_bank_card, 'current' as status
from {region}
"""

VIEWS["w_card_history"] = """
select lpad(cast(40000000 + case when k % 9 = 8 then k - 1 else k end as string), 18, '0') as tokenized_cc_nbr,
  k % 5 + 1 as card_type_key, k + 1 as member_key,
  case when k % 2 = 0 then 'YES' else 'NO' end as is_primary_account_holder,
  case when k % 3 = 0 then 'O' else 'C' end as open_close_ind,
  date '2000-01-01' + cast((k * 7) % 500 as int) as last_updated_date, 'current' as status, '20010731000000' as batch_id
from {w_base}
"""

VIEWS["w_tender_history"] = """
select o_orderkey as trxn_id, o_custkey + 1 as member_key,
  cast(substr(o_orderpriority, 1, 1) as bigint) as tender_type_key,
  51000000 + case when o_custkey % 7 = 6 then o_custkey - 1 else o_custkey end as tokenized_cc_nbr,
  cast(floor(o_totalprice) / 100 as decimal(12, 2)) as tender_amount, cast(o_orderdate as date) as trxn_date
from {orders}
"""

VIEWS["w_employee"] = """
select lpad(cast(7000 + k as string), 11, '0') as employee_id, k + 1 as member_key,
  case when k % 22 = 0 then 'TERMINATED' else 'ACTIVE' end as employee_status, fn as first_name, ln as last_name,
  date '1998-01-01' + cast((k * 3) % 900 as int) as hire_date,
  date '2000-01-01' + cast((k * 7) % 500 as int) as last_updated_date, 'current' as status
from {w_person} where k % 11 = 0
"""

VIEWS["w_trxn_head"] = """
select o_orderkey as trxn_id, o_custkey + 1 as member_key, cast(o_orderdate as date) as trxn_date,
  cast(o_orderkey % 1440 as int) as trxn_time_key, o_totalprice, o_orderstatus, o_orderpriority
from {orders}
"""

VIEWS["w_feed"] = """
select 'F' || lpad(cast(k as string), 9, '0') || '-2001' || lpad(cast(1 + k % 7 as string), 2, '0') || '15' as etl_unique_id,
  k as feed_nbr, 'T' || cast(k as string) as transaction_id,
  case when k % 16 = 0 then 'LY' || lpad(cast(k as string), 11, '0')
       when k % 16 = 1 then 'NEW' || cast(k as string) when k % 16 = 3 then ' ' else null end as implied_loyalty_id,
  case when k % 7 < 2 then lpad(cast(40000000 + k as string), 18, '0')
       when k % 7 = 2 then lpad(cast(51000000 + k as string), 18, '0')
       when k % 7 = 3 then '000000000000000000' else null end as tender_number,
  'CT' || cast(k % 6 as string) as tender_type,
  case when k % 11 < 2 then cast(7000 + k as string) else null end as employee_id,
  case when k % 10 = 0 then 'IP' || cast(k as string) when k % 10 = 1 then 'IPX' else null end as ip_code,
  case when k % 4 = 1 then null when k % 9 = 0 then upper(fn) || ' ' else fn end as first_name,
  case when k % 4 in (1, 2) then ' ' else ln end as last_name,
  case when k % 5 < 3 then upper(addr1) else null end as address_line_1,
  case when k % 5 < 3 then addr2 else null end as address_line_2,
  cty as city, st as state,
  case when k % 6 = 0 then null else zip end as zip_code,
  case when k % 6 = 0 then 'K1A ' || cast(k % 9 as string) || 'B1' else null end as non_usa_postal_code,
  case when k % 3 = 0 then null when k % 8 = 1 then ' ' || upper(mail) else mail end as email_address,
  case when k % 2 = 0 then ph when k % 6 = 1 then '(' || substr(ph, 1, 3) || ') ' || substr(ph, 4, 3) || '-' || substr(ph, 7, 4)
       else null end as phone,
  case when k % 13 = 0 then k + 1 when k % 13 = 1 then cast(0 as bigint) else null end as known_member_key,
  case k % 3 when 0 then 'Male' when 1 then 'female' else 'F' end as gender,
  cast(k % 60 + 1 as bigint) as store_key
from {w_person}
union all
select 'N' || lpad(cast(k as string), 9, '0') || '-20010820' as etl_unique_id,
  k + 1000000000 as feed_nbr, 'TN' || cast(k as string) as transaction_id,
  case when k % 8 = 0 then 'NX' || cast(floor(k / 16) as bigint) else null end as implied_loyalty_id,
  case when k % 8 = 2 then lpad(cast(90000000 + cast(floor(k / 16) as bigint) as string), 18, '0') else null end as tender_number,
  'CT1' as tender_type, null as employee_id, null as ip_code,
  case when k % 8 in (1, 3) then fn else null end as first_name,
  case when k % 8 in (1, 3) then ln || 'new' else null end as last_name,
  case when k % 8 in (1, 3) then addr1 else null end as address_line_1, null as address_line_2, cty as city, st as state,
  case when k % 8 = 1 then '99' || substr(zip, 1, 3) else null end as zip_code,
  case when k % 8 = 3 then 'V5K 0A' || cast(k % 10 as string) else null end as non_usa_postal_code,
  case when k % 8 = 4 then 'new' || cast(floor(k / 16) as bigint) || '@mail.example' else null end as email_address,
  case when k % 8 = 5 then cast(3105550000 + k as string) when k % 8 = 6 then '7777777777' else null end as phone,
  null as known_member_key, 'Male' as gender, cast(k % 60 + 1 as bigint) as store_key
from {w_person} where k % 2 = 0 or k % 8 in (1, 3, 5)
"""

VIEWS["w_record_info"] = """
select min(p_partkey) + 1 as record_info_key, has_name, has_address, has_email, has_phone, has_mobile, has_plcc,
  has_bank_card, has_loyalty, has_member
from (select p_partkey,
  case when p_partkey % 2 = 0 then 'Yes' else 'No ' end as has_name,
  case when floor(p_partkey / 2) % 2 = 0 then 'YES' else 'NO' end as has_address,
  case when floor(p_partkey / 4) % 2 = 0 then 'YES' else 'NO' end as has_email,
  case when floor(p_partkey / 8) % 2 = 0 then 'YES' else 'NO' end as has_phone,
  'NO' as has_mobile,
  case when floor(p_partkey / 16) % 2 = 0 then 'YES' else 'NO' end as has_plcc,
  case when floor(p_partkey / 32) % 2 = 0 then 'YES' else 'NO' end as has_bank_card,
  case when floor(p_partkey / 64) % 2 = 0 then 'YES' else 'NO' end as has_loyalty,
  case when floor(p_partkey / 128) % 2 = 0 then 'YES' else 'NO' end as has_member
  from {part}) x
group by has_name, has_address, has_email, has_phone, has_mobile, has_plcc, has_bank_card, has_loyalty, has_member
"""

VIEWS["w_store"] = """
select s_suppkey + 1 as store_key, s_suppkey + 100 as store_id, s_name as store_name,
  case when s_suppkey % 10 = 9 then '97' else lpad(cast(s_suppkey % 20 as string), 2, '0') end as district_code,
  cast(1 + s_suppkey % 8 as int) as zone_code,
  case when s_suppkey % 10 = 9 then 'WEB' else 'RETAIL' end as retail_web_flag,
  28.0 + (s_suppkey * 71 % 1800) / 100.0 as latitude, -120.0 + (s_suppkey * 97 % 4500) / 100.0 as longitude,
  case when s_suppkey % 7 = 3 then 'CLOSED' else 'OPEN' end as open_closed_ind,
  date '1990-01-01' + cast(s_suppkey % 3000 as int) as open_date, s_acctbal as sq_ft, s_nationkey, 'current' as status
from {supplier}
"""

VIEWS["w_product"] = """
select p_partkey + 1 as product_key, lpad(cast(p_partkey as string), 8, '0') as item_nbr,
  case p_partkey % 5 when 0 then 'W' when 1 then 'W' when 2 then 'M' when 3 then 'M' else 'G' end as gender,
  p_brand, p_type, p_size, p_retailprice, p_name, 'current' as status
from {part}
"""

VIEWS["w_trxn"] = """
select l_orderkey as trxn_id, l_linenumber as trxn_seq_nbr, o_custkey + 1 as member_key,
  l_suppkey + 1 as store_key, l_partkey + 1 as product_key, cast(o_orderdate as date) as trxn_date,
  cast(o_orderkey % 1440 as int) as trxn_time_key,
  case when l_returnflag = 'R' then -1 else 1 end as purchase_qty,
  cast(case when l_returnflag = 'R' then -l_quantity else l_quantity end as int) as units,
  cast(case when l_partkey % 3 = 0 then floor(l_extendedprice / 100) + 0.99 else floor(l_extendedprice) / 100 end as decimal(10, 2)) as retail_amount,
  cast(case when l_returnflag = 'R' then -1 else 1 end * floor(l_extendedprice * (100 - round(l_discount * 100)) / 100) / 100 as decimal(10, 2)) as total_line_amnt_after_discount,
  cast(floor(l_extendedprice * round(l_discount * 100) / 100) / 100 as decimal(10, 2)) as discount_amount,
  case l_linenumber when 2 then '8888' when 3 then '1417' when 5 then '0500' when 6 then '4321' else null end as ring_code_used,
  case when l_partkey % 25 = 4 then 'YES' else 'NO' end as gift_card_sales_ind,
  case when l_linenumber = 7 then 'YES' else 'NO' end as is_shipping_cost,
  case when l_linestatus = 'F' then 'YES' else 'NO' end as is_captured_loyalty,
  cast(l_shipdate as date) as ship_date
from {lineitem} join {orders} on l_orderkey = o_orderkey
"""

VIEWS["w_date"] = """
select distinct cast(o_orderdate as date) as sdate,
  cast(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) as bigint) as date_key
from {orders} where cast(o_orderdate as date) < date '2001-07-01'
"""


VIEWS["w_household"] = """
select household_key, string_agg(cast(member_key as string), ',') as associated_member_key, count(*) as associated_member_count,
  min(customer_introduction_date) as add_date, min(address1) as address1, min(zip_code) as zip_code, min(record_type) as record_type
from {w_member} where household_key <> -1 group by household_key
"""

VIEWS["w_constant"] = """
select r_regionkey + 1 as constant_id, 'GENDER' as constant_type,
  case r_regionkey when 0 then ' Male' when 1 then 'FEMALE ' when 2 then 'unknown' else 'x' || r_name end as constant_value from {region}
union all
select r_regionkey + 11 as constant_id, 'STATUS' as constant_type,
  case r_regionkey when 0 then 'active' when 1 then ' Inactive' else 'y' || r_name end as constant_value from {region}
"""

# stored dimension of the last batches, and the work table of the next one
VIEWS["w_scd_backup"] = """
select k + 1 as member_sk, k + 1 as member_key, 'G' || cast(k % 3 as string) as segment_group, fn as first_name, cty as city,
  case when k % 9 = 0 then null else st end as state, case when k % 4 = 0 then 'A' else null end as original_source,
  date '2001-07-31' as last_updated_date, 'current' as status, '20010731000000' as batch_id
from {w_person} where k % 11 <> 5
union all
select k + 1 as member_sk, k + 1 as member_key, 'G0' as segment_group, fn as first_name, 'OLD' as city, st as state,
  'B' as original_source, date '2001-07-01' as last_updated_date, 'current' as status, '20010701000000' as batch_id
from {w_person} where k % 5 = 0
union all
select k + 1 as member_sk, k + 1 as member_key, 'G0' as segment_group, fn as first_name, 'OLDER' as city, st as state,
  'B' as original_source, date '2001-07-31' as last_updated_date, 'history' as status, '20010731000000' as batch_id
from {w_person} where k % 7 = 0
"""

VIEWS["w_scd_batch"] = """
select k + 1 as member_key, 'G' || cast(k % 3 as string) as segment_group, case when k % 6 = 0 then upper(fn) else fn end as first_name,
  case when k % 10 = 0 then 'NEWTOWN' else cty end as city,
  case when k % 18 = 0 then st when k % 9 = 0 then null else st end as state,
  case when k % 2 = 0 then 'Z' else null end as original_source,
  'E' || cast(k as string) || '-20010801' as etl_unique_id
from {w_person} where k % 13 <> 4
union all
select k + 1 as member_key, 'G9' as segment_group, fn as first_name, 'STALE' as city, st as state, 'Y' as original_source,
  'E' || cast(k as string) || '-20010701' as etl_unique_id
from {w_person} where k % 21 = 0
"""

VIEWS["w_consent"] = """
select k + 1 as member_key, 'DM' as consent_type, case k % 3 when 0 then 'YES' when 1 then 'NO' else 'UNKNOWN' end as consent_value,
  date '1999-01-01' + cast((k * 3) % 700 as int) as consent_date, k * 2 as consent_history_id,
  date '2000-01-01' + cast((k * 7) % 500 as int) as last_updated_date, 'current' as status
from {w_base}
union all
select k + 1 as member_key, 'SMS' as consent_type, case k % 2 when 0 then 'YES' else 'NO' end as consent_value,
  date '1999-01-01' + cast((k * 5) % 700 as int) as consent_date, k * 2 + 1 as consent_history_id,
  date '2000-01-01' + cast((k * 11) % 500 as int) as last_updated_date, 'current' as status
from {w_base} where k % 4 <> 0
"""

VIEWS["w_dup_member"] = """
select member_key, household_key,
  case when member_key % 8 = 2 then null else first_name end as first_name,
  case when member_key % 8 = 2 then 'UNKNOWN' else last_name end as last_name,
  case when member_key % 8 = 2 then null else address1 end as address1_scrubbed,
  case when member_key % 8 = 2 then null else address2 end as address2_scrubbed,
  city as city_scrubbed, state as state_scrubbed,
  case when member_key % 8 = 2 then ' ' else zip_code end as zip_code_scrubbed,
  loyalty_id, case when trim(loyalty_id) <> '' then 'YES' else 'NO' end as is_loyalty_member, member_status, ip_code,
  tier_key as current_tier_key, enrollment_date as member_acct_enroll_date,
  customer_introduction_date, source_overlay_rank, overlay_rank_key, dpv_key, last_updated_date, latitude, longitude,
  gender, direct_mail_consent, direct_mail_consent_date, birth_date, deceased,
  case when member_key % 3 = 0 then 'NO' when member_key % 11 = 0 then 'YES' else null end as promotion_consent,
  original_source_key, current_source_key, open_close_ind, first_trxn_date, first_trxn_store_key,
  last_store_purchase_date as last_store_purch_date, last_web_purchase_date as last_web_purch_date,
  cast(promotion_count as bigint) as prospect_contact_count, email_address, record_type, phone_nbr, batch_id, status
from {w_member}
"""

VIEWS["w_dup_card"] = """
select k + 1 as member_key, case when k % 8 = 1 then '000' || cast(7000 + cast(floor(k / 128) as bigint) as string)
    else '00' || cast(40000000 + k as string) end as tokenized_cc_nbr
from {w_base} where k % 8 <> 1 or floor(k / 8) % 4 = 0
union all
select k + 1 as member_key, '0' || cast(9000 + k as string) as tokenized_cc_nbr from {w_base} where k % 256 = 33
"""

VIEWS["w_dup_email"] = """
select k + 1 as member_key, case when k % 8 <> 1 then 'user' || cast(e as string) || '@mail.example'
    when floor(k / 8) % 4 = 1 then 'grp' || cast(cast(floor(k / 64) as bigint) as string) || '@mail.example'
    else 'both' || cast(cast(floor(k / 128) as bigint) as string) || '@mail.example' end as email_address
from {w_base} where k % 8 <> 1 or floor(k / 8) % 2 = 1
union all
select k + 1 as member_key, 'only' || cast(k as string) || '@mail.example' as email_address
from {w_base} where k % 8 = 1 and floor(k / 8) % 12 in (1, 3)
"""

VIEWS["w_dup_phone"] = """
select k + 1 as member_key, case when k % 8 <> 1 then 2125550000 + h
    when floor(k / 8) % 4 = 2 then 3305550000 + cast(floor(k / 96) as bigint)
    else 4405550000 + cast(floor(k / 64) as bigint) end as phone_number
from {w_base} where k % 8 <> 1 or floor(k / 8) % 4 in (2, 3)
"""

VIEWS["w_dup_info"] = """
select distinct cast(p_size % 25 as string) as dedupe_info_key,
  case cast(floor(p_size % 25 / 5) as int) when 0 then 1 when 1 then 3 when 2 then 5 when 3 then 4 else 7 end as id_condition,
  case p_size % 5 when 0 then 1 when 1 then 2 when 2 then 3 when 3 then 4 else -1 end as collection_type,
  'rule ' || cast(cast(floor(p_size % 25 / 5) as int) as string) as id_condition_desc, 'collection ' || cast(p_size % 5 as string) as collection_type_descr
from {part}
"""

# Building blocks of other views, and views that only rename and blank out what a written table holds
INLINE = {"w_base", "w_person", "w_dup_member"}

# of a stored file: what one task computes the columns of the member tables for
TASK_BYTES = 1024 * 1024


class Warehouse:
    """Test tables and derived tables of one data folder. As in a stored warehouse, a derived
    table is written once, on first use, and all jobs then scan the written table."""

    _cache: dict = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._frames: dict[str, DataFrame] = {}
        self._dealt: set[str] = set()  # tables whose rows were dealt before their columns were computed

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> "Warehouse":
        """One object per session and folder, so file footers are read once."""
        key = (spark.sparkContext.applicationId, folder.rstrip("/"))
        if key not in cls._cache:
            cls._cache[key] = cls(spark, folder)
        return cls._cache[key]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in BASE:
                self._frames[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
            else:
                refs = self._refs(name)
                view = self.spark.sql(VIEWS[name], **refs)
                if refs and set(refs) <= self._dealt:
                    self._dealt.add(name)
                if name not in INLINE:
                    view = stage_table(view, f"{self._tag}/{name}", list(refs.values()), balanced=name in self._dealt)
                self._frames[name] = view
        return self._frames[name]

    @property
    def _tag(self) -> str:
        return hashlib.md5(self.folder.encode()).hexdigest()[:8]

    def _refs(self, name: str, **given: DataFrame) -> dict[str, DataFrame]:
        names = set(re.findall(r"\{(\w+)\}", VIEWS[name]))
        return {r: given[r] if r in given else self._deal(r) if name == "w_base" else self[r] for r in names}

    def _deal(self, name: str) -> DataFrame:
        """A base table in as many parts as its size asks for. Its file may be one block, which one
        task reads: all columns of the member tables would be computed there, and their wide rows
        be dealt instead of these narrow ones."""
        parts = -(-plan_bytes(self[name]) // TASK_BYTES)
        if parts <= 1:
            return self[name]
        self._dealt.add("w_base")
        return self[name].repartition(parts)

    def view(self, name: str, **given: DataFrame) -> DataFrame:
        """A derived table that is not written, for a job that reads it once, or out of other
        tables than the stored ones."""
        return self.spark.sql(VIEWS[name], **self._refs(name, **given))

    def narrow(self, name: str, columns: list[str]) -> DataFrame:
        """Some columns of a derived table. If no job has written all of it, these are written
        alone: its join moves and its files hold only what the job reads."""
        if name in self._frames:
            return self._frames[name].select(*columns)
        key = f"{name}-{'-'.join(sorted(columns))}"
        if key not in self._frames:
            refs = self._refs(name)
            rows = self.spark.sql(VIEWS[name], **refs).select(*sorted(columns))
            digest = hashlib.md5(key.encode()).hexdigest()[:8]
            self._frames[key] = stage_table(rows, f"{self._tag}/{name}-{digest}", list(refs.values()))
        return self._frames[key]

    def staged(self, name: str, build, balanced: bool = False) -> DataFrame:
        """Result of an earlier job that later jobs start from: written on first use."""
        if name not in self._frames:
            self._frames[name] = stage_table(build(self), f"{self._tag}/{name}", balanced=balanced)
        return self._frames[name]

    def stored_dimension(self, name: str, natural_keys: list[str]) -> DataFrame:
        """A derived table as a load keeps it: bucketed by its natural key."""
        key = f"{name} by {' '.join(natural_keys)}"
        if key not in self._frames:
            tag = self._tag
            self._frames[key] = store_dimension(self[name], natural_keys, f"dim_{tag}_{name}", f"{staging_folder(self.spark)}/{tag}/dim_{name}")
        return self._frames[key]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self["w_" + name] if "w_" + name in VIEWS else self[name]


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """Put the CTEs that a checking query needs in front of it."""
    texts = {**VIEWS, **(extra or {})}
    order: list[str] = []

    def visit(text: str) -> None:
        for ref in re.findall(r"\b([wo]_\w+)\b", text):
            if ref in texts and ref not in order:
                visit(texts[ref])
                if ref not in order:
                    order.append(ref)

    visit(sql)
    if not order:
        return sql
    ctes = ",\n".join(f"{n} as ({re.sub(r'[{}]', '', texts[n]).strip()})" for n in order)
    return f"with {ctes}\n{sql.strip()}"
