"""Queries of the survivorship transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.sets import union_all
from ..operators.staging import stage
from ..plans import consent as cs, transform as tf
from ..plans.feed_maps import FEED_DERIVED, FEED_MAPPINGS
from ..registry import CHECK_VIEWS, query
from ..warehouse import INLINE, VIEWS

DAY = "2001-08-01"

VIEWS["w_target"] = """
select k + 1 as member_key, case when k % 8 = 0 then null else fn end as first_name, case when k % 8 = 0 then ' ' else ln end as last_name,
  case when k % 8 = 0 then null else addr1 end as address1, addr2 as address2, cty as city, st as state,
  case when k % 8 = 0 then '' else substr(zip, 1, 5) end as zip_code, cast(null as string) as zip4, cast(null as string) as zip_full,
  case when k % 8 = 0 then null else k % 12 end as overlay_rank_key, cast(null as bigint) as overlay_load_id,
  case when k % 5 = 0 then null else date '2000-01-01' + cast((k * 3) % 500 as int) end as overlay_date,
  case k % 3 when 0 then 'YES' when 1 then 'NO' else null end as is_plcc, case k % 4 when 0 then 'MALE' when 1 then '' else null end as gender,
  cast(k % 10 as int) as current_source_key, case when k % 6 = 0 then 'Prospect ' else 'CUSTOMER' end as record_type,
  case k % 3 when 0 then 'YES' else 'NO' end as direct_mail_consent, 'NO' as deceased, cast(null as string) as address_is_prison,
  cast(null as string) as dwelling_type, cast(null as string) as valid_strict, cast(null as string) as valid_loose, cast(null as string) as ncoa_last_change_date,
  k % 9 as tier_key, case when k % 3 = 0 then upper(ln) else null end as last_name_scrubbed, cast(null as string) as address1_scrubbed,
  cast(null as string) as zip_code_scrubbed
from {w_person}
"""
VIEWS["w_cm_rows"] = """
select 'E' || lpad(cast(k as string), 9, '0') || '-20010720' as etl_unique_id, k % 5 < 3 as match_status,
  case when k % 5 < 3 then k + 1 when k % 5 = 3 then k + 5000001 else cast(-1 as bigint) end as member_key,
  case when k % 7 = 0 then ' ' else upper(fn) end as first_name, ln || 'son' as last_name, case when k % 9 = 0 then null else upper(addr1) end as address_line_1,
  'Floor ' || cast(k % 9 as string) as address_line_2, cty as city, st as state, zip as zip_code, cast(null as string) as zip4,
  case k % 4 when 0 then '' when 1 then 'FEMALE' else null end as gender, cast(k % 12 as int) as source_key, cast(k % 5 as bigint) as record_info_key,
  cast(7 as int) as match_key, '20010801' as batch_id, case k % 2 when 0 then 'Yes' else 'NO' end as is_plcc, case k % 5 when 0 then 'YES' else 'no' end as is_credit_card,
  date '2001-07-01' + cast(k % 30 as int) as transaction_date_iso
from {w_person}
union all
select 'F' || lpad(cast(k as string), 9, '0') || '-20010721' as etl_unique_id, true as match_status, k + 1 as member_key, 'Again' as first_name, 'Later' as last_name,
  'Elsewhere' as address_line_1, null as address_line_2, cty as city, st as state, '99999' as zip_code, null as zip4, 'MALE' as gender, cast(3 as int) as source_key,
  cast(1 as bigint) as record_info_key, cast(7 as int) as match_key, '20010801' as batch_id, 'NO' as is_plcc, 'NO' as is_credit_card, date '2001-07-02' as transaction_date_iso
from {w_person} where k % 10 = 0
"""
VIEWS["w_sources"] = """
select distinct cast(p_size % 12 as bigint) as source_key, cast(p_size % 12 % 6 as int) as source_overlay_rank from {part} where p_size % 12 <> 5
"""
INLINE.add("w_sources")


@query("column_mapping", "etl_unique_id string, address1 string, address2 string, gender string, current_source_key int, match_type_key int", """
  select etl_unique_id, address_line_1 as address1, address_line_2 as address2, nullif(gender, '') as gender, source_key as current_source_key,
    match_key as match_type_key from w_cm_rows""")
def column_mapping(w):
    return tf.column_mapping(w.cm_rows, "till")


# every feed column takes its value from the row number and its place in the feed
MAP_VALUES = ["''", "'1'", "'NULL'", "'Y'", "'0'", "'3'", "'text'", "null"]


def _feed_value(i: int) -> str:
    arms = " ".join(f"when {k} then {v}" for k, v in enumerate(MAP_VALUES))
    return f"case (cast(substr(etl_unique_id, 2, 9) as int) + {i}) % {len(MAP_VALUES)} {arms} end"


def _feed_check(feed: str) -> str:
    """Renamed columns and derived ones, as rows (feed, name, value), from the maps as data."""
    names = FEED_MAPPINGS[feed] | ({"gender": "gender"} if feed in ("till", "rental_experian") else {})
    inner = ", ".join(f"{_feed_value(i)} as {new}" for i, new in enumerate(names.values()))
    made = FEED_DERIVED.get(feed, {})
    outer = ", ".join(f"{made.get(n, n)} as {n}" for n in [*names.values(), *[n for n in made if n not in names.values()]])
    cols = [*names.values(), *[n for n in made if n not in names.values()]]
    texts = ", ".join(f"'{n}'" for n in cols)
    return f"select '{feed}' as feed, unnest([{texts}]) as name, unnest([{', '.join(cols)}]) as value from (select {outer} from (select {inner} from w_cm_rows) a) b"


@query("feed_mappings", "feed string, name string, filled bigint, kinds bigint, least string, most string", f"""
  select feed, name, count(value) as filled, count(distinct value) as kinds, min(value) as least, max(value) as most
  from ({" union all ".join(_feed_check(f) for f in FEED_MAPPINGS)}) x group by feed, name""")
def feed_mappings(w):
    """All sixteen feeds through their maps, a line for each member column."""
    out = []
    for feed, names in FEED_MAPPINGS.items():
        given = [*names, *(["gender"] if feed in ("till", "rental_experian") else [])]
        rows = w.cm_rows.select(*[F.expr(_feed_value(i)).cast("string").alias(c) for i, c in enumerate(given)])
        mapped = tf.column_mapping(rows, feed)
        out.append(mapped.select(F.lit(feed).alias("feed"), F.explode(F.array(*[
            F.struct(F.lit(c).alias("name"), F.col(c).alias("value")) for c in mapped.columns])).alias("x")).select("feed", "x.*"))
    return (union_all(out).groupBy("feed", "name").agg(F.count("value").alias("filled"), F.countDistinct("value").alias("kinds"),
                                                       F.min("value").alias("least"), F.max("value").alias("most")))


@query("merge_member_info", "member_key bigint, first_name string, address_line_1 string, gender string, source_key int", """
  select member_key, coalesce(arg_min(first_name, (-date_diff('day', date '1900-01-01', transaction_date_iso), etl_unique_id)) filter (where length(first_name) > 0)) as first_name,
    arg_min(address_line_1, (-date_diff('day', date '1900-01-01', transaction_date_iso), etl_unique_id)) filter (where length(address_line_1) > 0) as address_line_1,
    arg_min(gender, (-date_diff('day', date '1900-01-01', transaction_date_iso), etl_unique_id)) filter (where length(gender) > 0) as gender,
    arg_min(source_key, (-date_diff('day', date '1900-01-01', transaction_date_iso), etl_unique_id)) as source_key
  from w_cm_rows where member_key <> -1 group by member_key""")
def merge_member_info(w):
    rows = w.cm_rows.select("member_key", "first_name", "address_line_1", "gender", "source_key", "transaction_date_iso", "etl_unique_id")
    return tf.merge_member_info(rows, "transaction_date_iso", "etl_unique_id")


INSERT = "member_key bigint, first_name string, address1 string, customer_introduction_date date, original_source_key int, tier_key bigint, action_flag string"


@query("member_insert", INSERT, """
  select member_key, first_name, address_line_1 as address1, transaction_date_iso as customer_introduction_date, source_key as original_source_key,
    cast(null as bigint) as tier_key, 'I' as action_flag from w_cm_rows where not match_status and member_key <> -1""")
def member_insert(w):
    target = "member_key bigint, first_name string, address1 string, customer_introduction_date date, original_source_key int, tier_key bigint"
    return tf.member_insert(tf.column_mapping(w.cm_rows, "till"), target, DAY, intro="transaction_date_iso")


CHECK_VIEWS["o_one"] = """
select * from (select *, row_number() over (partition by member_key order by etl_unique_id) as rn from w_cm_rows where match_status) x where rn = 1
"""
UPDATED = "member_key bigint, first_name string, gender string, current_source_key int, action_flag string"


@query("member_update", UPDATED, """
  select t.member_key, case when trim(s.first_name) <> '' then s.first_name else t.first_name end as first_name,
    case when trim(s.gender) <> '' then s.gender else t.gender end as gender, s.source_key as current_source_key, 'U' as action_flag
  from o_one s join w_target t on t.member_key = s.member_key""")
def member_update(w):
    # without sources there is no overlay: names are plain columns here
    rows = tf.column_mapping(w.cm_rows, "till").withColumnRenamed("first_name", "given_name")
    target = w.target.withColumnRenamed("first_name", "given_name")
    out = tf.member_update(rows, target, ["given_name", "gender", "current_source_key"])
    return out.withColumnRenamed("given_name", "first_name")


OVERLAID = ("member_key bigint, first_name string, last_name string, address1 string, address2 string, zip_code string, gender string, overlay_rank_key bigint, "
            "overlay_load_id bigint, overlay_date date")
OVERLAY_SQL = """
with j as (select s.*, t.first_name as t_fn, t.last_name as t_ln, t.address1 as t_a1, t.address2 as t_a2, t.zip_code as t_zip, t.gender as t_gender, t.overlay_rank_key as t_rk,
    t.overlay_load_id as t_load, t.overlay_date as t_date, t.is_plcc as t_plcc, coalesce(x.source_overlay_rank, -1) as s_rank, coalesce(y.source_overlay_rank, -1) as t_rank
  from o_one s join w_target t on t.member_key = s.member_key left join w_sources x on x.source_key = s.source_key left join w_sources y on y.source_key = t.overlay_rank_key),
m as (select *, trim(first_name) <> '' and trim(last_name) <> '' and coalesce(trim(address_line_1), '') <> '' and coalesce(trim(zip_code), '') <> '' and
    ((coalesce(trim(t_fn), '') = '' and coalesce(trim(t_ln), '') = '' and coalesce(trim(t_a1), '') = '' and coalesce(trim(t_zip), '') = '') or t_rank <= -1 or s_rank <= t_rank) and
    ((s_rank = 4 and lower(is_plcc) = 'yes' and coalesce(lower(t_plcc), '') = 'yes') or (s_rank = 4 and lower(is_credit_card) = 'yes' and lower(t_plcc) <> 'yes' and t_plcc is not null)
      or s_rank = 3) as moves from j)
select member_key, case when moves then first_name else t_fn end as first_name, case when moves then last_name else t_ln end as last_name,
  case when moves then address_line_1 else t_a1 end as address1, case when moves then address_line_2 else t_a2 end as address2,
  case when moves then zip_code else t_zip end as zip_code, case when trim(gender) <> '' then gender else t_gender end as gender,
  case when moves then source_key else t_rk end as overlay_rank_key, case when moves then cast(batch_id as bigint) else t_load end as overlay_load_id,
  case when moves and not (coalesce(upper(trim(first_name)) = upper(trim(t_fn)), false) and coalesce(upper(trim(last_name)) = upper(trim(t_ln)), false)
    and coalesce(upper(trim(address_line_1)) = upper(trim(t_a1)), false) and coalesce(substr(zip_code, 1, 5) = substr(t_zip, 1, 5), false)) then date '2001-08-01' else t_date end as overlay_date
from m"""


@query("member_overlay", OVERLAID, OVERLAY_SQL, headline=True)
def member_overlay(w):
    rows = tf.column_mapping(w.cm_rows, "till")
    return tf.member_update(rows, w.target, ["gender", "current_source_key"], w.sources, DAY, till=True)


@query("zip_split", "etl_unique_id string, zip_code string, zip4 string, zip_full string", """
  select etl_unique_id, substr(zip_code, 1, 5) as zip_code, case when length(zip_code) > 5 then substr(zip_code, 6) end as zip4,
    case when length(zip_code) > 5 then substr(zip_code, 1, 5) || '-' || substr(zip_code, 6) else zip_code end as zip_full from w_cm_rows""")
def zip_split(w):
    return tf.zip_split(w.cm_rows)


# ---------------------------------------------------------------- hygiene

VIEWS["w_hygiene"] = """
select '' || cast(k + 1 as string) || ',' || cast(k + 2 as string) as member_key, case when k % 6 = 0 then 'A' else null end as prison_suppress_flag,
  case when k % 7 = 0 then 'I' else 'x' end as deceased_suppress_flag, substr('FPXIBU', 1 + cast(k % 6 as int), 1) as ncoa_indicator, '2001-05-01' as ncoa_move_date,
  substr('MBSAUZ', 1 + cast(k % 6 as int), 1) as dwelling_code, cast(k % 10 as int) as deliverability_score, substr('YSND ', 1 + cast(k % 5 as int), 1) as dsf2_verified,
  case when k % 11 = 0 then 'U' else null end as deliverability_indicator, case when k % 4 < 2 then ' f' else null end as pander_suppress_flag,
  'H' || lpad(cast(k as string), 9, '0') as etl_unique_id
from {w_base} where k % 2 = 0
"""
INLINE.add("w_hygiene")
CHECK_VIEWS["o_hyg"] = """
select m as member_key, etl_unique_id, case when prison_suppress_flag = 'A' then 'YES' end as prison, case when deceased_suppress_flag = 'I' then 'YES' end as dead,
  case when ncoa_indicator in ('F', 'P', 'I', 'B', 'U') then ncoa_move_date end as moved,
  case dwelling_code when 'M' then 'Multi_No_Apartment' when 'B' then 'BUSINESS' when 'S' then 'SINGLE' when 'A' then 'MULTI_WITH_APARTMENT' when 'U' then 'UNKNOWN' end as dwelling,
  case when deliverability_score in (1, 2, 3, 4) or dsf2_verified = 'Y' then 'YES' when deliverability_score in (0, 5, 6, 7, 8) or deliverability_indicator = 'U' or dsf2_verified in ('N', 'D') then 'NO' end as strict,
  case when deliverability_score in (1, 2, 3, 4, 5, 6) or dsf2_verified = 'S' then 'YES' when deliverability_score in (0, 7, 8) or deliverability_indicator = 'U' or dsf2_verified in ('N', 'D') then 'NO' end as loose,
  coalesce(pander_suppress_flag = ' f', false) and coalesce((select upper(trim(record_type)) = 'PROSPECT' from w_target t where t.member_key = h.m), false) as wipe
from (select *, cast(unnest(string_split(member_key, ',')) as bigint) as m from w_hygiene) h
"""
HYGIENE = "member_key bigint, first_name string, deceased string, dwelling_type string, valid_strict string, valid_loose string, ncoa_last_change_date string, current_source_key int, tier_key bigint, gender string"


@query("transform_comprehensive_hygiene", HYGIENE, """
  with one as (select * from (select *, row_number() over (partition by member_key order by etl_unique_id) as rn from o_hyg where not wipe) x where rn = 1)
  select t.member_key, first_name, coalesce(dead, deceased) as deceased, coalesce(dwelling, dwelling_type) as dwelling_type, coalesce(strict, valid_strict) as valid_strict,
    coalesce(loose, valid_loose) as valid_loose, coalesce(moved, ncoa_last_change_date) as ncoa_last_change_date, 2229 as current_source_key, tier_key, gender
  from one join w_target t on t.member_key = one.member_key
  union all select member_key, null, 'UNKNOWN', null, null, null, null, 776, -1, 'UNKNOWN' from w_target where member_key in (select member_key from o_hyg where wipe)""")
def transform_comprehensive_hygiene(w):
    cols = ["deceased", "address_is_prison", "dwelling_type", "valid_strict", "valid_loose", "ncoa_last_change_date", "current_source_key"]
    return tf.comprehensive_hygiene(w.hygiene, w.target, cols)


VIEWS["w_ehyg_result"] = """
select email_address as email, case min(member_key) % 3 when 0 then ' Valid' when 1 then 'invalid' else 'odd' end as category,
  case when min(member_key) % 5 = 0 then 'fixed' || cast(min(member_key) as string) || '@mail.example'
       when min(member_key) % 5 = 1 then 'alt' || cast(cast(floor((min(member_key) - 1) / 2) as bigint) as string) || '@mail.example' else ' ' end as correction
from {w_multi_email} group by email_address
"""
INLINE.add("w_ehyg_result")


@query("transform_email_hygiene", "member_key bigint, email_address string, valid_email string, is_loyalty_email string, action_flag string, source_key int", """
  with r as (select distinct lower(trim(email)) as e, case lower(trim(category)) when 'valid' then 'YES' when 'invalid' then 'NO' end as v, nullif(lower(trim(correction)), '') as fix from w_ehyg_result),
  h as (select r.*, m.* from r join w_multi_email m on r.e = lower(trim(m.email_address))),
  f as (select h.member_key, h.fix, k.email_address as own from h left join w_multi_email k on k.member_key = h.member_key and lower(trim(k.email_address)) = h.fix where h.fix is not null)
  select member_key, fix as email_address, 'YES' as valid_email, 'NO' as is_loyalty_email, 'I' as action_flag, 2228 as source_key from f where own is null
  union all select member_key, email_address, v, is_loyalty_email, 'U', 2228 from h
  union all select m.member_key, m.email_address, 'YES', m.is_loyalty_email, 'U', 2228 from w_multi_email m join (select distinct member_key, own from f where own is not null) g
    on g.member_key = m.member_key and g.own = m.email_address""")
def transform_email_hygiene(w):
    return tf.email_hygiene(w.ehyg_result, w.multi_email)


VIEWS["w_append"] = """
select cast(k + 1 as string) || ',' || cast(k + 4 as string) as member_key, case when k % 6 = 0 then 'NULL' else ln end as last_name, addr1 as address1, zip as zip_code,
  case when k % 2 = 0 then '2125550000' else cast(2125550000 + h * 13 as string) end as phone, mail as email
from {w_person} where k % 3 <> 2
"""
INLINE.add("w_append")


def append_query(name: str, value: str, contacts, flag_sql: str, join_sql: str, source: int, build):
    @query(name, "member_key bigint, address1 string, last_name string, current_source_key int", f"""
      with e as (select cast(unnest(string_split(member_key, ',')) as bigint) as m, last_name, address1, zip_code, {value} as v from w_append
          where last_name <> 'NULL' and trim(last_name) <> '' and address1 <> 'NULL' and zip_code <> 'NULL'),
      b as (select * from (select e.*, row_number() over (partition by m order by {flag_sql}, v, address1, zip_code) as rn from e left join {join_sql}) x where rn = 1)
      select t.member_key, t.address1, t.last_name, {source} as current_source_key from b join w_target t on t.member_key = b.m where t.last_name_scrubbed is null""")
    def run(w):
        return build(w)


append_query("transform_reverse_append", "phone", None, "case when c.is_loyalty_flag = 'YES' then 0 when c.phone_consent = 'YES' then 1 else 2 end",
             "w_multi_phone c on c.member_key = e.m and cast(c.phone_number as varchar) = e.v", 1064,
             lambda w: tf.reverse_append(w.append, w.multi_phone.select("member_key", F.col("phone_number").cast("string").alias("phone_number"), "is_loyalty_flag", "phone_consent"),
                                         w.target, "phone", "phone_number", [F.col("is_loyalty_flag") == "YES", F.col("phone_consent") == "YES"], ["current_source_key"], 1064))
append_query("transform_reverse_append_email", "email", None,
             "case when c.is_loyalty_email = 'YES' then 0 when c.email_consent = 'YES' then 1 when c.best_email_flag = 'YES' then 2 else 3 end",
             "(select member_key, lower(trim(email_address)) as a, max(is_loyalty_email) as is_loyalty_email, max(email_consent) as email_consent, max(best_email_flag) as best_email_flag "
             "from w_multi_email group by 1, 2) c on c.member_key = e.m and c.a = e.v", 1235,
             lambda w: tf.reverse_append(
                 w.append, w.multi_email.groupBy("member_key", F.lower(F.trim("email_address")).alias("email_address")).agg(
                     F.max("is_loyalty_email").alias("is_loyalty_email"), F.max("email_consent").alias("email_consent"), F.max("best_email_flag").alias("best_email_flag")),
                 w.target, "email", "email_address",
                 [F.col("is_loyalty_email") == "YES", F.col("email_consent") == "YES", F.col("best_email_flag") == "YES"], ["current_source_key"], 1235))


# ---------------------------------------------------------------- consent

VIEWS["w_consent_feed"] = """
select k + 1 as member_key, case k % 4 when 0 then ' x' when 1 then 'Y' else null end as do_not_direct_mail, cast(k % 3 as int) as a_directmailoptin, cast(k % 3 as int) as a_emailoptin,
  cast(k % 6 as int) as memberstatus, case k % 5 when 0 then 'y ' when 1 then 'N' when 2 then 'U' else null end as optinflag,
  case when k % 7 = 0 then null else date '2001-06-01' + cast(k % 50 as int) end as optdate, case k % 4 when 0 then 'Y' when 1 then 'n' else '' end as email_opt_in_indicator,
  date '2001-07-15' as transaction_date_iso, date '2001-07-20' as last_modified_date, cast(k % 3 as int) as consent_value_retail, cast(k % 4 as int) as consent_value_outlet,
  case when k % 2 = 0 then 'YES' else 'NO' end as is_loyalty_member, case when k % 9 = 0 then null else mail end as email_address, cast(k % 8 as int) as source_key, cast(k as string) as etl_unique_id
from {w_person}
"""
VIEWS["w_brand_consent"] = """
select member_key, lower(trim(email_address)) as email_address, case min(member_key) % 4 when 0 then 'YES' when 1 then 'NO' else null end as consent_value_retail,
  case member_key % 3 when 0 then 'YES' when 1 then '' else null end as consent_value_outlet, case member_key % 5 when 0 then 'NO' else null end as consent_value_next,
  case member_key % 4 when 0 then 'YES' when 1 then 'NO' else null end as email_consent, date '2000-01-01' + cast(member_key % 300 as int) as consent_date_retail,
  date '2000-02-01' + cast(member_key % 300 as int) as consent_date_outlet, date '2000-03-01' as consent_date_next, date '2000-04-01' + cast(member_key % 200 as int) as email_consent_date,
  case when member_key % 3 = 0 then date '1999-09-09' else null end as first_pos_consent_date, 'YES' as valid_email, min(is_loyalty_email) as is_loyalty_email
from {w_multi_email} group by member_key, lower(trim(email_address))
"""
CHECK_VIEWS["o_dm"] = """
select member_key, consent_value as v, consent_date as d from (select *, row_number() over (partition by member_key order by consent_date desc, consent_history_id desc) as rn
  from w_consent where consent_type = 'DM') x where rn = 1
"""
DM_CASES = {
    "till": "v", "employee": "v", "card_statement": "case when upper(trim(do_not_direct_mail)) = 'X' then 'NO' else v end",
    "loyalty": "case when a_directmailoptin = 1 and memberstatus in (1, 3, 4) then 'YES' when a_directmailoptin = 0 and memberstatus in (1, 3, 4) then 'NO' else v end",
    "preference_center": "case upper(trim(optinflag)) when 'Y' then 'YES' when 'N' then 'NO' when 'U' then 'UNKNOWN' else v end"}
DM_EVENT = {"till": "transaction_date_iso", "preference_center": "coalesce(optdate, date '2001-08-01')"}
DM_SQL = " union all ".join(
    f"select '{f}' as feed, member_key, nv as consent_value, case when coalesce(nv, '') = coalesce(v, '') then d else {DM_EVENT.get(f, 'date ' + chr(39) + DAY + chr(39))} end as consent_date "
    f"from (select c.*, o.v, o.d, {case} as nv from w_consent_feed c left join o_dm o on o.member_key = c.member_key) x" for f, case in DM_CASES.items())


@query("consent_rules_dm", "feed string, member_key bigint, consent_value string, consent_date date", DM_SQL)
def consent_rules_dm(w):
    return union_all([cs.dm_consent(w.consent_feed, w.consent, f, DAY).select(F.lit(f).alias("feed"), "member_key", "consent_value", "consent_date") for f in DM_CASES])


@query("consent_update", "member_key bigint, consent_value string, consent_date date",
       "select member_key, consent_value, consent_date from (" + DM_SQL + ") y where feed = 'preference_center'")
def consent_update(w):
    return cs.dm_consent(w.consent_feed, w.consent, "preference_center", DAY)


def _email_case(rule: str, cur: str) -> str:
    return rule.replace("{cur}", cur)


# the e-mail rules restated for the checking engine
CHECK_CARD = "case upper(trim(email_opt_in_indicator)) when 'Y' then coalesce({c}, 'YES') when 'N' then 'NO' else {c} end"
CHECK_LOYAL = "case when memberstatus in (1, 3, 4) and a_emailoptin = 1 then 'YES' when memberstatus in (1, 3, 4) and a_emailoptin = 0 then 'NO' else {c} end"
CHECK_PREF = "case upper(trim(optinflag)) when 'Y' then 'YES' when 'N' then 'NO' else {c} end"
CHECK_NEXT = "case when is_loyalty_member = 'YES' then case upper(trim(optinflag)) when 'Y' then 'YES' when 'N' then 'NO' else {c} end else {c} end"
EMAIL_CASES = {
    "employee": ("{c}",) * 4, "card_account": (CHECK_CARD, "{c}", "{c}", CHECK_CARD),
    "till": ("case when email_address is not null then 'YES' else {c} end", "{c}", "{c}", "case when email_address is not null then 'YES' else {c} end"),
    "email_update": ("case consent_value_retail when 1 then 'YES' when 0 then 'NO' else {c} end", "case consent_value_outlet when 1 then 'YES' when 0 then 'NO' else {c} end", "{c}",
                     "case when consent_value_retail = 1 or consent_value_outlet = 1 then 'YES' when consent_value_retail = 0 and consent_value_outlet = 0 then 'NO' else {c} end"),
    "preference_center": (CHECK_PREF, "{c}", CHECK_NEXT, CHECK_PREF), "loyalty": (CHECK_LOYAL, "{c}", CHECK_LOYAL, CHECK_LOYAL)}
EMAIL_EVENT = {"till": "transaction_date_iso", "email_update": "last_modified_date", "preference_center": "coalesce(optdate, date '2001-08-01')"}


def email_sql(feed: str) -> str:
    event = EMAIL_EVENT.get(feed, f"date '{DAY}'")
    r, o, n, e = (c.replace("{c}", f"b_{x}") for c, x in zip(EMAIL_CASES[feed], ("retail", "outlet", "next", "consent")))
    moved = lambda new, x: f"case when coalesce({new}, '') = coalesce(b_{x}, '') then d_{x} else {event} end"
    first = "first_pos" if feed == "employee" else """case when first_pos is null then case when v_o = 'YES' and v_r = 'YES' then least(d_r, d_o)
      when v_o = 'YES' and coalesce(v_r, '') in ('NO', '') then d_o when v_r = 'YES' and coalesce(v_o, '') in ('NO', '') then d_r end else first_pos end"""
    return f"""select '{feed}' as feed, member_key, v_r as consent_value_retail, d_r as consent_date_retail, v_o as consent_value_outlet, v_n as consent_value_next, v_e as email_consent,
      d_e as email_consent_date, {first} as first_pos_consent_date from (
      select member_key, {r} as v_r, {moved(r, 'retail')} as d_r, {o} as v_o, {moved(o, 'outlet')} as d_o, {n} as v_n, {e} as v_e, {moved(e, 'consent')} as d_e, first_pos from (
        select f.*, b.consent_value_retail as b_retail, b.consent_value_outlet as b_outlet, b.consent_value_next as b_next, b.email_consent as b_consent, b.consent_date_retail as d_retail,
          b.consent_date_outlet as d_outlet, b.email_consent_date as d_consent, b.first_pos_consent_date as first_pos
        from w_consent_feed f left join w_brand_consent b on b.member_key = f.member_key and b.email_address = lower(trim(f.email_address))
        where trim(f.email_address) <> '') x) y"""


EMAIL_SCHEMA = ("feed string, member_key bigint, consent_value_retail string, consent_date_retail date, consent_value_outlet string, consent_value_next string, "
                "email_consent string, email_consent_date date, first_pos_consent_date date")


@query("consent_rules_email", EMAIL_SCHEMA, " union all ".join(email_sql(f) for f in EMAIL_CASES))
def consent_rules_email(w):
    cols = [c.split(" ")[0] for c in EMAIL_SCHEMA.split(", ")]
    return union_all([tf.multi_email(w.consent_feed, w.brand_consent, f, DAY, [F.col("etl_unique_id")]).withColumn("feed", F.lit(f)).select(*cols)
                      for f in EMAIL_CASES])


@query("transform_multi_email", EMAIL_SCHEMA + ", valid_email string, is_loyalty_email string",
       "select x.*, case when f.source_key = 6 then 'YES' else b.valid_email end as valid_email, coalesce(b.is_loyalty_email, 'NO') as is_loyalty_email from ("
       + email_sql("till") + ") x join w_consent_feed f on f.member_key = x.member_key "
       "left join w_brand_consent b on b.member_key = f.member_key and b.email_address = lower(trim(f.email_address))")
def transform_multi_email(w):
    return tf.multi_email(w.consent_feed, w.brand_consent, "till", DAY, [F.col("etl_unique_id")]).withColumn("feed", F.lit("till"))


VIEWS["w_phone_feed"] = """
select k + 1 as member_key, ' ' || ph as home_phone, case when k % 3 = 0 then 'UNKNOWN' when k % 3 = 1 then null else cast(3305550000 + k as string) end as work_phone,
  case when k % 4 = 0 then ph else cast(6145550000 + cast(floor(k / 4) as bigint) as string) end as mobile_phone, cast(case when k % 5 = 0 then 2226 else 9 end as int) as source_key,
  case when k % 2 = 0 then 'i' else 'O' end as opt_in, cast(k as string) as etl_unique_id
from {w_person}
"""
CHECK_VIEWS["o_stack"] = """
select * from (select *, row_number() over (partition by member_key, ph order by etl_unique_id, kind) as rn from (
  select member_key, trim(home_phone) as ph, 'HOME' as kind, source_key, opt_in, etl_unique_id from w_phone_feed
  union all select member_key, trim(work_phone), 'WORK', source_key, opt_in, etl_unique_id from w_phone_feed
  union all select member_key, trim(mobile_phone), 'MOBILE', source_key, opt_in, etl_unique_id from w_phone_feed) x where ph <> '' and ph <> 'UNKNOWN') y where rn = 1
"""
PHONE_SQL = """select s.member_key, ph as phone_number, case when source_key = 2226 then 'MOBILE' else kind end as phone_type,
    case when source_key = 2226 then case when upper(opt_in) = 'I' then 'YES' else 'NO' end else c.phone_consent end as phone_consent,
    case when source_key = 2226 then date '2001-08-01' else c.consent_date end as phone_consent_date, case when source_key = 2226 then 'YES' else 'NO' end as valid_phone,
    coalesce(c.is_loyalty_flag, 'NO') as is_loyalty_flag
  from o_stack s left join w_multi_phone c on c.member_key = s.member_key and cast(c.phone_number as varchar) = s.ph"""
PHONE_SCHEMA = "member_key bigint, phone_number string, phone_type string, phone_consent string, phone_consent_date date, valid_phone string, is_loyalty_flag string"


def _phones(w):
    kinds = {"home_phone": "HOME", "work_phone": "WORK", "mobile_phone": "MOBILE"}
    return tf.multi_phone(w.phone_feed, w.multi_phone, kinds, DAY, [F.col("etl_unique_id")])


@query("transform_multi_phone", PHONE_SCHEMA, PHONE_SQL)
def transform_multi_phone(w):
    return _phones(w)


@query("consent_rules_phone", "source_key int, phone_type string, phone_consent string, rows bigint",
       "select s.source_key, phone_type, p.phone_consent, count(*) as rows from (" + PHONE_SQL + ") p join (select member_key, source_key from w_phone_feed) s "
       "on s.member_key = p.member_key group by 1, 2, 3")
def consent_rules_phone(w):
    return _phones(w).groupBy("source_key", "phone_type", "phone_consent").agg(F.count(F.lit(1)).alias("rows"))


VIEWS["w_dm_target"] = """
select member_key, consent_date, consent_type, consent_value, case when member_key % 2 = 0 then 'YES' else 'NO' end as is_loyalty, cast(300 as int) as source_key
from {w_consent} where consent_type = 'DM' and member_key % 6 <> 1
"""
INLINE.add("w_dm_target")


@query("transform_consent", "member_key bigint, consent_date date, consent_value string, is_loyalty string, source_key int, action_cd string", """
  with s as (select member_key, consent_value, consent_date, 'YES' as is_loyalty, 1527 as source_key from (""" + DM_SQL + """) z where feed = 'preference_center'),
  j as (select s.*, t.member_key as tk, t.consent_value as tv, t.consent_date as td, t.is_loyalty as tl, t.source_key as tsk from s left join w_dm_target t on t.member_key = s.member_key)
  select member_key, case when tk is null or lower(trim(consent_value)) <> lower(trim(tv)) then coalesce(consent_date, td) else td end as consent_date,
    case when tk is null or coalesce(trim(consent_value), '') <> '' then consent_value else tv end as consent_value, is_loyalty, source_key, case when tk is null then 'I' else 'U' end as action_cd
  from j where tk is null or consent_date is distinct from td or source_key is distinct from tsk or lower(trim(consent_value)) is distinct from lower(trim(tv)) or is_loyalty is distinct from tl""")
def transform_consent(w):
    rows = cs.dm_consent(w.consent_feed, w.consent, "preference_center", DAY).withColumns({"is_loyalty": F.lit("YES"), "source_key": F.lit(1527)})
    return cs.consent_changes(rows, w.dm_target, [])[1]


# ---------------------------------------------------------------- household

VIEWS["w_hh_member"] = """
select member_key, household_key, first_name, last_name, address1, address2, city, state, zip_code,
  case when member_key % 3 = 0 then upper(last_name) when member_key % 3 = 1 then 'null' else null end as last_name_scrubbed, cast(null as string) as address1_scrubbed,
  cast(null as string) as address2_scrubbed, case when member_key % 2 = 0 then '' else null end as city_scrubbed, upper(state) as state_scrubbed, cast(null as string) as zip_code_scrubbed,
  case when member_key % 5 = 0 then null else date '2000-01-01' + cast((member_key * 7) % 400 as int) end as overlay_date,
  case member_key % 6 when 0 then 'single' when 1 then 'BUSINESS' when 2 then 'Multi_No_Apartment' else 'UNKNOWN' end as dwelling_type, first_trxn_date,
  case member_key % 3 when 0 then 'YES' else 'NO' end as is_plcc, customer_introduction_date, last_store_purchase_date as last_store_purch_date,
  last_web_purchase_date as last_web_purch_date, enrollment_date as member_acct_open_date, case when member_key % 4 < 2 then 'YES' else 'NO' end as best_household_member,
  case member_key % 3 when 0 then 'YES' when 1 then 'NO' else null end as valid_loose, case member_key % 4 when 0 then 'YES' else 'NO' end as valid_strict, last_updated_date
from {w_member}
"""
INLINE.add("w_hh_member")
CHECK_VIEWS["o_hhrow"] = """
select * from (select *, case when upper(trim(last_name_scrubbed)) not in ('', 'NULL') then upper(trim(last_name_scrubbed)) else coalesce(upper(trim(last_name)), '') end as h_ln,
  coalesce(upper(trim(address1)), '') as h_a1, coalesce(upper(trim(address2)), '') as h_a2, upper(trim(city)) as h_city, upper(state) as h_st, lpad(substr(zip_code, 1, 5), 5, '0') as h_zip,
  case when household_key = -1 and overlay_date is null then date '2001-08-01' else coalesce(overlay_date, date '1900-01-01') end as h_od from w_hh_member) x
where h_ln <> '' and h_a1 <> '' and h_city <> '' and h_st <> '' and h_zip <> '' and upper(dwelling_type) in ('MULTI_NO_APARTMENT', 'MULTI_WITH_APARTMENT', 'UNKNOWN', 'SINGLE')
"""
CHECK_VIEWS["o_hhgrp"] = """
select h_ln, h_a1, h_a2, h_city, h_st, h_zip, arg_min(household_key, (h_od, household_key)) as old_key, count(*) as member_count, min(member_key) as first_member_key,
  min(first_trxn_date) as first_trxn_date, case when count(*) filter (where is_plcc = 'YES') > 0 then 'YES' else 'NO' end as is_plcc, min(customer_introduction_date) as introduction_date,
  min(h_od) as od from o_hhrow group by all
"""
CHECK_VIEWS["o_hhkey"] = """
select g.*, case when keeps then old_key else (select max(household_key) from w_household) + row_number() over (partition by keeps order by first_member_key) end as household_key
from (select *, old_key > 0 and row_number() over (partition by old_key order by od, first_member_key) = 1 as keeps from o_hhgrp) g
"""


def _house(w):
    return tf.transform_household(stage(w.hh_member), w.household, w.date, DAY)


@query("transform_household", "household_key bigint, member_count bigint, first_member_key bigint, zip_code string, is_plcc string, introduction_date date, "
       "first_trxn_date_key bigint, address_validity string, valid_address string", """
  select k.household_key, member_count, first_member_key, h_zip as zip_code, k.is_plcc, introduction_date, coalesce(d.date_key, -1) as first_trxn_date_key,
    case when b.valid_strict = 'YES' then 'STRICT' when b.valid_loose = 'YES' and b.valid_strict = 'NO' then 'LOOSE' when b.valid_loose = 'NO' and b.valid_strict = 'NO' then 'INVALID'
      else 'INVALID' end as address_validity, h_a1 || h_a2 as valid_address
  from o_hhkey k left join w_date d on d.sdate = k.first_trxn_date
  left join (select * from (select household_key, valid_loose, valid_strict, row_number() over (partition by household_key order by last_updated_date desc, member_key) as rn
    from w_hh_member where best_household_member = 'YES') x where rn = 1) b on b.household_key = k.household_key""", headline=True)
def transform_household(w):
    return _house(w)[0]


@query("transform_household_members", "household_key bigint, member_key bigint", """
  select k.household_key, r.member_key from o_hhrow r join o_hhkey k on k.h_ln = r.h_ln and k.h_a1 = r.h_a1 and k.h_a2 = r.h_a2 and k.h_city = r.h_city and k.h_st = r.h_st and k.h_zip = r.h_zip""")
def transform_household_members(w):
    return _house(w)[1]
