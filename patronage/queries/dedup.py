"""Queries of deduplication, golden record and re-keying."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.rewrite import read_by_key, store_by_key
from ..operators.staging import stage, staging_folder
from ..plans import dedup as dd, fuzzy, golden as gd
from ..registry import CHECK_VIEWS, query

DAY = "2001-08-01"


def contacts(w):
    return w.staged("dup_contacts", lambda w: dd.contact_values(w.dup_card, w.dup_email, w.dup_phone), balanced=True)


def inputs(w):
    return dd.identify_groups(dd.dedup_inputs(w.dup_member, w.view("w_trxn_head"), contacts(w)))


def members_of(w):
    return w.staged("dup_members", inputs, balanced=True)


def grouped_rows(w):
    """Members with their groups, the rule in front of the group id (an earlier job's result)."""
    def build(w):
        members = members_of(w)
        groups = dd.group_rows(members, contacts(w)).withColumn(
            "grouping_id", F.concat(F.col("grouping_criteria_id").cast("string"), F.lit(":"), "grouping_id"))
        return groups.drop("grouping_criteria_id").join(members, "member_key")
    return w.staged("dup_rows", build, balanced=True)


def field(name, schema, expr, check_cols, group_filter="is_resolved"):
    """Register one field rule of the golden record over the eligible members."""
    @query(name, "grouping_id string, " + schema,
           f"select grouping_id, {check_cols} from o_part group by grouping_id")
    def run(w):
        rows = grouped_rows(w)
        part = gd.eligible(rows, gd.collections(rows)).filter(group_filter)
        out = part.groupBy("grouping_id").agg(expr(part).alias("v"))
        if out.schema["v"].dataType.typeName() == "struct":
            return out.select("grouping_id", "v.*")
        return out.withColumnRenamed("v", schema.split(" ")[0])


# ---------------------------------------------------------------- checking views

CHECK_VIEWS["o_contact"] = """
select distinct member_key, 'card' as kind, regexp_replace(tokenized_cc_nbr, '^0+', '') as value from w_dup_card
union all select distinct member_key, 'email', trim(email_address) from w_dup_email
union all select distinct member_key, 'phone', cast(phone_number as varchar) from w_dup_phone
  where cast(phone_number as varchar) not in ('8888888888', '9999999999', '5555555555', '1111111111', '7777777777', '2222222222')
"""
CHECK_VIEWS["o_dup"] = """
select m.*, t.trxn_date, coalesce(n_cards, 0) as n_cards, coalesce(n_emails, 0) as n_emails, coalesce(n_phones, 0) as n_phones,
  case when coalesce(nullif(trim(first_name), ''), 'UNKNOWN') <> 'UNKNOWN' and coalesce(nullif(trim(last_name), ''), 'UNKNOWN') <> 'UNKNOWN'
    and coalesce(nullif(trim(address1_scrubbed), ''), 'UNKNOWN') <> 'UNKNOWN'
    and coalesce(nullif(trim(zip_code_scrubbed), ''), 'UNKNOWN') <> 'UNKNOWN' then 1
  when coalesce(nullif(trim(first_name), ''), 'UNKNOWN') = 'UNKNOWN' and coalesce(nullif(trim(last_name), ''), 'UNKNOWN') = 'UNKNOWN'
    and coalesce(nullif(trim(address1_scrubbed), ''), 'UNKNOWN') = 'UNKNOWN'
    and coalesce(nullif(trim(zip_code_scrubbed), ''), 'UNKNOWN') = 'UNKNOWN' then
    case when coalesce(n_phones, 0) = 0 and coalesce(n_emails, 0) = 0 and n_cards > 0 then 3
      when coalesce(n_cards, 0) = 0 and coalesce(n_phones, 0) = 0 and n_emails > 0 then 5
      when coalesce(n_cards, 0) = 0 and coalesce(n_emails, 0) = 0 and n_phones > 0 then 4
      when coalesce(nullif(trim(address2_scrubbed), ''), 'UNKNOWN') = 'UNKNOWN' and coalesce(n_cards, 0) = 0
        and n_emails > 0 and n_phones > 0 then 7 else 0 end
  else 0 end as rule
from w_dup_member m
left join (select member_key, max(trxn_date) as trxn_date from w_trxn_head group by member_key) t on t.member_key = m.member_key
left join (select member_key, count(*) filter (where kind = 'card') as n_cards, count(*) filter (where kind = 'email') as n_emails,
  count(*) filter (where kind = 'phone') as n_phones from o_contact group by member_key) c on c.member_key = m.member_key
"""
CHECK_VIEWS["o_groups"] = """
select distinct rule, member_key, gid from (
  select rule, member_key, concat_ws('~', upper(first_name), upper(last_name), upper(address1_scrubbed),
    upper(address2_scrubbed), upper(zip_code_scrubbed)) as gid from o_dup where rule = 1
  union all select rule, d.member_key, c.value from o_dup d join o_contact c on c.member_key = d.member_key
    and c.kind = case rule when 3 then 'card' when 5 then 'email' when 4 then 'phone' end
  union all select rule, d.member_key, e.value || '~' || p.value from o_dup d
    join o_contact e on e.member_key = d.member_key and e.kind = 'email'
    join o_contact p on p.member_key = d.member_key and p.kind = 'phone' where rule = 7) x
"""
CHECK_VIEWS["o_sets"] = """
select rule, gid, string_agg(member_key, ':' order by member_key) as members from o_groups group by rule, gid
"""
CHECK_VIEWS["o_kept"] = """
select rule, member_key, gid, sets, max(sets) over (partition by rule, gid) as most from (
  select rule, member_key, gid, count(*) over (partition by rule, member_key) as sets from (
    select g.rule, g.member_key, min(g.gid) as gid from o_groups g join o_sets s on s.rule = g.rule and s.gid = g.gid
    group by g.rule, g.member_key, s.members) a) b
"""
CHECK_VIEWS["o_coll"] = """
select rule, gid, n, coll, case coll when 1 then oldest when 3 then loyal_key when 4 then coalesce(active, -1) else -1 end as best
from (select *, case when n = 1 then -1 when loyal = 0 then 1 when loyal = 1 then 3 when loyal = n then 2 else 4 end as coll
  from (select g.rule, gid, count(*) as n, count(*) filter (where is_loyalty_member = 'YES') as loyal,
    arg_min(d.member_key, (coalesce(customer_introduction_date, date '9999-01-01'), d.member_key)) as oldest,
    min(case when is_loyalty_member = 'YES' then d.member_key end) as loyal_key,
    arg_min(d.member_key, (-date_diff('day', date '1900-01-01', coalesce(trxn_date, date '1900-01-01')),
      coalesce(member_acct_enroll_date, date '9999-01-01'), d.member_key)) filter (where member_status = 'ACTIVE') as active
    from o_groups g join o_dup d on d.member_key = g.member_key group by g.rule, gid) a) b
"""
CHECK_VIEWS["o_grows"] = """
select g.rule || ':' || g.gid as grouping_id, c.n, c.coll, c.best, d.* from o_groups g
join o_coll c on c.rule = g.rule and c.gid = g.gid join o_dup d on d.member_key = g.member_key
"""
CHECK_VIEWS["o_part"] = """
select * from o_grows where coll not in (-1, 2) and best <> -1
  and not (coll = 4 and is_loyalty_member = 'YES' and member_key <> best)
"""


# ---------------------------------------------------------------- grouping

@query("dedup_inputs", "member_key bigint, trxn_date date, n_cards bigint, n_emails bigint, n_phones bigint",
       "select member_key, trxn_date, n_cards, n_emails, n_phones from o_dup")
def dedup_inputs(w):
    return inputs(w)


@query("dedup_identify_groups", "member_key bigint, grouping_criteria_id int",
       "select member_key, rule as grouping_criteria_id from o_dup")
def dedup_identify_groups(w):
    return inputs(w)


MEMBERSHIP = ("member_key bigint, grouping_id string, grouping_criteria_id int, grouped_count bigint, collection_id int, "
              "resolved_member bigint, is_resolved boolean, is_invalid boolean")


def resolve(w):
    """(members, rows of all groups, membership)"""
    members = members_of(w)
    groups = stage(dd.group_rows(members, contacts(w)))
    rows = groups.join(members.drop("grouping_criteria_id"), "member_key")
    return members, rows, dd.resolve_groups(groups, rows)


@query("dedup_resolve_group", MEMBERSHIP, """
  select k.member_key, k.gid as grouping_id, k.rule as grouping_criteria_id, c.n as grouped_count, c.coll as collection_id,
    c.best as resolved_member, c.coll not in (-1, 2) and c.best <> -1 as is_resolved, k.most > 1 as is_invalid
  from o_kept k join o_coll c on c.rule = k.rule and c.gid = k.gid""", headline=True)
def dedup_resolve_group(w):
    return resolve(w)[2]


# ---------------------------------------------------------------- golden record

@query("golden_collection", "grouping_id string, grouped_count bigint, collection_id int",
       "select distinct grouping_id, n as grouped_count, coll as collection_id from o_grows")
def golden_collection(w):
    return gd.collections(grouped_rows(w))


@query("golden_best_member", "grouping_id string, resolved_member bigint, is_resolved boolean",
       "select distinct grouping_id, best as resolved_member, coll not in (-1, 2) and best <> -1 as is_resolved from o_grows")
def golden_best_member(w):
    return gd.collections(grouped_rows(w))


@query("golden_eligible", "grouping_id string, member_key bigint", """
  select grouping_id, member_key from o_grows
  where not (coll = 4 and is_loyalty_member = 'YES' and member_key <> best)""")
def golden_eligible(w):
    rows = grouped_rows(w)
    return gd.eligible(rows, gd.collections(rows))


RANK = "case when source_overlay_rank is null or source_overlay_rank in (-1, 0) then 99 else source_overlay_rank end"
DPV = "case when dpv_key is null or dpv_key = 0 then -1 else dpv_key end"
AGO = "-date_diff('day', date '1900-01-01', last_updated_date)"


def pick(cols: list[str], order: str) -> str:
    """Columns of the first row in an order, null values included."""
    return ", ".join(f"first({c} order by {order}) as {c}" for c in cols)


ADDRESS = ["household_key", "first_name", "last_name", "address1_scrubbed", "address2_scrubbed", "city_scrubbed",
           "state_scrubbed", "zip_code_scrubbed", "dpv_key", "latitude", "longitude"]
field("golden_name_address",
      "household_key bigint, first_name string, last_name string, address1_scrubbed string, address2_scrubbed string, "
      "city_scrubbed string, state_scrubbed string, zip_code_scrubbed string, dpv_key int, latitude double, longitude double",
      gd.name_address, pick(ADDRESS, f"{RANK}, -({DPV}), {AGO}, member_key"))
field("golden_overlay", "overlay_rank_key bigint", gd.overlay, pick(["overlay_rank_key"], f"{RANK}, member_key"))
field("golden_original_source", "original_source_key int, customer_introduction_date date", gd.original_source,
      pick(["original_source_key", "customer_introduction_date"],
           "coalesce(customer_introduction_date, date '9999-01-01'), member_key"))
field("golden_current_source", "current_source_key int, batch_id string, last_updated_date date", gd.current_source,
      pick(["current_source_key", "batch_id", "last_updated_date"], "last_updated_date desc, member_key"))
field("golden_indicators", "open_close_ind string", gd.indicators,
      pick(["open_close_ind"], """case when current_source_key in (8, 9) then 0 else 1 end,
        case when current_source_key in (8, 9) then -ascii(coalesce(open_close_ind, 'O')) else 0 end,
        case when current_source_key in (8, 9) then date_diff('day', date '1900-01-01', last_updated_date)
          else -date_diff('day', date '1900-01-01', last_updated_date) end, member_key"""))
field("golden_gender", "gender string", lambda df: gd.gender(),
      """case when count(*) filter (where gender in ('FEMALE', 'F', 'MALE', 'M')) = 0 then 'UNKNOWN'
        when count(*) filter (where gender in ('FEMALE', 'F')) >= count(*) filter (where gender in ('MALE', 'M'))
        then 'FEMALE' else 'MALE' end as gender""")
field("golden_dm_consent", "direct_mail_consent string, direct_mail_consent_date date", gd.dm_consent,
      pick(["direct_mail_consent", "direct_mail_consent_date"], """direct_mail_consent_date desc nulls last,
        case direct_mail_consent when 'YES' then 0 when 'NO' then 1 else 2 end, member_key"""))
field("golden_flag_any", "deceased string", lambda df: gd.any_flag("deceased"),
      """case when count(*) filter (where deceased = 'YES') > 0 then 'YES'
        when count(*) filter (where deceased = 'NO') > 0 then 'NO' else 'UNKNOWN' end as deceased""")
field("golden_first_trxn", "first_trxn_date date, first_trxn_store_key bigint", gd.first_trxn,
      pick(["first_trxn_date", "first_trxn_store_key"],
           "coalesce(first_trxn_date, date '9999-01-01'), first_trxn_store_key, member_key"))
field("golden_last_purchase", "last_web_purch_date date", lambda df: gd.last_purchase(df, gd.LAST_WEB_COLUMNS),
      "min(last_web_purch_date) as last_web_purch_date")
field("golden_loyalty", "loyalty_id string, current_tier_key int, member_status string, ip_code string", gd.loyalty,
      ", ".join(f"max(case when coll in (3, 4) and member_key = best then {c} end) as {c}"
                for c in ["loyalty_id", "current_tier_key", "member_status", "ip_code"]))
field("golden_prospect_counts", "prospect_contact_count bigint",
      lambda df: F.sum(F.coalesce("prospect_contact_count", F.lit(0))),
      "sum(coalesce(prospect_contact_count, 0)) as prospect_contact_count")


@query("golden_birth_date", "grouping_id string, birth_date date", """
  select grouping_id, case when dates > 1 then first_date else top_date end as birth_date from (
    select grouping_id, min(birth_date) as first_date, min(birth_date) filter (where n = top) as top_date,
      count(*) filter (where n = top) as dates from (
      select *, max(n) over (partition by grouping_id) as top from (
        select grouping_id, birth_date, count(*) as n from o_part
        where birth_date < date '2001-08-01' and birth_date > date '1901-08-01' group by grouping_id, birth_date) a) b
    group by grouping_id) c""")
def golden_birth_date(w):
    rows = grouped_rows(w)
    part = gd.eligible(rows, gd.collections(rows)).filter("is_resolved")
    return gd.birth_dates(part, DAY)


RESET_SCHEMA = "grouping_id string, email_address string, record_type string"


@query("golden_reset_enrichment", RESET_SCHEMA,
       "select distinct grouping_id, cast(null as varchar) as email_address, cast(null as varchar) as record_type from o_part")
def golden_reset_enrichment(w):
    return gd.golden_records(grouped_rows(w), DAY)


@query("golden_reset_phone", "grouping_id string, phone_nbr string",
       "select distinct grouping_id, cast(null as varchar) as phone_nbr from o_part")
def golden_reset_phone(w):
    return gd.golden_records(grouped_rows(w), DAY)


# ---------------------------------------------------------------- fuzzy

def _name_rows(w):
    rows = w.dup_member.select("member_key", *dd.NAME_KEY, "city_scrubbed", "state_scrubbed").withColumn(
        "grouping_criteria_id", F.lit(dd.NAME_RULE))
    return rows.filter(F.col("first_name").isNotNull() & dd._filled("last_name") & dd._filled("address1_scrubbed"))


def _check_norm(text: str) -> str:
    clean = f"trim(regexp_replace(upper({text}), '[^A-Z0-9 ]', '', 'g'))"
    return f"array_to_string(list_sort(string_split_regex({clean}, ' +')), ' ')"


def _check_block(cols: list[str]) -> str:
    return "concat_ws(chr(1), " + ", ".join(f"coalesce(upper({c}), chr(2))" for c in cols) + ")"


def _check_text(cols: list[str]) -> str:
    return _check_norm(" || ".join(f"coalesce({c}, 'null')" for c in cols))


def _check_filled(c: str) -> str:
    return f"coalesce(nullif(trim({c}), ''), 'UNKNOWN') <> 'UNKNOWN'"


CHECK_VIEWS["o_fz_rows"] = f"""
select member_key, first_name, last_name, {_check_filled("state_scrubbed")} and {_check_filled("city_scrubbed")} as placed,
  {_check_block(dd.ADDRESS_BLOCK)} as name_block, {_check_text(["first_name", "last_name"])} as name_text,
  {_check_block(dd.NAME_BLOCK)} as address_block, {_check_text(dd.ADDRESS_TEXT)} as address_text,
  concat_ws('~', {", ".join(f"upper({c})" for c in dd.NAME_KEY)}) as gid
from w_dup_member where first_name is not null and {_check_filled("last_name")} and {_check_filled("address1_scrubbed")}
"""


def _check_fuzzy(name: str, rows: str) -> None:
    """Views over rows (member_key, block, text): scored pairs by the table of common subsequences,
    and the groups of both modes."""
    CHECK_VIEWS[f"o_{name}_rows"] = rows
    CHECK_VIEWS[f"o_{name}_nodes"] = f"""
    select block, text, min(member_key) as rep, max(member_key) as last, count(*) as copies from o_{name}_rows group by block, text"""
    CHECK_VIEWS[f"o_{name}_score"] = f"""
    with recursive dp as (
      select x.block, x.text as a, y.text as b, 0 as i, list_transform(range(length(y.text) + 1), lambda z: 0) as r
      from o_{name}_nodes x join o_{name}_nodes y on x.block = y.block and x.text < y.text
      union all
      select block, a, b, i + 1, list_transform(range(1, length(b) + 2), lambda j: case when j = 1 then 0 else
        list_max(list_transform(range(2, j + 1), lambda k: greatest(r[k], r[k - 1] + (substr(a, i + 1, 1) = substr(b, k - 1, 1))::int))) end)
      from dp where i < length(a))
    select * from (select block, a, b, ((400 * r[length(b) + 1] + length(a) + length(b)) // (2 * (length(a) + length(b))))::int as score
      from dp where i = length(a)) s where score >= 94"""
    CHECK_VIEWS[f"o_{name}_keyed"] = f"""
    select s.block, a, b, score, x.rep as ka, y.rep as kb from o_{name}_score s
    join o_{name}_nodes x on x.block = s.block and x.text = a join o_{name}_nodes y on y.block = s.block and y.text = b"""
    CHECK_VIEWS[f"o_{name}_last"] = f"""
    select member_key, identifier from o_{name}_rows join (
      select block, text, arg_max(id, (texts, score, id)) as identifier from (
        select block, unnest([a, b]) as text, case when ka > kb then b || a else a || b end as texts, score,
          least(ka, kb) || '|' || greatest(ka, kb) as id from o_{name}_keyed
        union all select block, text, text || text, 100, rep || '|' || last from o_{name}_nodes where copies > 1) p
      group by block, text) g using (block, text)"""
    CHECK_VIEWS[f"o_{name}_connected"] = f"""
    with recursive e as (select ka as a, kb as b from o_{name}_keyed union all select kb, ka from o_{name}_keyed),
    reach as (select rep as node, rep as seen from o_{name}_nodes union select node, b from reach join e on a = seen),
    rooted as (select node, min(seen) as root from reach group by node),
    g as (select root, max(last) as high, sum(copies) as size from rooted join o_{name}_nodes on node = rep group by root)
    select member_key, root || '|' || high as identifier from o_{name}_rows join o_{name}_nodes using (block, text)
    join rooted on node = rep join g using (root) where size > 1"""


_check_fuzzy("fz_any", "select member_key, name_block as block, name_text as text from o_fz_rows")
_check_fuzzy("fz_name", "select member_key, name_block as block, name_text as text from o_fz_rows where placed")
_check_fuzzy("fz_address", "select member_key, address_block as block, address_text as text from o_fz_rows where placed")
CHECK_VIEWS["o_fz_exact"] = "select *, count(*) over (partition by gid) as same from o_fz_rows"
CHECK_VIEWS["o_fz_open"] = "select * from o_fz_exact where same = 1 and placed and length(first_name) > 1 and length(last_name) > 1"
_check_fuzzy("fx_name", "select member_key, name_block as block, name_text as text from o_fz_open")
for _mode in ("last", "connected"):
    _check_fuzzy(f"fx_{_mode}", f"""select member_key, address_block as block, address_text as text from o_fz_open
      where member_key not in (select member_key from o_fx_name_{_mode})""")
    CHECK_VIEWS[f"o_fx_{_mode}_found"] = f"select * from o_fx_name_{_mode} union all select * from o_fx_{_mode}_{_mode}"


def _check_exact_plus(mode: str) -> str:
    return f"""
    select member_key, gid as grouping_id, {dd.NAME_RULE} as grouping_criteria_id from o_fz_exact
    where same > 1 or member_key not in (select member_key from o_fx_{mode}_found)
    union all select member_key, identifier, {dd.FUZZY_RULE} from o_fx_{mode}_found"""


@query("fuzzy_score", "block string, a string, b string, score int", "select * from o_fz_any_score")
def fuzzy_score(w):
    rows = _name_rows(w)
    nodes = rows.select(dd._block(dd.ADDRESS_BLOCK).alias("block"),
                        fuzzy.norm(dd._text(["first_name", "last_name"])).alias("text")).distinct()
    return fuzzy.similar_texts(nodes)


@query("dedup_fuzzy_name", "member_key bigint, identifier string", "select * from o_fz_name_last")
def dedup_fuzzy_name(w):
    return dd.fuzzy_name_groups(_name_rows(w))


@query("dedup_fuzzy_address", "member_key bigint, identifier string", "select * from o_fz_address_last")
def dedup_fuzzy_address(w):
    return dd.fuzzy_address_groups(_name_rows(w))


@query("dedup_exact_plus_fuzzy", "member_key bigint, grouping_id string, grouping_criteria_id int", _check_exact_plus("last"))
def dedup_exact_plus_fuzzy(w):
    return dd.exact_plus_fuzzy(_name_rows(w))


@query("dedup_fuzzy_connected", "member_key bigint, grouping_id string, grouping_criteria_id int", _check_exact_plus("connected"))
def dedup_fuzzy_connected(w):
    return dd.exact_plus_fuzzy(_name_rows(w), connected=True)


# ---------------------------------------------------------------- results

CHECK_VIEWS["o_hist"] = """
select old_member_key, new_member_key, grouping_id, dedupe_info_key,
  is_invalid or max(cnt) over (partition by grouping_id) > 1 as is_invalid from (
  select *, count(*) over (partition by old_member_key) as cnt from (
    select distinct k.member_key as old_member_key, c.best as new_member_key, k.gid as grouping_id, i.dedupe_info_key,
      k.most > 1 as is_invalid
    from o_kept k join o_coll c on c.rule = k.rule and c.gid = k.gid join o_dup d on d.member_key = k.member_key
    left join w_dup_info i on i.id_condition = k.rule and i.collection_type = c.coll
    where c.coll not in (-1, 2) and c.best <> -1 and coalesce(trim(d.loyalty_id), '') = '' and k.member_key <> c.best) a) b
"""


def membership(w):
    return w.staged("dup_membership", lambda w: resolve(w)[2])


def history(w):
    return dd.history_fact(membership(w), members_of(w), w.dup_info, 1000)


def stored_history(w):
    return w.staged("dup_history", history)


@query("dedup_history_fact", "dedupe_member_hist_id bigint, old_member_key bigint, new_member_key bigint, "
       "grouping_id string, dedupe_info_key string, is_invalid boolean", """
  select 1000 + row_number() over (order by old_member_key, new_member_key, grouping_id) as dedupe_member_hist_id, * from o_hist""")
def dedup_history_fact(w):
    return history(w)


@query("dedup_stats", "dedupe_info_key string, id_condition_desc string, collection_type_descr string, dedupe_grp_cnt bigint", """
  select i.dedupe_info_key, id_condition_desc, collection_type_descr, count(*) as dedupe_grp_cnt
  from o_hist h join w_dup_info i on i.dedupe_info_key = h.dedupe_info_key where not is_invalid group by all""")
def dedup_stats(w):
    return dd.stats(stored_history(w), w.dup_info)


@query("dedup_assemble", "member_key bigint, action_flag string", """
  with bad as (select distinct grouping_id from o_hist where is_invalid),
  t as (select k.member_key, k.gid, c.best, k.rule || ':' || k.gid || ':' || c.n as info, b.grouping_id is not null as bad,
      c.coll not in (-1, 2) and c.best <> -1 and coalesce(trim(d.loyalty_id), '') = '' as open_group
    from o_kept k join o_coll c on c.rule = k.rule and c.gid = k.gid join o_dup d on d.member_key = k.member_key
    left join bad b on b.grouping_id = k.gid)
  select member_key, arg_min(action_flag, (p, action_flag)) as action_flag from (
    select best as member_key, 'U:' || info as action_flag, 0 as p from t where open_group and not bad
    union all select member_key, case when not open_group and not bad then 'loyalty:' else 'invalid:' end || info, 1 from t
      where not open_group or bad
    union all select member_key, 'ungrouped', 1 from o_dup where rule = 0) x group by member_key""")
def dedup_assemble(w):
    rows = membership(w).select(*dd.GROUP, "member_key").join(members_of(w).drop("grouping_criteria_id"), "member_key")
    return dd.assemble(members_of(w), membership(w), gd.golden_records(rows, DAY, dd.GROUP), stored_history(w))


# ---------------------------------------------------------------- re-keying

CHECK_VIEWS["o_map"] = "select old_member_key, new_member_key from o_hist where not is_invalid"


def mapping(w):
    return stored_history(w).select("old_member_key", "new_member_key", "is_invalid")


@query("rekey_dimension", "member_key bigint, email_address string, is_loyalty_email string, email_consent string, "
       "last_updated_date date, action_flag string", """
  select member_key, email_address, is_loyalty_email, email_consent, last_updated_date, action_flag from (
    select coalesce(m.new_member_key, e.member_key) as member_key, e.email_address, e.is_loyalty_email, e.email_consent,
      e.last_updated_date, case when m.old_member_key is null then 'NCD' else 'U' end as action_flag,
      row_number() over (partition by coalesce(m.new_member_key, e.member_key), e.email_address
        order by is_loyalty_email desc, email_consent desc, last_updated_date desc, e.member_key) as rn
    from w_multi_email e left join o_map m on m.old_member_key = e.member_key) x where rn = 1""")
def rekey_dimension(w):
    return dd.rekey_dimension(w.multi_email, mapping(w), "multi_email", ["consent_date"])


@query("rekey_multi_phone", "member_key bigint, phone_number bigint, is_loyalty_flag string, action_flag string", """
  select member_key, phone_number, is_loyalty_flag, action_flag from (
    select coalesce(m.new_member_key, e.member_key) as member_key, e.phone_number, e.is_loyalty_flag,
      case when m.old_member_key is null then 'NCD' else 'U' end as action_flag,
      row_number() over (partition by coalesce(m.new_member_key, e.member_key), e.phone_number
        order by is_loyalty_flag desc, phone_consent desc, last_updated_date desc, e.member_key) as rn
    from w_multi_phone e left join o_map m on m.old_member_key = e.member_key) x where rn = 1""")
def rekey_multi_phone(w):
    return dd.rekey_dimension(w.multi_phone, mapping(w), "multi_phone", ["phone_type"])


@query("rekey_fact", "trxn_id bigint, member_key bigint, tender_amount double", """
  select trxn_id, coalesce(m.new_member_key, t.member_key) as member_key, tender_amount
  from w_tender_history t left join o_map m on m.old_member_key = t.member_key""")
def rekey_fact(w):
    return dd.rekey_fact(w.view("w_tender_history"), mapping(w), DAY)


def new_path(w, name: str) -> str:
    return f"{staging_folder(w.spark)}/{name}-{uuid.uuid4().hex}"


@query("rekey_stored_fact", "trxn_id bigint, member_key bigint, tender_amount double", """
  select trxn_id, coalesce(m.new_member_key, t.member_key) as member_key, tender_amount
  from w_tender_history t left join o_map m on m.old_member_key = t.member_key""")
def rekey_stored_fact(w):
    path, changes = new_path(w, "tender"), mapping(w)
    store_by_key(w.tender_history, "member_key", path, 64)
    dd.rekey_stored(w.spark, path, changes, lambda rows: dd.rekey_fact(rows, changes, DAY), 64)
    return read_by_key(w.spark, path)


@query("rekey_card_history", "member_key bigint, tokenized_cc_nbr string, open_close_ind string, last_updated_date date", """
  with moved as (select coalesce(m.new_member_key, t.member_key) as mk, t.* from w_card_history t
    left join o_map m on m.old_member_key = t.member_key),
  touched as (select distinct new_member_key from o_map)
  select mk as member_key, tokenized_cc_nbr, open_close_ind, last_updated_date from (
    select *, row_number() over (partition by mk, tokenized_cc_nbr order by last_updated_date desc, open_close_ind, card_type_key) as rn
    from moved where mk in (select new_member_key from touched)) x where rn = 1
  union all select mk, tokenized_cc_nbr, open_close_ind, last_updated_date from moved
  where mk not in (select new_member_key from touched)""")
def rekey_card_history(w):
    return dd.rekey_card_history(w.card_history, mapping(w), ["open_close_ind", "card_type_key"])
