"""Queries of the shared operators: sources, sinks, columns, filters, joins, aggregates, windows, sets."""

from __future__ import annotations

import uuid

from pyspark.sql import Window, functions as F

from ..functions import dates, geo, text
from ..operators import aggregates as ag, columns as co, filters as fi, joins as jo, ranking as rk, sets as st
from ..operators.nearest import nearest_stores
from ..operators.sequence import generate_sequence, sort_key
from ..operators.sizing import broadcast_if_small
from ..operators.staging import stage, staging_folder
from ..registry import query
from ..sources import readers as rd, writers as wr


def fresh(w, name: str) -> str:
    """A new folder in the shared staging area for one round trip."""
    return f"{staging_folder(w.spark)}/out/{name}-{uuid.uuid4().hex[:12]}"


# ---------------------------------------------------------------- sources and sinks

@query("scan_table", "store_key bigint, store_id bigint", "select store_key, store_id from w_store where open_closed_ind = 'OPEN'")
def scan_table(w):
    return rd.scan_table(w.store, ["store_key", "store_id"], "open_closed_ind = 'OPEN'")


@query("scan_csv_pipe", "member_key bigint, first_name string, last_name string, loyalty_id string", """
  select member_key, first_name, nullif(trim(last_name), '') as last_name, nullif(trim(loyalty_id), '') as loyalty_id from w_member""")
def scan_csv_pipe(w):
    path = fresh(w, "pipe")
    cols = ["member_key", "first_name", "last_name", "loyalty_id"]
    w.member.select(*cols).write.options(sep="|", header=True, nullValue="NULL").csv(path)
    return rd.read_pipe_csv(w.spark, path, columns=cols)


@query("scan_csv_headerless", "store_id string, district_code string", "select cast(store_id as varchar) as store_id, district_code from w_store")
def scan_csv_headerless(w):
    path = fresh(w, "headerless")
    w.store.select("store_id", "district_code").write.options(sep="|", header=False, nullValue="NULL").csv(path)
    return rd.read_headerless_csv(w.spark, path, "store_id|district_code")


@query("scan_csv_ddl", "member_key bigint, birth_date date, customer_add_date date", """
  select member_key, birth_date, cast(null as date) as customer_add_date from w_member""")
def scan_csv_ddl(w):
    path = fresh(w, "ddl")
    w.member.select("member_key", "birth_date").write.options(header=True, nullValue="NULL", dateFormat="yyyy/MM/dd").csv(path)
    return rd.read_ddl_csv(w.spark, path, ["member_key", "birth_date"],
                           "member_key bigint, birth_date date, customer_add_date date")


@query("scan_file_name", "holds_members boolean, rows bigint", "select true as holds_members, count(*) as rows from w_member where source_overlay_rank = 0")
def scan_file_name(w):
    keys = w.member.filter("source_overlay_rank = 0").select("member_key")
    held = rd.files_holding(w.member, keys, "member_key")
    tagged = rd.with_file_name(w.member).join(held, "file_name", "left_semi").join(keys, "member_key", "left_semi")
    return tagged.agg((F.count("file_name") > 0).alias("holds_members"), F.count(F.lit(1)).alias("rows"))


@query("sink_overwrite", "employee_id string, employee_status string", "select employee_id, employee_status from w_employee")
def sink_overwrite(w):
    path = fresh(w, "overwrite")
    rows = w.employee.select("employee_id", "employee_status")
    wr.overwrite(rows, path, "employee_status")
    # a second write replaces only the partitions it touches
    wr.overwrite(rows.filter("employee_status = 'ACTIVE'"), path, "employee_status")
    return w.spark.read.parquet(path)


@query("sink_append", "employee_id string, batch string", """
  select employee_id, 'a' as batch from w_employee union all select employee_id, 'b' from w_employee""")
def sink_append(w):
    path = fresh(w, "append")
    for batch in "ab":
        wr.append(w.employee.select("employee_id", F.lit(batch).alias("batch")), path, "batch")
    return w.spark.read.schema("employee_id string, batch string").parquet(path)


@query("sink_text", "value string", "select lpad(cast(store_id as varchar), 6, ' ') || lpad(district_code, 3, ' ') as value from w_store")
def sink_text(w):
    path = fresh(w, "text")
    wr.write_text(w.store.select(text.fixed_width([("store_id", 6), ("district_code", 3)]).alias("value")), path)
    return w.spark.read.text(path)


@query("sink_csv_feed", "value string", """
  select cast(member_key as varchar) || '|' || coalesce(first_name, '') || '|' || coalesce(cast(birth_date as varchar), '') as value from w_member""")
def sink_csv_feed(w):
    path = wr.write_csv_feed(w.member.select("member_key", "first_name", "birth_date"), fresh(w, "feed"), "2001-08-01")
    return rd.read_lines(w.spark, path)


@query("sink_orc_by_file", "member_key bigint, city string", "select member_key, city from w_member")
def sink_orc_by_file(w):
    path = fresh(w, "orc")
    tagged = rd.with_file_name(w.member.select("member_key", "city")).withColumn(
        "file_name", F.regexp_extract("file_name", "([^/]+)$", 1))
    wr.write_by_file(tagged, path)
    return w.spark.read.orc(path)


@query("sink_table_stats", "name string, differing bigint", """
  select 'city' as name, count(*) filter (where city <> 'Avon') as differing from w_member""")
def sink_table_stats(w):
    stats = w.member.agg(F.count_if(F.col("city") != "Avon").alias("differing")).withColumn("name", F.lit("city"))
    path = fresh(w, "stats")
    table = "stats_" + path.rsplit("-", 1)[1]
    wr.save_stats(stats, table, path)
    return w.spark.table(table)


@query("checkpoint_stage", "member_key bigint, is_dm_marketable string", "select member_key, is_dm_marketable from w_member")
def checkpoint_stage(w):
    return stage(w.member.select("member_key", "is_dm_marketable"))


# ---------------------------------------------------------------- columns

@query("get_columns", "store_id bigint, store_name string", "select store_id, store_name from w_store")
def get_columns(w):
    keep = set(w.store.columns) - {"store_id", "store_name"}
    return w.store.alias("s").select(*co.get_columns(w.store, "s", exclude=keep))


@query("drop_columns", "nation_key int, nation_name string", "select n_nationkey as nation_key, n_name as nation_name from nation")
def drop_columns(w):
    out = co.drop_columns(w.nation, ["n_regionkey"])
    return co.rename_columns(out, {"n_nationkey": "nation_key", "n_name": "nation_name"})


@query("rename_columns", "n_nationkey int, n_name string", "select n_nationkey, n_name from nation")
def rename_columns(w):
    names = {"n_nationkey": "nation_key", "n_name": "nation_name"}
    return co.rename_columns(co.rename_columns(w.nation, names), names, reverse=True)


@query("apply_expressions", "product_key bigint, price double, taxed double, label string", """
  select product_key, p_retailprice * 2 as price, p_retailprice * 2 * 1.1 as taxed, upper(p_name) as label from w_product""")
def apply_expressions(w):
    return co.apply_expressions(w.product, {"price": "p_retailprice * 2", "taxed": "price * 1.1D", "label": "upper(p_name)"})


@query("cast_columns", "member_key string, dpv_key bigint, promotion_count bigint", """
  select cast(member_key as varchar) as member_key, dpv_key, promotion_count from w_member""")
def cast_columns(w):
    return co.cast_columns(co.cast_columns(w.member, to="bigint", of_type="int"), ["member_key"], "string")


@query("unstruct", "member_key bigint, fn string, ln string", "select member_key, first_name as fn, last_name as ln from w_member")
def unstruct(w):
    packed = w.member.select("member_key", F.struct(F.col("first_name").alias("fn"), F.col("last_name").alias("ln")).alias("name"))
    return co.unstruct(packed, "name")


@query("null_fill_columns", "store_key bigint, manager string, opened date", """
  select store_key, cast(null as varchar) as manager, cast(null as date) as opened from w_store""")
def null_fill_columns(w):
    return co.align_to_schema(w.store, "store_key bigint, manager string, opened date")


@query("default_fill_columns", "store_key bigint, region_key bigint, manager string", """
  select store_key, -1 as region_key, cast(null as varchar) as manager from w_store""")
def default_fill_columns(w):
    return co.default_fill_columns(w.store, "store_key bigint, region_key bigint, manager string")


@query("empty_to_null", "member_key bigint, last_name string, loyalty_id string, exported string", """
  select member_key, case when trim(last_name) <> '' then last_name end as last_name,
    case when trim(loyalty_id) <> '' then loyalty_id end as loyalty_id, coalesce(first_name, '') as exported from w_member""")
def empty_to_null(w):
    out = co.empty_to_null(w.member, ["last_name", "loyalty_id"])
    return co.null_text_to_empty(out.withColumn("exported", F.col("first_name")), ["exported"])


@query("strip_delimiter", "product_key bigint, label string", "select product_key, p_name || p_type as label from w_product")
def strip_delimiter(w):
    return co.strip_delimiter(w.product.withColumn("label", F.concat("p_name", F.lit("|"), "p_type")), ["label"])


@query("prefix_side_columns", "member_key bigint, home string, work string", """
  select member_key, city as home, state as work from w_member""")
def prefix_side_columns(w):
    left = co.prefix_columns(w.member.select("member_key", "city"), "400_")
    right = co.prefix_columns(w.member.select("member_key", "state"), "600_")
    both = left.join(right, F.col("400_member_key") == F.col("600_member_key"), "full")
    return co.unprefix_columns(both.drop("600_member_key"), "400_").select(
        "member_key", F.col("city").alias("home"), F.col("600_state").alias("work"))


# ---------------------------------------------------------------- filters

@query("split_by", "side string, rows bigint", """
  select case when loyalty_id like 'LY%' then 'yes' else 'no' end as side, count(*) as rows from w_member group by 1""")
def split_by(w):
    yes, no = fi.split_by(w.member, F.col("loyalty_id").startswith("LY"))
    return st.union_all([yes.withColumn("side", F.lit("yes")), no.withColumn("side", F.lit("no"))]).groupBy("side").agg(
        F.count(F.lit(1)).alias("rows"))


@query("split_by_null_drops", "side string, rows bigint", """
  select case when loyalty_id like 'LY%' then 'yes' else 'no' end as side, count(*) as rows from w_member
  where loyalty_id is not null group by 1""")
def split_by_null_drops(w):
    yes, no = fi.split_by(w.member, F.col("loyalty_id").startswith("LY"), keep_null=False)
    return st.union_all([yes.withColumn("side", F.lit("yes")), no.withColumn("side", F.lit("no"))]).groupBy("side").agg(
        F.count(F.lit(1)).alias("rows"))


@query("is_not_empty", "member_key bigint, has_last_name boolean, lacks_loyalty boolean", """
  select member_key, coalesce(trim(last_name), '') <> '' as has_last_name, coalesce(trim(loyalty_id), '') = '' as lacks_loyalty
  from w_member""")
def is_not_empty(w):
    return w.member.select("member_key", text.is_not_empty(F.col("last_name")).alias("has_last_name"),
                           text.is_empty(F.col("loyalty_id")).alias("lacks_loyalty"))


PHONE_OK = """(length(ph) = 10 or (length(ph) = 11 and ph like '1%')) and length(replace(ph, substr(ph, 1, 1), '')) > 0
  and ph not in ('0000000001', '1234567890', '1231231234', '1000000000', '0000000123', '2000000000', '0000000002', '8000000000')"""


@query("valid_phone", "member_key bigint, phone_nbr string, is_valid boolean", f"""
  select member_key, phone_nbr, {PHONE_OK} as is_valid from (select member_key, phone_nbr, phone_nbr as ph from w_member) x""")
def valid_phone(w):
    return w.member.withColumn("is_valid", text.valid_phone(F.col("phone_nbr")))


@query("email_has_bad_chars", "doc_id bigint, word string, is_bad boolean", """
  select doc_id, word, word similar to '.*[!#$%&''*+\\-/=?^`].*' as is_bad
  from (select doc_id, string_split(replace(text, chr(10), ' '), ' ')[1] as word from documents) x""")
def email_has_bad_chars(w):
    docs = w.spark.read.parquet(f"{w.folder}/documents.parquet")
    words = docs.select("doc_id", F.split(F.replace("text", F.lit("\n"), F.lit(" ")), " ")[0].alias("word"))
    return words.withColumn("is_bad", text.email_has_bad_chars(F.col("word")))


@query("df_is_empty", "is_empty boolean", "select count(*) = 0 as is_empty from w_member where member_key < 0")
def df_is_empty(w):
    none = fi.df_is_empty(w.member.filter("member_key < 0"))
    return w.spark.range(1).select(F.lit(none).alias("is_empty"))


@query("current_only", "member_key bigint, batch_id string", """
  select member_key, batch_id from w_scd_backup where status = 'current'
  and batch_id = (select max(batch_id) from w_scd_backup where status = 'current')""")
def current_only(w):
    return fi.newest_batch(w.scd_backup)


@query("skew_key_exclusion", "member_key bigint, email_address string", """
  select member_key, email_address from w_multi_email where member_key not in (2, 5, -1)""")
def skew_key_exclusion(w):
    return fi.exclude_skew_keys(w.multi_email, "member_key", [2, 5])


@query("business_date_filter", "member_key bigint, last_updated_date date", """
  select member_key, last_updated_date from w_member where last_updated_date > date '2000-09-01'""")
def business_date_filter(w):
    return fi.after_business_date(w.member, "2000-09-01")


@query("lookup_nonempty_filter", "member_key bigint", """
  select member_key from w_member where trim(first_name) <> '' and trim(last_name) <> ''""")
def lookup_nonempty_filter(w):
    return w.member.filter(text.is_not_empty(F.col("first_name")) & text.is_not_empty(F.col("last_name")))


# ---------------------------------------------------------------- joins

@query("join_left_lookup", "trxn_id bigint, trxn_date date, trxn_date_key bigint", """
  select trxn_id, trxn_date, coalesce(date_key, -1) as trxn_date_key from w_trxn_head left join w_date on sdate = trxn_date""")
def join_left_lookup(w):
    dim = w.date.select(F.col("sdate").alias("trxn_date"), F.col("date_key").alias("trxn_date_key"))
    return jo.left_lookup(w.trxn_head, dim, "trxn_date", ["trxn_date_key"])


@query("update_keys", "member_key bigint, enrollment_date_key bigint, last_updated_date_key bigint", """
  select member_key, coalesce(a.date_key, -1) as enrollment_date_key, coalesce(b.date_key, -1) as last_updated_date_key
  from w_member left join w_date a on a.sdate = enrollment_date left join w_date b on b.sdate = last_updated_date""")
def update_keys(w):
    return jo.update_keys(w.member, ["enrollment_date", "last_updated_date"], w.date, "sdate", "date_key")


@query("join_full_outer_cdc", "side string, rows bigint", """
  select case when b.member_key is null then 'left' when a.member_key is null then 'right' else 'both' end as side, count(*) as rows
  from (select member_key from w_scd_batch) a full join (select distinct member_key from w_scd_backup where status = 'current') b
    on a.member_key = b.member_key group by 1""")
def join_full_outer_cdc(w):
    current = w.scd_backup.filter("status = 'current'").select("member_key").distinct()
    return jo.full_outer_merge(w.scd_batch.select("member_key"), current, ["member_key"]).groupBy("side").agg(
        F.count(F.lit(1)).alias("rows"))


@query("join_full_outer_merge", "member_key bigint, city string, state string, side string", """
  select coalesce(a.member_key, b.member_key) as member_key, coalesce(a.city, b.city) as city, coalesce(a.state, b.state) as state,
    case when b.member_key is null then 'left' when a.member_key is null then 'right' else 'both' end as side
  from (select member_key, min(city) as city, max(state) as state from w_scd_batch group by 1) a
  full join (select member_key, city, state from w_scd_backup where status = 'current' and batch_id = '20010731000000') b on a.member_key = b.member_key""")
def join_full_outer_merge(w):
    left = w.scd_batch.groupBy("member_key").agg(F.min("city").alias("city"), F.max("state").alias("state"))
    return jo.full_outer_merge(left, fi.newest_batch(w.scd_backup).select("member_key", "city", "state"), ["member_key"])


@query("join_full_outer_periods", "kind string, y1 double, y2 double", """
  select o_orderpriority as kind, sum(case when year(o_orderdate) = 1996 then o_totalprice end) as y1,
    sum(case when year(o_orderdate) = 1997 then o_totalprice end) as y2 from orders group by 1""")
def join_full_outer_periods(w):
    year = lambda y: F.sum(F.when(F.year("o_orderdate") == y, F.col("o_totalprice")))
    return w.orders.groupBy(F.col("o_orderpriority").alias("kind")).agg(year(1996).alias("y1"), year(1997).alias("y2"))


@query("join_anti", "trxn_id bigint", "select trxn_id from w_trxn_head where trxn_id not in (select l_orderkey from lineitem)")
def join_anti(w):
    return jo.anti(w.trxn_head.select("trxn_id"), w.lineitem.select(F.col("l_orderkey").alias("trxn_id")), "trxn_id")


@query("join_semi", "member_key bigint", """
  select member_key from w_member where member_key in (select member_key from w_trxn_head where trxn_date >= date '2001-01-01')""")
def join_semi(w):
    return jo.semi(w.member.select("member_key"), w.trxn_head.filter("trxn_date >= date '2001-01-01'"), "member_key")


@query("join_inner_multi", "member_key bigint, tokenized_cc_nbr string, is_plcc string", """
  select m.member_key, tokenized_cc_nbr, is_plcc from w_member m, w_card_history c, w_card_type t
  where m.member_key = c.member_key and c.card_type_key = t.card_type_key and m.last_updated_date = c.last_updated_date
    or (m.member_key = c.member_key and c.card_type_key = t.card_type_key and m.last_updated_date <> c.last_updated_date and is_plcc = 'YES')""")
def join_inner_multi(w):
    cards = w.card_history.join(broadcast_if_small(w.card_type), "card_type_key").withColumnRenamed("last_updated_date", "card_date")
    joined = w.member.join(cards, "member_key")
    return joined.filter((F.col("last_updated_date") == F.col("card_date")) | (F.col("is_plcc") == "YES"))


@query("join_normalized_key", "etl_unique_id string, member_key bigint", """
  select f.etl_unique_id, e.member_key from w_feed f join w_employee e on lpad(f.employee_id, 11, '0') = e.employee_id""")
def join_normalized_key(w):
    feed = w.feed.select("etl_unique_id", F.lpad("employee_id", 11, "0").alias("employee_id"))
    return feed.join(w.employee.select("employee_id", "member_key"), "employee_id")


@query("join_exploded_list", "household_key bigint, member_key bigint, city string", """
  select h.household_key, m.member_key, m.city from w_household h join w_member m on m.member_key in (
    select cast(unnest(string_split(h.associated_member_key, ',')) as bigint))""")
def join_exploded_list(w):
    rows = jo.explode_key_list(w.household, "associated_member_key", "member_key")
    return rows.select("household_key", "member_key").join(w.member.select("member_key", "city"), "member_key")


@query("join_self_parent", "event_id bigint, parent_id bigint, parent_key bigint", """
  select event_id, case when event_id % 3 = 0 then null else cast(floor(event_id / 2) as bigint) end as parent_id,
    case when event_id % 3 = 0 then -1 else cast(floor(event_id / 2) as bigint) + 5000000 end as parent_key from events""")
def join_self_parent(w):
    rows = w.events.select("event_id", "ts", (F.col("event_id") + 5000000).alias("fact_key"),
                           F.when(F.col("event_id") % 3 != 0, F.floor(F.col("event_id") / 2)).alias("parent_id"))
    return jo.resolve_parent(rows, "event_id", "parent_id", "fact_key", [F.col("ts").desc(), F.col("fact_key").desc()], "parent_key")


@query("join_right", "store_key bigint, trips bigint", """
  select s.store_key, coalesce(t.trips, 0) as trips from (select store_key, count(distinct trxn_id) as trips from w_trxn
    where trxn_date >= date '2001-07-01' group by store_key) t right join w_store s on s.store_key = t.store_key""")
def join_right(w):
    trips = ag.count_distinct_per_key(w.trxn.filter("trxn_date >= date '2001-07-01'"), ["store_key"], "trxn_id", "trips")
    return trips.join(w.store.select("store_key"), "store_key", "right").fillna(0, ["trips"])


@query("join_constant_domain", "member_key bigint, gender string, member_status string", """
  select member_key, cast(g.constant_id as varchar) as gender, cast(s.constant_id as varchar) as member_status from w_member m
  left join w_constant g on g.constant_type = 'GENDER' and lower(trim(g.constant_value)) = lower(trim(m.gender))
  left join w_constant s on s.constant_type = 'STATUS' and lower(trim(s.constant_value)) = lower(trim(m.member_status))""")
def join_constant_domain(w):
    return jo.constant_domain(w.member, w.constant, {"gender": "GENDER", "member_status": "STATUS"})


MILES = """2 * asin(least(1.0, sqrt(pow(sin(radians(s.latitude - m.latitude) / 2), 2) + cos(radians(m.latitude)) * cos(radians(s.latitude))
  * pow(sin(radians(s.longitude - m.longitude) / 2), 2)))) * 6371.0 * 1000 * 0.000621371"""
NEAREST = f"""select m.member_key, a.closest_store_key, a.second_closest_store_key, a.distance, a.second_distance from w_member m left join (
    select member_key, max(store_key) filter (where r = 1) as closest_store_key, max(store_key) filter (where r = 2) as second_closest_store_key,
      max(d) filter (where r = 1) as distance, max(d) filter (where r = 2) as second_distance from (
      select *, row_number() over (partition by member_key order by d, store_key) as r from (
        select m.member_key, s.store_key, {MILES} as d from w_member m, w_store s where m.latitude is not null) x) y
    group by member_key) a on a.member_key = m.member_key"""


@query("join_nearest_store", "member_key bigint, closest_store_key bigint, second_closest_store_key bigint, distance double, "
       "second_distance double", NEAREST, headline=True)
def join_nearest_store(w):
    return nearest_stores(w.member, w.store)


# ---------------------------------------------------------------- aggregates

@query("agg_basic", "member_key bigint, trips bigint, spend double, first_date date, last_date date, average double7", """
  select member_key, count(*) as trips, sum(tender_amount) as spend, min(trxn_date) as first_date, max(trxn_date) as last_date,
    sum(tender_amount) / count(*) as average from w_tender_history group by member_key""")
def agg_basic(w):
    out = w.tender_history.groupBy("member_key").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("tender_amount").alias("spend"), F.min("trxn_date").alias("first_date"),
        F.max("trxn_date").alias("last_date"))
    return out.withColumn("average", F.col("spend").cast("double") / F.col("trips"))


@query("agg_count_distinct", "store_key bigint, trips bigint", """
  select store_key, count(distinct trxn_id) as trips from w_trxn group by store_key""")
def agg_count_distinct(w):
    return ag.count_distinct_per_key(w.trxn, ["store_key"], "trxn_id", "trips")


@query("agg_two_level", "member_key bigint, kinds bigint, largest double", """
  select member_key, count(*) as kinds, max(amount) as largest from (
    select member_key, tender_type_key, sum(tender_amount) as amount from w_tender_history group by 1, 2) x group by 1""")
def agg_two_level(w):
    per_kind = w.tender_history.groupBy("member_key", "tender_type_key").agg(F.sum("tender_amount").alias("amount"))
    return per_kind.groupBy("member_key").agg(F.count(F.lit(1)).alias("kinds"), F.max("amount").alias("largest"))


@query("agg_conditional_pivot", "member_key bigint, urgent double, low double, other double", """
  select member_key, sum(case when tender_type_key in (1, 2) then tender_amount else 0 end) as urgent,
    sum(case when tender_type_key = 5 then tender_amount else 0 end) as low,
    sum(case when tender_type_key not in (1, 2, 5) then tender_amount else 0 end) as other from w_tender_history group by 1""")
def agg_conditional_pivot(w):
    part = lambda cond: F.sum(F.when(cond, F.col("tender_amount")).otherwise(0))
    kind = F.col("tender_type_key")
    return w.tender_history.groupBy("member_key").agg(part(kind.isin(1, 2)).alias("urgent"), part(kind == 5).alias("low"),
                                                      part(~kind.isin(1, 2, 5)).alias("other"))


@query("agg_collect", "household_key bigint, cities string", """
  select household_key, string_agg(city, ',' order by city) as cities from (
    select distinct household_key, city from w_member where household_key <> -1) x group by 1""")
def agg_collect(w):
    rows = w.member.filter("household_key <> -1").select("household_key", "city").distinct()
    return rows.groupBy("household_key").agg(F.array_join(ag.non_empty_set("city"), ",").alias("cities"))


@query("group_by_as_list", "tier_key int, grouped_count bigint, members bigint, smallest bigint", """
  select tier_key, count(*) as grouped_count, count(*) as members, min(member_key) as smallest from w_member group by tier_key""")
def group_by_as_list(w):
    # a key comes out in lists of bounded length; all of them together hold every row
    out = ag.lists_by_place(w.member, ["tier_key"], ["city", "state"], ["member_key"])
    return out.groupBy("tier_key").agg(F.max("grouped_count").alias("grouped_count"), F.sum(F.size("grouped_data")).alias("members"),
                                       F.min(F.col("grouped_data")[0]["member_key"]).alias("smallest"))


@query("lists_by_place", "state string, list_no bigint, grouped_count bigint, size bigint, first_key bigint, last_key bigint", """
  select state, (r - 1) // 20 as list_no, any_value(n) as grouped_count, count(*) as size, min(member_key) as first_key, max(member_key) as last_key from (
    select state, member_key, row_number() over (partition by state order by member_key) as r, count(*) over (partition by state) as n from w_member) x group by all""")
def lists_by_place(w):
    out = ag.lists_by_place(w.member, ["state"], ["city"], ["member_key"], length=20)
    rows = F.col("grouped_data")
    return out.select("state", "list_no", "grouped_count", F.size(rows).alias("size"), rows[0]["member_key"].alias("first_key"),
                      F.element_at(rows, -1)["member_key"].alias("last_key"))


@query("agg_household_identifier", "zip_code string, household_key bigint", """
  select zip_code, coalesce(arg_min(household_key, (customer_introduction_date, household_key))
    filter (where customer_introduction_date is not null), -1) as household_key from w_member group by zip_code""")
def agg_household_identifier(w):
    return w.member.groupBy("zip_code").agg(ag.earliest_key("household_key", "customer_introduction_date").alias("household_key"))


@query("max_key", "max_key bigint", "select max(member_key) as max_key from w_member")
def max_key(w):
    return ag.max_key(w.member, "member_key")


@query("agg_latest_pair", "member_key bigint, trxn_date date, trxn_time_key int", """
  select member_key, trxn_date, trxn_time_key from (select *, row_number() over (partition by member_key
    order by trxn_date desc, trxn_time_key desc) as r from w_trxn_head) x where r = 1""")
def agg_latest_pair(w):
    return w.trxn_head.groupBy("member_key").agg(*ag.latest_pair("trxn_date", "trxn_time_key"))


@query("agg_latest_pair_independent", "member_key bigint, trxn_date date, trxn_time_key int", """
  select member_key, max(trxn_date) as trxn_date, max(trxn_time_key) as trxn_time_key from w_trxn_head group by 1""")
def agg_latest_pair_independent(w):
    return w.trxn_head.groupBy("member_key").agg(*ag.latest_pair("trxn_date", "trxn_time_key", independent=True))


@query("agg_column_diff_counts", "city bigint, first_name bigint", """
  select count(*) filter (where a.city is distinct from b.city) as city,
    count(*) filter (where a.first_name is distinct from b.first_name) as first_name
  from w_scd_batch a join w_scd_backup b on a.member_key = b.member_key and b.status = 'current' and b.batch_id = '20010731000000'""")
def agg_column_diff_counts(w):
    old = co.prefix_columns(fi.newest_batch(w.scd_backup), "o_")
    joined = w.scd_batch.join(old, F.col("member_key") == F.col("o_member_key"))
    return joined.agg(*[F.count_if(~F.col(c).eqNullSafe(F.col(f"o_{c}"))).alias(c) for c in ("city", "first_name")])


@query("agg_min_rank_household", "household_key bigint, best int", """
  select household_key, min(source_overlay_rank) as best from w_member where household_key <> -1 group by 1""")
def agg_min_rank_household(w):
    return w.member.filter("household_key <> -1").groupBy("household_key").agg(F.min("source_overlay_rank").alias("best"))


# ---------------------------------------------------------------- windows

@query("win_latest_per_key", "member_key bigint, trxn_id bigint, trxn_date date", """
  select member_key, trxn_id, trxn_date from (select *, row_number() over (partition by member_key order by trxn_date desc, trxn_id desc) as r
    from w_trxn_head) x where r = 1""", headline=True)
def win_latest_per_key(w):
    return rk.latest_per_key(w.trxn_head, "member_key", [F.col("trxn_date").desc(), F.col("trxn_id").desc()])


@query("win_first_any", "household_key bigint, member_key bigint", """
  select household_key, min(member_key) as member_key from w_member group by 1""")
def win_first_any(w):
    return rk.latest_per_key(w.member, "household_key", [F.col("member_key")])


@query("win_rank_ties", "household_key bigint, member_key bigint, dpv_key int", """
  select household_key, member_key, dpv_key from (select *, rank() over (partition by household_key order by dpv_key desc nulls last) as r
    from w_member) x where r = 1""")
def win_rank_ties(w):
    return rk.keep_best_ties(w.member, ["household_key"], F.coalesce(-F.col("dpv_key"), F.lit(1)))


@query("win_dense_rank", "member_key bigint, email_address string, last_updated_date date", """
  select member_key, email_address, last_updated_date from (select *, dense_rank() over (partition by member_key
    order by last_updated_date desc) as r from w_multi_email) x where r = 1""")
def win_dense_rank(w):
    return rk.keep_best_ties(w.multi_email, ["member_key"], -F.unix_date("last_updated_date"))


@query("win_count_over", "member_key bigint, household_key bigint, household_size bigint", """
  select member_key, household_key, count(*) over (partition by household_key) as household_size from w_member""")
def win_count_over(w):
    return rk.with_key_aggregates(w.member.select("member_key", "household_key"), ["household_key"],
                                  household_size=F.count(F.lit(1)))


@query("win_first_over", "member_key bigint, first_date date, first_trxn bigint", """
  select member_key, trxn_date as first_date, trxn_id as first_trxn from (select *, row_number() over (partition by member_key
    order by trxn_date, trxn_id) as r from w_trxn_head) x where r = 1""")
def win_first_over(w):
    first = F.min(F.struct("trxn_date", "trxn_id"))
    return w.trxn_head.groupBy("member_key").agg(first["trxn_date"].alias("first_date"), first["trxn_id"].alias("first_trxn"))


@query("win_max_over", "member_key bigint, household_key bigint, newest date, oldest date", """
  select member_key, household_key, max(last_updated_date) over (partition by household_key) as newest,
    min(last_updated_date) over (partition by household_key) as oldest from w_member""")
def win_max_over(w):
    return rk.with_key_aggregates(w.member.select("member_key", "household_key", "last_updated_date"), ["household_key"],
                                  newest=F.max("last_updated_date"), oldest=F.min("last_updated_date"))


@query("win_top2", "member_key bigint, store_key bigint, place int", """
  select member_key, store_key, r as place from (select member_key, store_key, row_number() over (partition by member_key
      order by count(distinct trxn_id) desc, store_key) as r from w_trxn group by member_key, store_key) x where r <= 2""")
def win_top2(w):
    trips = ag.count_distinct_per_key(w.trxn, ["member_key", "store_key"], "trxn_id", "trips")
    return rk.latest_per_key(trips, "member_key", [F.col("trips").desc(), F.col("store_key")], n=2, rank_col="place")


# ---------------------------------------------------------------- sort and sets

@query("sort_trim_na", "member_key bigint, place bigint", """
  select member_key, row_number() over (order by coalesce(loyalty_id, 'NA'), coalesce(first_name, 'NA'), member_key) as place from w_member""")
def sort_trim_na(w):
    rows = w.member.select("member_key", "loyalty_id", "first_name")
    return generate_sequence(rows, "place", sort_key(["loyalty_id", "first_name"]) + [F.col("member_key")])


@query("sort_feed", "etl_unique_id string, file_date date", """
  select etl_unique_id, strptime(right(etl_unique_id, 8), '%Y%m%d') as file_date from w_feed""")
def sort_feed(w):
    return w.feed.select("etl_unique_id", dates.file_date(F.col("etl_unique_id")).alias("file_date")).orderBy("file_date", "etl_unique_id")


@query("take_first_value", "member_key bigint, newest date", """
  select member_key, (select max(trxn_date) from w_trxn_head) as newest from w_member""")
def take_first_value(w):
    newest = w.trxn_head.agg(F.max("trxn_date").alias("newest"))  # one row
    return w.member.select("member_key").crossJoin(F.broadcast(newest))


@query("generate_sequence", "trxn_id bigint, fact_id bigint", """
  select trxn_id, 500 + row_number() over (order by trxn_date, trxn_id) as fact_id from w_trxn_head""", headline=True)
def gen_sequence(w):
    return generate_sequence(w.trxn_head.select("trxn_id", "trxn_date"), "fact_id", [F.col("trxn_date"), F.col("trxn_id")], 500)


@query("union_all", "kind string, value string", """
  select 'email' as kind, email_address as value from w_multi_email union all select 'phone', cast(phone_number as varchar) from w_multi_phone""")
def union_all(w):
    return st.union_all([w.multi_email.select(F.lit("email").alias("kind"), F.col("email_address").alias("value")),
                         w.multi_phone.select(F.col("phone_number").cast("string").alias("value"), F.lit("phone").alias("kind"))])


@query("distinct", "city string, state string", "select distinct city, state from w_member")
def distinct(w):
    return w.member.select("city", "state").distinct()


@query("drop_duplicates", "email string, member_key bigint", """
  select lower(email_address) as email, min(member_key) as member_key from w_multi_email group by 1""")
def drop_duplicates(w):
    return rk.latest_per_key(w.multi_email.withColumn("email", F.lower("email_address")), "email", [F.col("member_key")])


@query("except_distinct", "city string, zip_code string", "select city, zip_code from w_member except select city, zip_code from w_feed")
def except_distinct(w):
    return st.except_distinct(w.member.select("city", "zip_code"), w.feed.select("city", "zip_code"))


@query("dedup_rowhash", "member_key bigint, copy boolean", """
  select member_key, r > 1 as copy from (select member_key, row_number() over (
    partition by lower(trim(last_name)), lower(trim(zip_code)) order by member_key) as r from w_member) x""")
def dedup_rowhash(w):
    firsts, copies = st.dedup_rowhash(w.member.select("member_key", "last_name", "zip_code"), ["last_name", "zip_code"],
                                      [F.col("member_key")])
    return firsts.withColumn("copy", F.lit(False)).unionByName(copies.withColumn("copy", F.lit(True)))


# ---------------------------------------------------------------- scalar functions

@query("fixed_width_format", "line string", """
  select lpad(cast(trxn_id as varchar), 12, ' ') || lpad(cast(member_key as varchar), 10, ' ') || lpad(cast(trxn_date as varchar), 11, ' ')
    || lpad(o_orderstatus, 2, ' ') as line from w_trxn_head""")
def fixed_width_format(w):
    spec = [("trxn_id", 12), ("member_key", 10), ("trxn_date", 11), ("o_orderstatus", 2)]
    return w.trxn_head.select(text.fixed_width(spec).alias("line"))


@query("string_functions", "member_key bigint, card string, keys string, bare string, blank boolean", """
  select member_key, regexp_replace(tokenized_cc_nbr, '^0+', '') as card,
    member_key || ',' || member_key * 10 || ',' || member_key + 100000000 as keys, cast(member_key as varchar) as bare,
    false as blank from w_card_history""")
def string_functions(w):
    key = F.col("member_key").cast("string")
    mixed = F.concat_ws(",", (F.col("member_key") + 100000000).cast("string"), key, (F.col("member_key") * 10).cast("string"))
    return w.card_history.select(
        "member_key", text.strip_leading_zeros(F.col("tokenized_cc_nbr")).alias("card"), text.sort_key_list(mixed).alias("keys"),
        text.strip_brackets(F.concat(F.lit("["), key, F.lit("]"))).alias("bare"), (F.ascii("tokenized_cc_nbr") == 0).alias("blank"))


@query("trxn_id_key", "trxn_id bigint, till_id string", """
  select trxn_id, strftime(trxn_date, '%Y%m%d') || lpad(cast(member_key % 99999 as varchar), 5, '0')
    || lpad(cast(trxn_time_key % 999 as varchar), 3, '0') || lpad(cast(trxn_id % 99999 as varchar), 5, '0') as till_id from w_trxn_head""")
def trxn_id_key(w):
    return w.trxn_head.select("trxn_id", text.trxn_id(F.col("trxn_date"), F.col("member_key") % 99999,
                                                      F.col("trxn_time_key") % 999, F.col("trxn_id") % 99999).alias("till_id"))


@query("date_functions", "member_key bigint, age int, file_date date", """
  select member_key, round((12 * (2001 - year(birth_date)) + (8 - month(birth_date)) + (1 - day(birth_date)) / 31.0) / 12) as age,
    date '1970-01-01' as file_date from w_member""")
def date_functions(w):
    return w.member.select("member_key", dates.age_years(F.col("birth_date"), "2001-08-01").alias("age"),
                           dates.file_date(F.col("city")).alias("file_date"))


@query("math_functions", "member_key bigint, miles double, latitude_text double", f"""
  select m.member_key, {MILES} as miles, -round(m.latitude, 2) as latitude_text
  from w_member m, w_store s where s.store_key = m.member_key % 50 + 1""")
def math_functions(w):
    stores = w.store.select(F.col("store_key").alias("sk"), F.col("latitude").alias("slat"), F.col("longitude").alias("slon"))
    near = w.member.join(broadcast_if_small(stores), F.col("member_key") % 50 + 1 == F.col("sk"))
    micro = F.concat(F.round(F.col("latitude") * 100).cast("bigint").cast("string"), F.lit("0000S"))
    return near.select("member_key", geo.haversine_miles(F.col("latitude"), F.col("longitude"), F.col("slat"), F.col("slon")).alias("miles"),
                       geo.coordinate(micro).alias("latitude_text"))


@query("hash_functions", "groups bigint, rows bigint", """
  select count(distinct (lower(trim(first_name)), lower(trim(loyalty_id)))) as groups, count(*) as rows from w_member""")
def hash_functions(w):
    h = text.null_safe_hash([F.col("first_name"), F.col("loyalty_id")])
    per_hash = w.member.groupBy(h.alias("h")).agg(F.count(F.lit(1)).alias("n"))
    return per_hash.agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("rows"))


@query("normalize_flag", "member_key bigint, consent string, status string", """
  select member_key, case direct_mail_consent when 'UNKNOWN' then 'UNKNOWN' when 'YES' then 'YES' else 'NO' end as consent,
    case member_status when 'ACTIVE' then 'OPEN' else member_status end as status from w_member""")
def normalize_flag(w):
    short = F.lower(F.substring("direct_mail_consent", 1, 1))
    raw = F.when(F.col("member_key") % 2 == 0, short).otherwise(F.lower("direct_mail_consent"))
    return w.member.select("member_key", text.normalize_flag(F.when(raw == "u", "unknown").otherwise(raw)).alias("consent"),
                           text.normalize_flag(F.col("member_status"), {"active": "OPEN"}).alias("status"))


@query("conditional_functions", "member_key bigint, first_contact date, tier string", """
  select member_key, least(first_trxn_date, customer_introduction_date) as first_contact,
    case when tier_key between 2 and 3 then 'upper' when tier_key in (1) then 'base' end as tier from w_member""")
def conditional_functions(w):
    return w.member.select("member_key", F.least("first_trxn_date", "customer_introduction_date").alias("first_contact"),
                           F.when(F.col("tier_key").between(2, 3), "upper").when(F.col("tier_key").isin(1), "base").alias("tier"))


@query("array_functions", "member_key bigint, phone string, place int", """
  select member_key, phone, place from (select member_key, unnest([phone_nbr, reverse(phone_nbr)]) as phone, unnest([0, 1]) as place from w_member) x
  where phone is not null""")
def array_functions(w):
    both = F.array("phone_nbr", F.reverse("phone_nbr"))
    return w.member.select("member_key", F.posexplode(both).alias("place", "phone"))
