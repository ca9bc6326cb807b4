"""Daily indicators and their period report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..codes import UNKNOWN_KEY
from ..functions.dates import as_date, to_py_date
from ..functions.text import decode, is_not_empty
from ..operators.aggregates import count_distinct_per_key
from ..operators.sets import union_all
from ..operators.sizing import broadcast_if_small
from ..operators.skew import left_join_known
from ..operators.staging import stage

# ---- fixed values: indicator names and ids of the report ------------------------------
BASE_METRICS = ["CONSENT VALUE RETAIL", "CONSENT VALUE OUTLET", "CONSENT VALUE NEXT", "IS PLCC", "MEMBER COUNT",
                "LOYALTY MEMBERS COUNT", "LOYALTY MEMBERS WITH LENGTH OF LOYALTY ID=13 AND IPCODE NOT NULL COUNT",
                "A-LIST TIER", "BASE TIER", "MOVEMENT FROM BASE TIER TO A-LIST TIER",
                "MOVEMENT FROM A-LIST TIER TO BASE TIER", "TENDER TYPE", "EMPLOYEE TRANSACTIONS",
                "TRANSACTION CHANNEL", "LOYALTY TRANSACTIONS BY TIER"]
TRANSACTION_METRICS = ["PRODUCTS SOLD", "TOTAL SALE AFTER DISCOUNT", "DISCOUNTS", "CAPTURED LOYALTY TRANSACTIONS",
                       "IMPLIED LOYALTY TRANSACTIONS", "TRANSACTIONS WITH REWARD APPLIED – DETAIL",
                       "TRANSACTIONS WITH RING CODE 8888", "TRANSACTIONS WITH REWARD APPLIED - SUMMARY",
                       "TRANSACTIONS WITH NO TENDER"]
TOP_TIER, BASE_TIER = "A-List", "BaseTier"
CHANNELS = {8: "EFO", 1: "RETAIL", 2: "RETAIL", 6: "EComm"}

COLUMNS = ["kpi_name", "kpi_attribute_name", "kpi_attribute_value", "business_date"]


def _rows(df: DataFrame, name: str | Column, attribute: Column, value: Column, date: Column) -> DataFrame:
    name = F.lit(name) if isinstance(name, str) else name
    return df.select(name.alias("kpi_name"), attribute.cast("string").alias("kpi_attribute_name"),
                     value.cast("decimal(20,2)").alias("kpi_attribute_value"), date.alias("business_date"))


def _unpivot(df: DataFrame, metrics: dict[str, str], date: Column) -> DataFrame:
    """One row per metric of an aggregate row."""
    items = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.col(c).cast("decimal(20,2)").alias("v")) for n, c in metrics.items()]))
    return df.select(items.alias("m"), date.alias("_d")).select(
        F.col("m.n").alias("kpi_name"), F.lit(None).cast("string").alias("kpi_attribute_name"),
        F.col("m.v").alias("kpi_attribute_value"), F.col("_d").alias("business_date"))


def _members(members: DataFrame, previous: DataFrame, employees: DataFrame) -> DataFrame:
    """One narrow row per member or employee: what all indicators need of them."""
    old = previous.select("member_key", F.col("tier_name").alias("_was"))
    staff = employees.filter("employee_status <> 'T'").select("member_key").distinct().withColumn("_staff", F.lit(True))
    mine = members.select("member_key", "is_plcc", "tier_name", is_not_empty(F.col("loyalty_id")).alias("_loyal"),
                          ((F.length("loyalty_id") == 13) & F.col("ip_code").isNotNull()).alias("_full_id"), F.lit(True).alias("_member"))
    return mine.join(old, "member_key", "left").join(staff, "member_key", "full")


def _line_counts(lines: DataFrame, people: DataFrame, stores: DataFrame) -> DataFrame:
    """(kpi, attribute, trxn_date, n) of the indicators over lines in one pass: a line becomes a
    row for each indicator that counts it. Distinct transactions are counted in two steps that
    combine; the channel counts lines and carries no transaction."""
    who = people.filter("_staff or _loyal").select("member_key", "tier_name", "_loyal", "_staff")
    open_stores = broadcast_if_small(stores.filter("open_closed_ind = 'OPEN'").select("store_key", "zone_code"))
    known = F.col("member_key").isNotNull() & (F.col("member_key") != UNKNOWN_KEY)
    seen = lines.select("trxn_date", "trxn_id", "member_key", "store_key",
                        (F.col("captured_loyalty_id").isNotNull() | F.col("implied_loyalty_id").isNotNull()).alias("_card"))
    # an employee or member row for the unknown key stands for all lines without a member
    unknown = F.broadcast(who.filter(F.col("member_key") == UNKNOWN_KEY).groupBy().agg(
        F.first("tier_name").alias("_u_tier"), F.first("_loyal").alias("_u_loyal"), F.first("_staff").alias("_u_staff")))  # one row
    joined = left_join_known(seen, who, ["member_key"], known, ["trxn_id", "store_key"]).join(open_stores, "store_key", "left").crossJoin(unknown)
    is_unknown = F.col("member_key") == UNKNOWN_KEY
    of = lambda c: F.when(is_unknown, F.col(f"_u_{c}")).otherwise(F.col({"tier": "tier_name"}.get(c, f"_{c}")))
    tag = lambda name, when, attribute, trip: F.when(when, F.struct(F.lit(name).alias("kpi"), attribute.cast("string").alias("attribute"), trip.alias("trip")))
    tags = F.array_compact(F.array(
        tag("EMPLOYEE TRANSACTIONS", of("staff"), F.lit(None), F.col("trxn_id")),
        tag("LOYALTY TRANSACTIONS BY TIER", of("loyal") & F.col("_card"), of("tier"), F.col("trxn_id")),
        tag("TRANSACTION CHANNEL", F.lit(True), F.col("zone_code"), F.lit(None).cast(lines.schema["trxn_id"].dataType))))
    each = joined.select("trxn_date", F.explode(tags).alias("t")).groupBy("trxn_date", "t.kpi", "t.attribute", "t.trip").agg(F.count(F.lit(1)).alias("_lines"))
    trips = F.when(F.col("kpi") == "TRANSACTION CHANNEL", F.sum("_lines")).otherwise(F.count("trip"))
    return each.groupBy("kpi", "attribute", "trxn_date").agg(trips.alias("n"))


def kpi_base(members: DataFrame, previous: DataFrame, emails: DataFrame, tender: DataFrame, tender_types: DataFrame,
             employees: DataFrame, lines: DataFrame, stores: DataFrame, on) -> DataFrame:
    """Fifteen member and channel indicators. Every table is scanned once: members and employees
    for a narrow table that the counts over members and the lines read, consents and tenders for
    their own, the lines for all three of theirs."""
    day, count = as_date(on), F.count(F.lit(1)).alias("n")
    consents = {"CONSENT VALUE RETAIL": "consent_value_retail", "CONSENT VALUE OUTLET": "consent_value_outlet",
                "CONSENT VALUE NEXT": "consent_value_next"}
    each = emails.select(F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.col(c).alias("v")) for n, c in consents.items()])).alias("c"))
    consent = each.groupBy(F.col("c.n").alias("name"), F.col("c.v").alias("value")).agg(count)
    out = [_rows(consent, F.col("name"), F.col("value"), F.col("n"), day)]
    people = stage(_members(members, previous, employees))
    counts = people.filter("_member").groupBy("is_plcc").agg(
        count, F.count("member_key").alias("a"), F.count_if("_loyal").alias("b"), F.count_if("_full_id").alias("c"),
        F.count_if(F.col("tier_name") == TOP_TIER).alias("d"), F.count_if(F.col("tier_name") == BASE_TIER).alias("e"),
        F.count_if((F.col("tier_name") == TOP_TIER) & (F.col("_was") == BASE_TIER)).alias("f"),
        F.count_if((F.col("tier_name") == BASE_TIER) & (F.col("_was") == TOP_TIER)).alias("g"))
    out.append(_rows(counts, "IS PLCC", F.col("is_plcc"), F.col("n"), day))
    totals = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in "abcdefg"])
    out.append(_unpivot(totals, dict(zip(BASE_METRICS[4:11], "abcdefg")), day))
    kinds = tender.join(broadcast_if_small(tender_types.select("tender_type_key", "tender_type_description")), "tender_type_key", "left")
    per_kind = count_distinct_per_key(kinds, ["trxn_date", "tender_type_description"], "trxn_id", "n")
    out.append(_rows(per_kind, "TENDER TYPE", F.col("tender_type_description"), F.col("n"), F.col("trxn_date")))
    of_lines = _line_counts(lines, people, stores)
    attribute = F.when(F.col("kpi") == "TRANSACTION CHANNEL", decode(F.col("attribute").cast("int"), CHANNELS)).otherwise(F.col("attribute"))
    out.append(_rows(of_lines, F.col("kpi"), attribute, F.col("n"), F.col("trxn_date")))
    return union_all(out)


def kpi_transaction(lines: DataFrame, summary: DataFrame) -> DataFrame:
    """Nine transaction indicators per date: two passes, one over lines and one over summaries.
    Flags are brought to transactions first, so distinct counts become plain counts."""
    trips = lines.groupBy("trxn_date", "trxn_id").agg(
        F.sum("purchase_qty").alias("q"), F.sum("discount_amount").alias("d"),
        F.max(F.col("captured_loyalty_id").isNotNull()).alias("c"), F.max(F.col("implied_loyalty_id").isNotNull()).alias("i"),
        F.max(F.coalesce(F.col("ring_code_used") == "1417", F.lit(False))).alias("r"),
        F.max(F.coalesce(F.col("ring_code_used") == "8888", F.lit(False))).alias("k"))
    one = lambda c: F.nullif(F.count_if(c), F.lit(0)).alias(c)
    daily = trips.groupBy("trxn_date").agg(F.sum("q").alias("q"), F.sum("d").alias("d"), one("c"), one("i"), one("r"), one("k"))
    detail = _unpivot(daily, {"PRODUCTS SOLD": "q", "DISCOUNTS": "d", "CAPTURED LOYALTY TRANSACTIONS": "c",
                              "IMPLIED LOYALTY TRANSACTIONS": "i", "TRANSACTIONS WITH REWARD APPLIED – DETAIL": "r",
                              "TRANSACTIONS WITH RING CODE 8888": "k"}, F.col("trxn_date"))
    sums = summary.groupBy("trxn_date").agg(
        F.sum("ttl_amount_after_discount").alias("s"), F.nullif(F.count_if(F.col("reward_certs_qty") > 0), F.lit(0)).alias("w"),
        F.nullif(F.count_if((F.col("ttl_amount") == 0) & (F.col("has_tender") == "NO")), F.lit(0)).alias("z"))
    head = _unpivot(sums, {"TOTAL SALE AFTER DISCOUNT": "s", "TRANSACTIONS WITH REWARD APPLIED - SUMMARY": "w",
                           "TRANSACTIONS WITH NO TENDER": "z"}, F.col("trxn_date"))
    return union_all([detail, head]).filter(F.col("kpi_attribute_value").isNotNull())


def kpi_periods(report: DataFrame, on) -> DataFrame:
    """Seven period sums per indicator and attribute in one scan, and their changes in percent.
    Weeks begin on Sunday."""
    import datetime as dt
    day = to_py_date(on)
    back = lambda n: day - dt.timedelta(days=n)
    sunday = back((day.weekday() + 1) % 7)
    periods = {
        "business_date_cnt": (day, day), "business_date_minus_one": (back(1), back(1)), "sdlw": (back(7), back(7)),
        "wtd_val": (sunday, day), "last_week_wtd_val": (sunday - dt.timedelta(days=7), back(7)),
        "mtd": (day.replace(day=1), day), "ytd": (day.replace(month=1, day=1), day)}
    earliest = min(a for a, _ in periods.values())
    # only the days that some period needs are read
    recent = report.filter(F.col("business_date").between(F.lit(earliest), F.lit(day)))
    sums = [F.sum(F.when(F.col("business_date").between(F.lit(a), F.lit(b)), F.col("kpi_attribute_value"))).alias(n) for n, (a, b) in periods.items()]
    out = recent.groupBy("kpi_name", F.coalesce("kpi_attribute_name", F.lit("null")).alias("kpi_attribute_name")).agg(*sums)
    change = lambda a, b: (F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")) - 1) * 100
    return out.withColumns({
        "change_perc_business_date": change("business_date_cnt", "business_date_minus_one"), "change_per_sdlw": change("business_date_cnt", "sdlw"),
        "change_per_wtd": change("wtd_val", "last_week_wtd_val"), "business_date": F.lit(day)})
