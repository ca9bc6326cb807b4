"""Linking feed rows to member keys.

The reference semantics are a waterfall: criteria are tried in order and each sees only the
rows that are still unmatched. Whether a criterion hits a row depends on that row alone, so
the waterfall equals "the first criterion, in order, that hits". It is planned in one pass:

1. every row yields one probe (priority, code, key) per criterion it is eligible for;
2. lookup rows whose contact value occurs in the feed are kept by one semi join, get their
   member's names and tie-break order by one join, and yield index entries (code, key);
3. entries are reduced to one winner per key by a min of the order struct (partial first);
4. hits are reduced to the best per row and joined back to the feed once.

So 15 criteria cost a handful of shuffles instead of one chain of joins per criterion, no
step waits for a driver action and no lineage has to be cut.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, functions as F

from ..codes import (EMPTY_CARD, MARKETABILITY_ORDER, MARKETABILITY_OTHER, MATCH_CODES, MATCH_META, MCD_CANADA,
                     MCD_CARD, MCD_EMAIL, MCD_FAILED, MCD_LOYALTY, MCD_PHONE, MCD_US, UNKNOWN_KEY)
from ..functions.text import (decode, digits_to_long, email_key, fixed_width, is_empty, is_not_empty, norm_text,
                              text_to_long, valid_phone)
from ..operators.aggregates import max_key as largest_key
from ..operators.ranking import with_key_aggregates
from ..operators.sequence import generate_sequence
from ..operators.sets import union_all
from ..operators.skew import join_back
from ..operators.staging import stage
from ..operators.sizing import broadcast_if_small

SEP = "\u0001"


@dataclass(frozen=True)
class Lookups:
    """Lookup tables of the matching jobs; see `lookups()` for the standing filters."""

    member: DataFrame
    multi_email: DataFrame
    multi_phone: DataFrame
    card_history: DataFrame
    card_type: DataFrame
    tender_history: DataFrame
    tender_type: DataFrame
    employee: DataFrame
    transactions: DataFrame  # trxn_date, trxn_time_key, member_key


def lookups(member, multi_email, multi_phone, card_history, card_type, tender_history, tender_type, employee,
            transactions, skew_members=()) -> Lookups:
    """Apply the standing filters: current rows, known members, usable values, and the
    members that the caller excludes as garbage."""
    def known(df, extra=None):
        df = df.filter(F.col("member_key") != UNKNOWN_KEY)
        if skew_members:
            df = df.filter(~F.col("member_key").isin(list(skew_members)))
        if "status" in df.columns:
            df = df.filter(F.col("status") == "current")
        return df if extra is None else df.filter(extra)

    return Lookups(
        member=known(member), multi_email=known(multi_email),
        multi_phone=known(multi_phone, (digits_to_long(F.col("phone_number")) != 0) & valid_phone(F.col("phone_number"))),
        card_history=known(card_history, (F.col("tokenized_cc_nbr") != EMPTY_CARD)
                           & (text_to_long(F.col("tokenized_cc_nbr")) != 0)),
        card_type=card_type.filter("status = 'current'"), tender_history=known(tender_history),
        tender_type=tender_type.filter("status = 'current'"), employee=known(employee),
        transactions=known(transactions))


# ---------------------------------------------------------------- criteria

def _key(*parts: Column) -> Column:
    """Parts as one text; a missing part makes the key null, and null keys never match."""
    text = [p.cast("string") for p in parts]
    out = [text[0]]
    for p in text[1:]:
        out += [F.lit(SEP), p]
    return F.concat(*out)


class _Feed:
    """Normalised expressions over a feed; a column the feed lacks counts as empty."""

    def __init__(self, df: DataFrame):
        have = set(df.columns)
        col = lambda n: F.col(n).cast("string") if n in have else F.lit(None).cast("string")
        self.loyalty, self.employee, self.ip = col("implied_loyalty_id"), col("employee_id"), col("ip_code")
        self.card, self.email_raw, self.phone_raw = col("tender_number"), col("email_address"), col("phone")
        self.email, self.phone = email_key(self.email_raw), digits_to_long(self.phone_raw)
        self.first, self.last = norm_text(col("first_name")), norm_text(col("last_name"))
        self.addr1, self.addr2 = norm_text(col("address_line_1")), norm_text(col("address_line_2"))
        self.zip = norm_text(col("zip_code"))
        self.has_email, self.has_phone = is_not_empty(self.email_raw), is_not_empty(self.phone_raw)
        self.any_name = self.first.isNotNull() | self.last.isNotNull()
        self.both_names = self.first.isNotNull() & self.last.isNotNull()
        self.address = F.concat_ws(",", self.addr1, self.addr2)


@dataclass(frozen=True)
class Criterion:
    """One criterion. `contact`: the kind of lookup row it starts from. `probe` gives
    (eligible, key, second key); a criterion with a second key must find one member by both."""

    name: str
    contact: str
    probe: object
    contact2: str | None = None
    require_loyalty: bool = False
    prefer_holder: bool = False

    @property
    def code(self) -> int:
        return MATCH_CODES[self.name.removesuffix("_without_name")]


CRITERIA = {c.name: c for c in [
    Criterion("loyalty_id", "loyalty", lambda f: (is_not_empty(f.loyalty), _key(f.loyalty), None)),
    Criterion("employee_id", "employee", lambda f: (F.lit(True), F.lpad(f.employee, 11, "0"), None)),
    Criterion("ip_code", "ip", lambda f: (F.lit(True), _key(f.ip), None)),
    Criterion("plcc_loyalty", "plcc", lambda f: (F.lit(True), _key(f.card), None),
              require_loyalty=True, prefer_holder=True),
    Criterion("plcc_name", "plcc", lambda f: (f.any_name, _key(f.card, f.first, f.last), None)),
    Criterion("plcc_name_loyalty", "plcc", lambda f: (f.any_name, _key(f.card, f.first, f.last), None),
              require_loyalty=True),
    Criterion("bank_card", "bank", lambda f: (f.both_names, _key(text_to_long(f.card)), None)),
    Criterion("bank_card_name", "bank", lambda f: (f.any_name, _key(text_to_long(f.card), f.first, f.last), None)),
    Criterion("email", "email", lambda f: (f.has_email, _key(f.email), None)),
    Criterion("email_without_name", "email", lambda f: (f.has_email & ~f.both_names, _key(f.email), None)),
    Criterion("email_name", "email", lambda f: (f.has_email & f.any_name, _key(f.email, f.first, f.last), None)),
    Criterion("phone", "phone", lambda f: (f.has_phone, _key(f.phone_raw), None)),
    Criterion("phone_without_name", "phone", lambda f: (f.has_phone & ~f.both_names, _key(f.phone_raw), None)),
    Criterion("phone_name", "phone", lambda f: (f.has_phone & f.any_name, _key(f.phone, f.first, f.last), None)),
    Criterion("phone_email", "phone", lambda f: (f.has_phone & f.has_email, _key(f.phone), _key(f.email)),
              contact2="email"),
    Criterion("phone_email_loyalty", "phone",
              lambda f: (f.has_phone & f.has_email, _key(f.phone), _key(f.email)), contact2="email"),
    Criterion("phone_email_name", "phone",
              lambda f: (f.has_phone & f.has_email & f.any_name, _key(f.phone, f.first, f.last), _key(f.email)),
              contact2="email"),
    Criterion("name_address", "address",
              lambda f: ((f.addr1.isNotNull() | f.addr2.isNotNull()) & f.zip.isNotNull() & f.any_name,
                         _key(f.first, f.last, f.address, f.zip), None)),
]}

# How a contact row (value, first, last, raw, loyal) spells the key of each criterion.
_INDEX_KEYS = {
    "loyalty_id": lambda: (F.lit(True), _key(F.col("value"))),
    "employee_id": lambda: (F.lit(True), _key(F.col("value"))),
    "ip_code": lambda: (F.lit(True), _key(F.col("value"))),
    "plcc_loyalty": lambda: (F.lit(True), _key(F.col("value"))),
    "plcc_name": lambda: (F.lit(True), _key(F.col("value"), F.col("first"), F.col("last"))),
    "plcc_name_loyalty": lambda: (F.lit(True), _key(F.col("value"), F.col("first"), F.col("last"))),
    "bank_card": lambda: (F.lit(True), _key(F.col("value"))),
    "bank_card_name": lambda: (F.lit(True), _key(F.col("value"), F.col("first"), F.col("last"))),
    "email": lambda: (F.lit(True), _key(F.col("value"))),
    "email_name": lambda: (F.lit(True), _key(F.col("value"), F.col("first"), F.col("last"))),
    "phone": lambda: (F.lit(True), _key(F.col("raw"))),
    "phone_name": lambda: (F.lit(True), _key(F.col("value"), F.col("first"), F.col("last"))),
    "phone_email": lambda: (F.lit(True), _key(F.col("value"))),
    "phone_email_loyalty": lambda: (F.col("loyal") == "YES", _key(F.col("value"))),
    "phone_email_name": lambda: (F.lit(True), _key(F.col("value"), F.col("first"), F.col("last"))),
    "name_address": lambda: (F.lit(True), _key(F.col("value"))),
}
_SECOND_KEYS = {
    "phone_email": lambda: (F.lit(True), _key(F.col("value"))),
    "phone_email_loyalty": lambda: (F.col("loyal") == "YES", _key(F.col("value"))),
    "phone_email_name": lambda: (F.lit(True), _key(F.col("value"))),
}


def _feed_contacts(f: _Feed) -> dict[str, Column]:
    return {
        "loyalty": f.loyalty, "employee": F.lpad(f.employee, 11, "0"), "ip": f.ip, "plcc": f.card,
        "bank": text_to_long(f.card).cast("string"), "email": F.nullif(f.email, F.lit("")),
        "phone": F.when(f.has_phone, f.phone.cast("string")),
        "address": _key(f.first, f.last, f.address, f.zip),
    }


def _contacts(lk: Lookups, kinds: set[str]) -> DataFrame:
    """Lookup rows of the wanted kinds: kind, value, raw, loyal, member_key."""
    none = F.lit(None).cast("string")
    member = lk.member
    first, last = norm_text(F.col("first_name")), norm_text(F.col("last_name"))
    address = F.concat_ws(",", norm_text(F.col("address1")), norm_text(F.col("address2")))
    parts = {
        "loyalty": lambda: (member.filter(is_not_empty(F.col("loyalty_id"))), F.col("loyalty_id"), none, none),
        "ip": lambda: (member.filter(F.col("ip_code").isNotNull()), F.col("ip_code"), none, none),
        "address": lambda: (member, _key(first, last, address, norm_text(F.col("zip_code"))), none, none),
        "employee": lambda: (lk.employee, F.lpad(F.col("employee_id").cast("string"), 11, "0"), none, none),
        "plcc": lambda: (lk.card_history.join(
            broadcast_if_small(lk.card_type.filter("is_plcc = 'YES'").select("card_type_key")), "card_type_key", "left_semi")
            .select("tokenized_cc_nbr", "member_key").distinct(),
            F.col("tokenized_cc_nbr"), none, none),
        "bank": lambda: (lk.tender_history.filter(text_to_long(F.col("tokenized_cc_nbr")) != 0).join(
            broadcast_if_small(lk.tender_type.filter("is_bank_card = 'YES'").select("tender_type_key")),
            "tender_type_key", "left_semi").select("tokenized_cc_nbr", "member_key").distinct(),
            text_to_long(F.col("tokenized_cc_nbr")).cast("string"), none, none),
        "email": lambda: (lk.multi_email, F.nullif(email_key(F.col("email_address")), F.lit("")), none,
                          F.col("is_loyalty_email")),
        "phone": lambda: (lk.multi_phone, digits_to_long(F.col("phone_number")).cast("string"),
                          F.col("phone_number").cast("string"), F.col("is_loyalty_flag")),
    }
    frames = []
    for kind in sorted(kinds):
        df, value, raw, loyal = parts[kind]()
        frames.append(df.select(F.lit(kind).alias("kind"), value.alias("value"), raw.alias("raw"),
                                loyal.alias("loyal"), F.col("member_key").cast("bigint").alias("member_key")))
    return union_all(frames).filter(F.col("value").isNotNull())


def marketability(dm: Column, em: Column, sms: Column) -> Column:
    return decode(F.concat_ws("~", dm, em, sms), MARKETABILITY_ORDER, MARKETABILITY_OTHER)


def last_transaction(transactions: DataFrame, independent: bool = False) -> DataFrame:
    """Newest (date, time) per member."""
    from ..operators.aggregates import latest_pair
    return transactions.groupBy("member_key").agg(*latest_pair("trxn_date", "trxn_time_key", independent))


def primary_holders(lk: Lookups) -> DataFrame:
    plcc = broadcast_if_small(lk.card_type.filter("is_plcc = 'YES'").select("card_type_key"))
    return (lk.card_history.filter("is_primary_account_holder = 'YES'").join(plcc, "card_type_key", "left_semi")
            .select("member_key").distinct())


def member_facts(lk: Lookups, holder: bool = False, names: bool = False) -> DataFrame:
    """One row per member with all that ties are broken by, and its names if asked for."""
    named = [norm_text(F.col("first_name")).alias("first"), norm_text(F.col("last_name")).alias("last")] if names else []
    m = lk.member.select("member_key", marketability(F.col("is_dm_marketable"), F.col("is_em_marketable"),
                                                     F.col("is_sms_marketable")).alias("_market"),
                         F.col("customer_introduction_date").alias("_intro"),
                         is_not_empty(F.col("loyalty_id")).alias("_loyal"), *named)
    last = last_transaction(lk.transactions).select(
        "member_key", (-F.unix_date("trxn_date")).alias("_ago"), (-F.col("trxn_time_key")).alias("_time"))
    out = m.join(last, "member_key", "full")
    if holder:
        return out.join(primary_holders(lk).withColumn("_holder", F.lit(0)), "member_key", "full")
    return out.withColumn("_holder", F.lit(None).cast("int"))


def tie_order(members: DataFrame, lk: Lookups, holder: bool = False, names: bool = False) -> DataFrame:
    """Add the tie-break order of each row's member: a struct whose smallest value wins.

    Primary card holder (only for the card criterion), then marketability, most recent
    transaction, earliest introduction (unknown last) and smallest key. Each documented
    stage only narrows the members left by the one before, so one ordering covers all.
    """
    out = join_back(members, member_facts(lk, holder, names), ["member_key"], "left")
    far = F.lit(2147483647)
    order = F.struct(F.coalesce(F.col("_market"), F.lit(MARKETABILITY_OTHER)).alias("market"),
                     F.coalesce(F.col("_ago"), far).alias("ago"), F.coalesce(F.col("_time"), far).alias("time"),
                     F.coalesce(F.unix_date("_intro"), far).alias("intro"),
                     F.col("member_key").alias("member_key"),
                     F.coalesce(F.col("_loyal"), F.lit(False)).alias("loyal"))
    return out.withColumn("_order", order).withColumn("_holder", F.coalesce("_holder", F.lit(1)))


def tie_breaker(pairs: DataFrame, keys: list[str], lk: Lookups, holder: bool = False) -> DataFrame:
    """One member per key from (key, member_key) pairs."""
    ordered = tie_order(pairs.select(*keys, "member_key"), lk, holder)
    best = F.min(F.struct("_holder", "_order"))
    return ordered.groupBy(*keys).agg(best["_order"]["member_key"].alias("member_key"))


def tie_identify(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct pairs with the number of members per key; more than one is a tie."""
    distinct = pairs.select(*keys, "member_key").distinct()
    return with_key_aggregates(distinct, keys, member_count=F.count(F.lit(1)))


# ---------------------------------------------------------------- the engine

def _probes(feed: DataFrame, row_id: str, criteria: list[Criterion], gate: Column | None = None) -> DataFrame:
    f = _Feed(feed)
    arr = []
    for i, c in enumerate(criteria):
        eligible, a, b = c.probe(f)
        if gate is not None and i > 0:
            eligible = eligible & gate
        arr.append(F.when(eligible & a.isNotNull(), F.struct(
            F.lit(i).alias("prio"), F.lit(c.code).alias("code"), a.alias("a"),
            (b if b is not None else F.lit(None).cast("string")).alias("b"))))
    return (feed.select(F.col(row_id).alias("_rid"), F.explode(F.array(*arr)).alias("x"))
            .select("_rid", "x.*").filter(F.col("a").isNotNull()))


def _index(lk: Lookups, feed: DataFrame, criteria: list[Criterion]) -> DataFrame:
    """Index entries (code, side, key, member_key, order) for values that the feed asks for."""
    kinds = {c.contact for c in criteria} | {c.contact2 for c in criteria if c.contact2}
    f = _Feed(feed)
    values = _feed_contacts(f)
    wanted = (feed.select(F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), values[k].alias("value"))
                                             for k in sorted(kinds)])).alias("x"))
              .select("x.*").filter(F.col("value").isNotNull()).distinct())
    # what the feed asks for is about as large as the feed: with it staged, members and above
    # all the transaction history are cut down to its members before they are aggregated
    rows = stage(_contacts(lk, kinds).join(wanted, ["kind", "value"], "left_semi"))
    keys = rows.select("member_key").distinct()
    lk = replace(lk, member=lk.member.join(keys, "member_key", "left_semi"),
                 transactions=lk.transactions.join(keys, "member_key", "left_semi"))
    rows = tie_order(rows, lk, holder=any(c.prefer_holder for c in criteria), names=True)
    entries = []
    seen = set()
    for c in criteria:
        if c.code in seen:
            continue
        seen.add(c.code)
        name = c.name.removesuffix("_without_name")
        cond, key = _INDEX_KEYS[name]()
        entries.append(_entry(c, "a", F.col("kind") == c.contact, cond, key))
        if c.contact2:
            cond, key = _SECOND_KEYS[name]()
            entries.append(_entry(c, "b", F.col("kind") == c.contact2, cond, key))
    return (rows.select("member_key", F.explode(F.array(*entries)).alias("x"),
                        "_holder", "_order")
            .select("member_key", "x.code", "x.side", "x.key",
                    F.struct(F.when(F.col("x.holder"), F.col("_holder")).otherwise(1).alias("holder"),
                             F.col("_order").alias("rest")).alias("rank"))
            .filter(F.col("key").isNotNull()))


def _entry(c: Criterion, side: str, kind: Column, cond: Column, key: Column) -> Column:
    return F.when(kind & F.coalesce(cond, F.lit(False)),
                  F.struct(F.lit(c.code).alias("code"), F.lit(side).alias("side"), key.alias("key"),
                           F.lit(c.prefer_holder).alias("holder")))


def _pair_entries(probes: DataFrame, index: DataFrame) -> DataFrame:
    """Members found by both keys of a two-key criterion: (code, a, b, rank).

    The members behind either key may be many, so they are expanded only on the side with
    fewer members and then tested against the other side by a semi join. Pairs of the two
    lists are never formed.
    """
    wanted = probes.filter(F.col("b").isNotNull()).select("code", "a", "b").distinct()
    sides = {s: index.filter(F.col("side") == s) for s in "ab"}
    sizes = {s: sides[s].groupBy("code", F.col("key").alias(s)).agg(F.count(F.lit(1)).alias(f"_n{s}")) for s in "ab"}
    sized = join_back(join_back(wanted, sizes["a"], ["code", "a"]), sizes["b"], ["code", "b"])
    out = []
    for small, large, cond in (("b", "a", F.col("_nb") <= F.col("_na")), ("a", "b", F.col("_na") < F.col("_nb"))):
        rows = sides[small].select("code", F.col("key").alias(small), "member_key", "rank")
        test = sides[large].select("code", F.col("key").alias(large), "member_key")
        out.append(sized.filter(cond).select("code", "a", "b").join(rows, ["code", small])
                   .join(test, ["code", large, "member_key"], "left_semi").select("code", "a", "b", "rank"))
    return union_all(out)


def find_matches(feed: DataFrame, lk: Lookups, criteria: list[Criterion], row_id: str, gate: Column | None = None) -> DataFrame:
    """(row id, match_key, member_key) for every row that some criterion hits. With a gate,
    only rows that pass it try the criteria after the first."""
    probes = _probes(feed, row_id, criteria, gate)
    index = _index(lk, feed, criteria)
    singles = [c for c in criteria if not c.contact2]
    doubles = [c for c in criteria if c.contact2]
    if doubles:
        # both sides of the pair test and the single keys read the index: compute it once
        index = stage(index)
    entries = []
    if singles:
        codes = list({c.code for c in singles})
        entries.append(index.filter(F.col("code").isin(codes))
                       .select("code", F.col("key").alias("a"), F.lit("").alias("b"), "rank"))
    if doubles:
        entries.append(_pair_entries(probes, index))
    winners = union_all(entries).groupBy("code", "a", "b").agg(F.min("rank")["rest"].alias("w"))
    need = list({c.code for c in criteria if c.require_loyalty})
    if need:
        winners = winners.filter(~F.col("code").isin(need) | F.col("w.loyal"))
    winners = winners.select("code", "a", "b", F.col("w.member_key").alias("member_key"))
    hits = join_back(probes.withColumn("b", F.coalesce("b", F.lit(""))), winners, ["code", "a", "b"])
    best = F.min(F.struct("prio", "code", "member_key"))
    return (hits.groupBy("_rid").agg(best.alias("h"))
            .select(F.col("_rid").alias(row_id), F.col("h.code").alias("match_key"), F.col("h.member_key").alias("member_key")))


def match_waterfall(feed: DataFrame, lk: Lookups, names: list[str], row_id: str = "etl_unique_id",
                    gate: Column | None = None) -> DataFrame:
    """The feed with match_status, match_key, member_key and mcd_criteria; no row is lost.

    Rows that already have match_status = true keep their key.
    """
    criteria = [CRITERIA[n] for n in names]
    meta = list(MATCH_META)
    carried = "match_status" in feed.columns
    open_rows = feed.filter(~F.col("match_status")) if carried else feed
    found = find_matches(open_rows, lk, criteria, row_id, gate).withColumnsRenamed(
        {"match_key": "_code", "member_key": "_member"})
    out = feed.join(found, row_id, "left")
    prior = {m: (F.col(m) if m in feed.columns else F.lit(v)) for m, v in MATCH_META.items()}
    hit = F.col("_code").isNotNull()
    return out.select(*[c for c in feed.columns if c not in meta],
                      (hit | prior["match_status"]).alias("match_status"),
                      F.coalesce("_code", prior["match_key"]).cast("int").alias("match_key"),
                      F.coalesce("_member", prior["member_key"]).cast("bigint").alias("member_key"),
                      prior["mcd_criteria"].alias("mcd_criteria"))


def add_match_meta(df: DataFrame) -> DataFrame:
    return df.withColumns({n: F.lit(v) for n, v in MATCH_META.items()})


# ---------------------------------------------------------------- new members

def _text(df: DataFrame, name: str) -> Column:
    return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")


US_COLUMNS = ["first_name", "last_name", "address_line_1", "zip_code"]
CANADA_COLUMNS = ["first_name", "last_name", "address_line_1", "non_usa_postal_code"]


def mcd_classify(df: DataFrame) -> Column:
    """Which rule of the minimum customer definition a row meets first."""
    t = lambda n: _text(df, n)
    every = lambda names: _all([is_not_empty(t(n)) for n in names])
    return (F.when(is_not_empty(t("implied_loyalty_id")), MCD_LOYALTY)
            .when(every(US_COLUMNS), MCD_US)
            .when(every(CANADA_COLUMNS), MCD_CANADA)
            .when(is_not_empty(t("tender_number")) & (F.coalesce(text_to_long(t("tender_number")), F.lit(0)) != 0), MCD_CARD)
            .when(is_not_empty(t("email_address")), MCD_EMAIL)
            .when(is_not_empty(t("phone")) & (t("phone") != "UNKNOWN") & valid_phone(t("phone")), MCD_PHONE)
            .otherwise(MCD_FAILED))


def _all(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def mcd_group_key(df: DataFrame, label: Column) -> Column:
    """Rows with the same text are one new customer; a missing part is marked, not skipped."""
    people = sorted(set(US_COLUMNS + CANADA_COLUMNS))
    parts = {
        MCD_LOYALTY: ["implied_loyalty_id"], MCD_US: US_COLUMNS, MCD_CANADA: CANADA_COLUMNS,
        MCD_CARD: ["tender_number"] + people, MCD_EMAIL: ["email_address"] + people, MCD_PHONE: ["phone"] + people,
    }
    out = F
    for name, cols in parts.items():
        text = F.concat_ws("|", F.lit(name), *[F.coalesce(_text(df, c), F.lit("~")) for c in cols])
        out = out.when(label == name, text)
    return out


def new_member_keys(unmatched: DataFrame, member: DataFrame, max_key: int | None = None) -> DataFrame:
    """Give each group of unmatched rows one new member key after the largest known key;
    rows that meet no rule get -1. Groups are numbered in the order of their key text."""
    tagged = unmatched.drop("member_key").withColumn("mcd_criteria", mcd_classify(unmatched))
    tagged = tagged.withColumn("_group", mcd_group_key(tagged, F.col("mcd_criteria")))
    start = largest_key(member, "member_key") if max_key is None else max_key
    groups = tagged.filter(F.col("_group").isNotNull()).select("_group").distinct()
    keys = generate_sequence(groups, "member_key", [F.col("_group")], start)
    # rows without a rule would all meet in one task of the join
    ruled = tagged.filter(F.col("_group").isNotNull()).join(keys, "_group").drop("_group")
    other = tagged.filter(F.col("_group").isNull()).drop("_group").withColumn("member_key", F.lit(UNKNOWN_KEY).cast("bigint"))
    return ruled.unionByName(other)


# ---------------------------------------------------------------- record info

def record_info_flags(df: DataFrame) -> Column:
    """Nine YES/NO flags in one text: name, address, e-mail, phone, mobile, store card,
    bank card, loyalty, member."""
    has = set(df.columns)
    t = lambda n: _text(df, n)
    any_of = lambda names: ((_any([is_not_empty(t(n)) for n in names])) if set(names) <= has else F.lit(False))
    card = lambda flag: (_all([is_not_empty(t("tender_number")), is_not_empty(t("tender_type"))])
                         & F.coalesce(F.col(flag) == "YES", F.lit(False))
                         if {"tender_number", "tender_type", flag} <= has else F.lit(False))
    checks = [any_of(["first_name", "last_name"]), any_of(US_COLUMNS[2:]) | any_of(CANADA_COLUMNS[2:]),
              is_not_empty(t("email_address")), is_not_empty(t("phone")), is_not_empty(t("mobile")),
              card("is_plcc"), card("is_credit_card"), is_not_empty(t("implied_loyalty_id")),
              F.col("member_key") != UNKNOWN_KEY]
    return F.concat(*[F.when(c, "YES").otherwise("NO") for c in checks])


def _any(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


RECORD_INFO_COLUMNS = ["has_name", "has_address", "has_email", "has_phone", "has_mobile", "has_plcc",
                       "has_bank_card", "has_loyalty", "has_member"]


def record_info_key(df: DataFrame, record_info: DataFrame, card_type: DataFrame | None = None) -> DataFrame:
    if card_type is not None and {"tender_number", "tender_type"} <= set(df.columns):
        types = card_type.filter("status = 'current'").select(
            F.col("tender_type_code").alias("tender_type"), "is_plcc", "is_credit_card").groupBy("tender_type").agg(
            F.max("is_plcc").alias("is_plcc"), F.max("is_credit_card").alias("is_credit_card"))
        df = df.join(broadcast_if_small(types), "tender_type", "left")
    dim = record_info.select(F.concat(*[F.upper(F.trim(c)) for c in RECORD_INFO_COLUMNS]).alias("_flags"), "record_info_key")
    # the dimension has one row per flag combination: 512 at most
    return (df.withColumn("_flags", record_info_flags(df)).join(broadcast_if_small(dim), "_flags", "left")
            .drop("_flags", "is_plcc", "is_credit_card").fillna(UNKNOWN_KEY, ["record_info_key"]))


# ---------------------------------------------------------------- source keys

# fixed values: source keys of the till feed
TILL_SOURCE = {"customer_web": 47, "customer_store": 7, "till_web": 5, "till_store": 6}
CUSTOMER_FIELD_MATCHES = ["loyalty_id", "phone_email", "name_address", "phone_email_name", "email_name", "email",
                          "phone_name"]


def till_source_key(web_flag: Column, match_key: Column) -> Column:
    by_customer = match_key.isin([MATCH_CODES[n] for n in CUSTOMER_FIELD_MATCHES])
    web = F.coalesce(web_flag == "WEB", F.lit(False))
    return (F.when(by_customer & web, TILL_SOURCE["customer_web"]).when(by_customer, TILL_SOURCE["customer_store"])
            .when(web, TILL_SOURCE["till_web"]).otherwise(TILL_SOURCE["till_store"]))


def gender_source_key(gender: Column, male: int, female: int) -> Column:
    return F.when(F.lower(gender).startswith("m"), male).otherwise(female)


# ---------------------------------------------------------------- till tables

def trxn_unify(line_frames: list[DataFrame], admin: DataFrame, tender: DataFrame, customer: DataFrame,
               key: str = "transaction_id") -> DataFrame:
    """Heads of all line types and of the tender lines, with employee and tender, for
    transactions that have a customer record."""
    heads = union_all(line_frames + [tender.select(*line_frames[0].columns)]).distinct()
    wide = (heads.join(admin.select(key, "employee_id"), key, "left")
            .join(tender.select(key, "tender_number", "tender_type"), key, "left").distinct())
    return wide.join(customer, key)


def _layout(*parts: str) -> list[tuple[str, int, str]]:
    """(column, width, padding) of 'column width' items; a width with a leading 0 pads with zeros."""
    items = [item.split() for part in parts for item in part.split(",")]
    return [(name, int(width), "0" if width[0] == "0" else " ") for name, width in items]


# fixed values: the files that till lines and customer records come in and go out as
_HEAD = """record_type 1, transaction_type 1, division_id 04, store_id 05, register_id 03, cashier_id_header 03, salesperson 010,
  file_date 6, transaction_time 06, transaction_number 05, transaction_modifier 01, post_void_flag 01, transaction_sequence_number 04,
  original_transaction_number 05, associate_sales_flag 01, promotion_flag 01"""
_FOOT = """transaction_date_iso 08, class_number 04, vendor_number 05, style_number 08, color_number 04, size_number 04, item_number 08,
  filler_footer 1"""
LINE_LAYOUTS = {
    "non_merchandise": _layout(_HEAD, """non_merchandise_type 2, non_merchandise_number 18, non_merchandise_tax 1, non_merchandise_quantity 02,
      non_merchandise_amount_sign 1, non_merchandise_amount 06, filler_1 34, non_merchandise_cashier_number 09,
      non_merchandise_salesperson_number 09, filler_2 1""", _FOOT),
    "discount": _layout(_HEAD, """reference_number 08, discount_amount_sign 1, discount_amount 06, discount_type 02, discount_percentage 03,
      coupon_type 02, ring_code 08, discount_type_1_discount_deal_code 02, mobile_pos_indicator 1, filler_1 50""", _FOOT),
    "admin": _layout(_HEAD, "filler_1 6, employee_id 07, associate_type 1, associate_discount_percentage 02, filler_2 67", _FOOT),
    "tender": _layout(_HEAD, """tender_type 2, re_issue_flag 1, tender_amount_sign 1, tender_amount 06, tender_number 18, change_due_sign 1,
      change_due 06, check_authorization_enable 1, check_swiped 1, check_authorization_type 1, check_authorization_number 06,
      filler_1 39""", _FOOT),
    "sale": _layout(_HEAD, """sku 20, sku_type 1, retail_quantity 02, retail_sales_discount_amount_sign 1, retail_sales_discount_amount 06,
      retail_amount_sign 1, retail_amount 06, tax_status 1, price_modifier_indicator 1, original_price_sign 1, original_price 06,
      offline_flag 1, sku_scanned_indicator 1, plu_indicator 1, plu_feature_id 1, in_cecpct 1, filler_1 9, pos_indicator 1, filler_2 3,
      cashier_id_data 9, salesperson_id 9, transaction_void_indicator 1""", _FOOT),
}
CUSTOMER_LAYOUT = _layout("""record_type 1, address_indicator 1, intr1 010, intr2 05, transaction_date 8, transaction_store 010,
  transaction_register 010, transaction_nbr 010, intr3 1, intr4 1, phone_number 10, zip_code 9, email_address 40, gender 1, first_name 15,
  middle_initial 1, last_name 20, ean 16, ean_type 05, loyalty 21, loyalty_type 05, intr9 19, intr10 05, intr11 19, intr12 05,
  do_not_email 1, do_not_rent 1, do_not_mail 1, do_not_telemarket 1, do_not_map 1, do_not_promote 1, birth_date 8, customer_number 21,
  intr20 010, intr21 50, intr22 64, name_prefix 3, name_suffix 3, company_name 30, apartment_number 10, address_line_1 32,
  address_line_2 32, city 25, country 3, state 2, non_usa_postal_code 10, state_name 25, redeemed_reward_cert_number_1 13,
  redeemed_reward_cert_number_2 13, redeemed_reward_cert_number_3 13, redeemed_reward_cert_number_4 13, redeemed_reward_cert_number_5 13""")


def kill_lists(customer: DataFrame, heads: list[DataFrame], lines: list[DataFrame], key: str = "transaction_id") -> tuple[DataFrame, list[DataFrame]]:
    """(customer records without a transaction, lines of each frame without a customer record).

    Sale, non-merchandise, discount and tender lines make a transaction (`heads`); admin lines alone
    do not, but are listed like the others (`lines`). Rows with a null key have no counterpart."""
    known = union_all([d.select(key) for d in heads]).distinct()
    return customer.join(known, key, "left_anti"), [d.join(customer.select(key), key, "left_anti") for d in lines]


def customer_text(customer: DataFrame) -> Column:
    """A customer record as it stands in its file. Null values and columns that the frame lacks are blank."""
    return fixed_width(CUSTOMER_LAYOUT, columns=customer.columns)


def line_text(lines: DataFrame) -> Column:
    """A till line as it stands in the file of its `line_type`, blanks as in customer_text."""
    out = F
    for name, layout in LINE_LAYOUTS.items():
        out = out.when(F.col("line_type") == name, fixed_width(layout, columns=lines.columns))
    return out


def exclude_loaded(feed: DataFrame, fact: DataFrame, key: str = "transaction_id", fact_key: str = "trxn_id") -> DataFrame:
    return feed.join(fact.select(F.col(fact_key).alias(key)), key, "left_anti")


def split_known_keys(feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that carry a member key and skip matching, the others)."""
    known = F.coalesce(F.col("member_key") > 0, F.lit(False))
    meta = {"match_status": F.lit(True), "match_key": F.lit(0), "mcd_criteria": F.lit("matched")}
    return feed.filter(known).withColumns(meta), feed.filter(~known).drop("member_key")
