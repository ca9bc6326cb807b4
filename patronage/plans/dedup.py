"""Finding duplicate members, collapsing them, and re-keying the other tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..codes import UNKNOWN_KEY
from ..functions.dates import as_date
from ..functions.text import decode, is_empty, is_not_empty
from ..operators.ranking import latest_per_key, with_key_aggregates
from ..operators.rewrite import rewrite_keys
from ..operators.sequence import generate_sequence
from ..operators.sets import union_all
from ..operators.sizing import broadcast_if_small
from ..operators.skew import join_back
from ..operators.staging import stage
from . import golden
from .fuzzy import THRESHOLD, fuzzy_pairs

# ---- fixed values -----------------------------------------------------------
NAME_RULE, FUZZY_RULE, CARD_RULE, PHONE_RULE, EMAIL_RULE, EMAIL_PHONE_RULE = 1, 2, 3, 4, 5, 7
JUNK_NUMBERS = ["UNKNOWN", "0", "0000000000", "8888888888", "9999999999", "5555555555", "1111111111", "0000000001",
                "7777777777", "2222222222"]
NAME_KEY = ["first_name", "last_name", "address1_scrubbed", "address2_scrubbed", "zip_code_scrubbed"]
ADDRESS_BLOCK = ["address1_scrubbed", "address2_scrubbed", "zip_code_scrubbed", "city_scrubbed", "state_scrubbed"]
NAME_BLOCK = ["zip_code_scrubbed", "first_name", "last_name"]
ADDRESS_TEXT = ["address1_scrubbed", "address2_scrubbed", "city_scrubbed", "state_scrubbed"]


# ---------------------------------------------------------------- inputs

def contact_values(cards: DataFrame, emails: DataFrame, phones: DataFrame, skew_members=()) -> DataFrame:
    """Distinct (member_key, kind, value) of cards, e-mails and phones, junk removed."""
    drop = list(skew_members) + [UNKNOWN_KEY]
    number = lambda c: F.regexp_replace(F.col(c).cast("string"), "^0+(?!$)", "")
    card = (cards.filter(F.col("tokenized_cc_nbr").isNotNull())
            .select("member_key", F.lit("card").alias("kind"), number("tokenized_cc_nbr").alias("value"))
            .filter("value <> '0'"))
    email = (emails.filter("email_address <> '@'")
             .select("member_key", F.lit("email").alias("kind"), F.trim("email_address").alias("value"))
             .filter(is_not_empty(F.col("value"))))
    phone = (phones.select("member_key", F.lit("phone").alias("kind"), number("phone_number").alias("value"))
             .filter(~F.col("value").isin(JUNK_NUMBERS)))
    return union_all([card, email, phone]).filter(~F.col("member_key").isin(drop)).distinct()


def dedup_inputs(member: DataFrame, transactions: DataFrame, contacts: DataFrame) -> DataFrame:
    """Members with their latest transaction date and the number of cards, e-mails and phones.

    The values themselves stay in `contacts`, one row each: a member with millions of them
    does not become one huge row.
    """
    last = transactions.filter(F.col("member_key") != UNKNOWN_KEY).groupBy("member_key").agg(F.max("trxn_date").alias("trxn_date"))
    counts = contacts.groupBy("member_key").agg(*[F.count_if(F.col("kind") == k).alias(f"n_{k}s") for k in ("card", "email", "phone")])
    return (member.join(last, "member_key", "left").join(counts, "member_key", "left")
            .fillna(0, ["n_cards", "n_emails", "n_phones"]))


def _filled(c: str) -> Column:
    return is_not_empty(F.col(c)) & (F.col(c) != "UNKNOWN")


def _missing(c: str) -> Column:
    return is_empty(F.col(c)) | (F.col(c) == "UNKNOWN")


def identify_groups(df: DataFrame) -> DataFrame:
    """grouping_criteria_id: which rule a member falls under; 0 for none."""
    base = ["first_name", "last_name", "address1_scrubbed", "zip_code_scrubbed"]
    full = _filled(base[0])
    bare = _missing(base[0])
    for c in base[1:]:
        full, bare = full & _filled(c), bare & _missing(c)
    card, email, phone = F.col("n_cards") > 0, F.col("n_emails") > 0, F.col("n_phones") > 0
    rule = (F.when(full, NAME_RULE).when(bare & ~phone & ~email & card, CARD_RULE)
            .when(bare & ~card & ~phone & email, EMAIL_RULE).when(bare & ~card & ~email & phone, PHONE_RULE)
            .when(bare & _missing("address2_scrubbed") & ~card & email & phone, EMAIL_PHONE_RULE).otherwise(0))
    return df.withColumn("grouping_criteria_id", rule)


# ---------------------------------------------------------------- groups

def _name_groups(df: DataFrame) -> DataFrame:
    key = F.concat_ws("~", *[F.upper(c) for c in NAME_KEY])
    return df.select("member_key", key.alias("grouping_id"))


def _value_groups(df: DataFrame, contacts: DataFrame) -> DataFrame:
    """Groups by one shared value: the kind of value follows from the member's rule."""
    kind = decode(F.col("grouping_criteria_id"), {CARD_RULE: "card", EMAIL_RULE: "email", PHONE_RULE: "phone"})
    mine = df.select("member_key", "grouping_criteria_id", kind.alias("kind")).filter(F.col("kind").isNotNull())
    return (mine.join(contacts, ["member_key", "kind"])
            .select("member_key", "grouping_criteria_id", F.col("value").alias("grouping_id")))


# (e-mail, phone) pairs of one member that are formed outright
PAIR_LIMIT = 10_000


def _value_classes(mine: DataFrame) -> DataFrame:
    """(member_key, kind, value, n): one value for all values of a kind that the same n members
    have. Their groups have the same members, of which the smallest id is kept, so one value
    stands for all: that which comes first in front of the separator. Sets of members are told
    apart by sums over their keys."""
    key = F.col("member_key")
    signed = mine.groupBy("kind", "value").agg(F.struct(
        F.count(F.lit(1)).alias("n"), F.min(key), F.max(key), F.bit_xor(F.xxhash64(key)),
        F.sum(F.pmod(F.xxhash64(key, F.lit(7)), F.lit(1 << 40)))).alias("_set"))
    first = F.min(F.concat("value", F.lit("~")))
    return (join_back(mine, signed, ["kind", "value"]).groupBy("member_key", "kind", "_set").agg(first.alias("_v"))
            .select("member_key", "kind", F.expr("left(_v, length(_v) - 1)").alias("value"), F.col("_set.n").alias("n")))


def _pair_groups(df: DataFrame, contacts: DataFrame) -> DataFrame:
    """Groups by (e-mail, phone) of members whose groups differ in their members.

    A value that no other member of the rule has can only form groups of one, so such values
    are not paired: one row per member stands for all groups of one that they would form.
    Shared values are first cut to one for each set of members. Light members, with up to
    PAIR_LIMIT pairs left, form them. Heavy members never do (`_heavy_groups`).
    """
    mine = df.select("member_key").join(contacts.filter(F.col("kind").isin("email", "phone")), "member_key")
    tagged = stage(_value_classes(mine))
    e, p, own = F.col("kind") == "email", F.col("kind") == "phone", F.col("n") == 1
    first = lambda cond: F.min(F.when(cond, F.concat("value", F.lit("~"))))
    member = tagged.groupBy("member_key").agg(
        first(e).alias("e"), first(p).alias("p"), first(e & own).alias("eo"), first(p & own).alias("po"),
        (F.count_if(e & ~own) * F.count_if(p & ~own)).alias("pairs"))
    strip = lambda c: F.expr(f"left({c}, length({c}) - 1)")
    lone = (member.withColumn("g", F.least(F.concat("eo", strip("p")), F.concat("e", strip("po"))))
            .filter(F.col("g").isNotNull()).select("member_key", F.col("g").alias("grouping_id")))
    shared = tagged.filter("n > 1")
    emails = shared.filter(e).select("member_key", F.col("value").alias("ve"))
    phones = shared.filter(p).select("member_key", F.col("value").alias("vp"))
    heavy = stage(member.filter(F.col("pairs") > PAIR_LIMIT).select("member_key"))
    if heavy.isEmpty():
        pairs = emails.join(phones, "member_key").select("member_key", "ve", "vp")
    else:
        heavy = broadcast_if_small(heavy)
        few = lambda d: d.join(heavy, "member_key", "left_anti")
        many = lambda d: stage(d.join(heavy, "member_key", "left_semi"))
        light = stage(few(emails).join(few(phones), "member_key").select("member_key", "ve", "vp"))
        pairs = light.unionByName(_heavy_groups(light, many(emails), many(phones)))
    return pairs.select("member_key", F.concat_ws("~", "ve", "vp").alias("grouping_id")).unionByName(lone)


def _heavy_groups(light: DataFrame, emails: DataFrame, phones: DataFrame) -> DataFrame:
    """(member_key, ve, vp) of heavy members without their products.

    A pair that a heavy member has in common with a light one is among the pairs of light
    members: those with an e-mail of a heavy member, cut by that member's phones. A pair of
    heavy members alone is formed by two of them that share both kinds of value, of their
    common values only. All other pairs are groups of the member alone, of which only the first
    is needed: its first e-mail that is not in a shared pair with every phone, and its first
    phone that is in none with that e-mail. Rows are at most the pairs of light members times
    the heavy members with the same e-mail, and the common pairs of heavy members.
    """
    met = (light.select("ve", "vp").distinct().join(emails, "ve").join(phones, ["member_key", "vp"], "left_semi")
           .select("member_key", "ve", "vp"))
    side = lambda d, v: d.select(F.col("member_key").alias("a"), v).join(d.select(F.col("member_key").alias("b"), v), v).filter("a < b")
    both = stage(side(emails, "ve").select("a", "b").distinct().join(side(phones, "vp").select("a", "b").distinct(), ["a", "b"]))
    of = lambda d, end, v: d.select(F.col("member_key").alias(end), F.col(v))
    common = lambda d, v: both.join(of(d, "a", v), "a").join(of(d, "b", v), ["b", v], "left_semi").select("a", "b", v)
    twos = common(emails, "ve").join(common(phones, "vp"), ["a", "b"])
    shared = stage(met.unionByName(twos.select(F.explode(F.array("a", "b")).alias("member_key"), "ve", "vp")).distinct())
    # the first pair of each member that it has alone
    most = phones.groupBy("member_key").agg(F.count(F.lit(1)).alias("_most"))
    taken = shared.groupBy("member_key", "ve").agg(F.count(F.lit(1)).alias("_taken"))
    open_ = (emails.join(taken, ["member_key", "ve"], "left").join(most, "member_key").filter(F.coalesce("_taken", F.lit(0)) < F.col("_most"))
             .groupBy("member_key").agg(F.min(F.concat("ve", F.lit("~"))).alias("_v"))
             .select("member_key", F.expr("left(_v, length(_v) - 1)").alias("ve")))
    alone = (open_.join(phones, "member_key").join(shared, ["member_key", "ve", "vp"], "left_anti")
             .groupBy("member_key", "ve").agg(F.min("vp").alias("vp")))
    return shared.unionByName(alone.select("member_key", "ve", "vp"))


GROUP = ["grouping_criteria_id", "grouping_id"]


def group_rows(df: DataFrame, contacts: DataFrame) -> DataFrame:
    """(member_key, grouping_criteria_id, grouping_id) of all members that fall under a rule."""
    cols = ["member_key", "grouping_criteria_id", "grouping_id"]
    rule = lambda r: df.filter(F.col("grouping_criteria_id") == r)
    tag = lambda d, r: d.withColumn("grouping_criteria_id", F.lit(r)).select(*cols)
    return union_all([tag(_name_groups(rule(NAME_RULE)), NAME_RULE),
                      _value_groups(df, contacts).select(*cols),
                      tag(_pair_groups(rule(EMAIL_PHONE_RULE), contacts), EMAIL_PHONE_RULE)]).distinct()


def resolve_groups(groups: DataFrame, rows: DataFrame) -> DataFrame:
    """member_key, grouping_criteria_id, grouping_id, grouped_count, collection_id,
    resolved_member, is_resolved, is_invalid for all rules at once.

    `groups` comes from `group_rows`, `rows` is it joined to the members. A member keeps one
    row per distinct set of fellow members (the smallest group id); a group is invalid if any
    of its members is left with more than one. Sets are told apart by a signature of sums
    over their keys, so they are never collected.
    """
    key = F.col("member_key")
    signed = groups.groupBy(*GROUP).agg(F.struct(
        F.count(F.lit(1)), F.min(key), F.max(key), F.bit_xor(F.xxhash64(key)),
        F.sum(F.pmod(F.xxhash64(key, F.lit(7)), F.lit(1 << 40)))).alias("_set"))
    kept = (join_back(groups, signed, GROUP).groupBy("member_key", "grouping_criteria_id", "_set")
            .agg(F.min("grouping_id").alias("grouping_id")).drop("_set"))
    counted = with_key_aggregates(kept, ["member_key"], _sets=F.count(F.lit(1)))
    marked = with_key_aggregates(counted, GROUP, _most=F.max("_sets"))
    return (join_back(marked.withColumn("is_invalid", F.col("_most") > 1), golden.collections(rows, GROUP), GROUP)
            .select("member_key", *GROUP, "grouped_count", "collection_id", "resolved_member", "is_resolved", "is_invalid"))


# ---------------------------------------------------------------- fuzzy

def _placed(df: DataFrame) -> Column:
    return _filled("state_scrubbed") & _filled("city_scrubbed")


def _text(cols: list[str]) -> Column:
    # a missing part is spelled null inside the compared text, as in the reference
    return F.concat(*[F.coalesce(F.col(c), F.lit("null")) for c in cols])


def _block(cols: list[str]) -> Column:
    return F.concat_ws("\u0001", *[F.coalesce(F.upper(c), F.lit("\u0002")) for c in cols])


def fuzzy_name_groups(df: DataFrame, threshold: int = THRESHOLD, connected: bool = False) -> DataFrame:
    """Same address, similar name: (member_key, identifier)."""
    return fuzzy_pairs(df.filter(_placed(df)), _block(ADDRESS_BLOCK), _text(["first_name", "last_name"]), threshold, connected=connected)


def fuzzy_address_groups(df: DataFrame, threshold: int = THRESHOLD, connected: bool = False) -> DataFrame:
    """Same name and zip code, similar address: (member_key, identifier)."""
    return fuzzy_pairs(df.filter(_placed(df)), _block(NAME_BLOCK), _text(ADDRESS_TEXT), threshold, connected=connected)


def exact_plus_fuzzy(df: DataFrame, threshold: int = THRESHOLD, connected: bool = False) -> DataFrame:
    """Groups of rule 1: exact ones, then near names, then near addresses, then singles:
    (member_key, grouping_id, grouping_criteria_id). One-letter names stay out of the fuzzy part.
    Near copies are pairs, or with `connected` all that near copies lead to."""
    exact = with_key_aggregates(_name_groups(df), ["grouping_id"], _n=F.count(F.lit(1)))
    exact = stage(exact)
    multi = exact.filter("_n > 1").select("member_key", "grouping_id", F.lit(NAME_RULE).alias("grouping_criteria_id"))
    singles = df.join(exact.filter("_n = 1").select("member_key", "grouping_id"), "member_key")
    open_rows = singles.filter((F.length("first_name") > 1) & (F.length("last_name") > 1))
    names = stage(fuzzy_name_groups(open_rows, threshold, connected))
    rest = open_rows.join(names.select("member_key"), "member_key", "left_anti")
    addresses = stage(fuzzy_address_groups(rest, threshold, connected))
    found = names.unionByName(addresses).select("member_key", F.col("identifier").alias("grouping_id"),
                                                F.lit(FUZZY_RULE).alias("grouping_criteria_id"))
    left = (singles.join(found.select("member_key"), "member_key", "left_anti")
            .select("member_key", "grouping_id", F.lit(NAME_RULE).alias("grouping_criteria_id")))
    return union_all([multi, found, left])


# ---------------------------------------------------------------- results

def history_fact(membership: DataFrame, members: DataFrame, info: DataFrame, max_id: int) -> DataFrame:
    """Old to new key per resolved member without a loyalty id; groups that hold an old key
    seen twice are invalid; numbered after the largest stored id."""
    rows = (membership.join(members.select("member_key", "loyalty_id"), "member_key")
            .filter(F.col("is_resolved") & is_empty(F.col("loyalty_id")))
            .select("member_key", "resolved_member", "grouping_id", "grouping_criteria_id", "collection_id", "is_invalid")
            .distinct().filter("member_key <> resolved_member"))
    dim = info.select(F.col("id_condition").alias("grouping_criteria_id"), F.col("collection_type").alias("collection_id"),
                      "dedupe_info_key")
    rows = rows.join(broadcast_if_small(dim), ["grouping_criteria_id", "collection_id"], "left")
    counted = with_key_aggregates(rows, ["member_key"], _n=F.count(F.lit(1)))
    marked = with_key_aggregates(counted, ["grouping_id"], _most=F.max("_n"))
    out = marked.select(F.col("member_key").alias("old_member_key"), F.col("resolved_member").alias("new_member_key"),
                        "grouping_id", "dedupe_info_key", (F.col("is_invalid") | (F.col("_most") > 1)).alias("is_invalid"))
    return generate_sequence(out, "dedupe_member_hist_id",
                             [F.col("old_member_key"), F.col("new_member_key"), F.col("grouping_id")], max_id)


def assemble(members: DataFrame, membership: DataFrame, golden_rows: DataFrame, history: DataFrame) -> DataFrame:
    """One result row per member: the collapsed member (U:…), loyalty members kept as they
    are, members of invalid groups, and members outside any group."""
    bad = history.filter("is_invalid").select("grouping_id").distinct().withColumn("_bad", F.lit(True))
    tagged = (join_back(membership.drop("is_invalid"), bad, ["grouping_id"], "left")
              .join(members.select("member_key", "loyalty_id"), "member_key"))
    info = F.concat_ws(":", F.col("grouping_criteria_id").cast("string"), "grouping_id", F.col("grouped_count").cast("string"))
    open_group = F.col("is_resolved") & is_empty(F.col("loyalty_id"))
    tagged = tagged.withColumn("_ok", F.col("_bad").isNull() & open_group).withColumn("_info", info)
    merged = tagged.filter("_ok").groupBy(*GROUP).agg(F.min("_info").alias("_info"))
    # the collapsed member replaces the member whose key it takes; the others disappear
    collapsed = (golden_rows.join(merged, GROUP)
                 .select("member_key", F.concat_ws(":", F.lit("U"), "_info").alias("action_flag")))
    kept = tagged.filter("not _ok").select("member_key", F.when(
        ~open_group & F.col("_bad").isNull(), F.concat_ws(":", F.lit("loyalty"), "_info"))
        .otherwise(F.concat_ws(":", F.lit("invalid"), "_info")).alias("action_flag"))
    ungrouped = members.filter("grouping_criteria_id = 0").select("member_key", F.lit("ungrouped").alias("action_flag"))
    # collapsed rows carry the newest stamp, so they win over a kept row of the same member
    ranked = union_all([collapsed.withColumn("_p", F.lit(0)), kept.withColumn("_p", F.lit(1)),
                        ungrouped.withColumn("_p", F.lit(1))])
    return ranked.groupBy("member_key").agg(F.min(F.struct("_p", "action_flag"))["action_flag"].alias("action_flag"))


def stats(history: DataFrame, info: DataFrame) -> DataFrame:
    """Valid re-keyed members per rule and collection."""
    counts = history.filter("not is_invalid").groupBy("dedupe_info_key").agg(F.count("dedupe_info_key").alias("dedupe_grp_cnt"))
    return (counts.join(broadcast_if_small(info), "dedupe_info_key")
            .select("dedupe_info_key", "id_condition_desc", "collection_type_descr", "dedupe_grp_cnt")
            .orderBy(F.col("dedupe_info_key").cast("bigint")))


# ---------------------------------------------------------------- re-keying

# ---- fixed values: natural key and precedence per re-keyed dimension ----------
REKEY_RULES = {
    "multi_email": (["member_key", "email_address"], ["is_loyalty_email", "email_consent", "last_updated_date"]),
    "multi_phone": (["member_key", "phone_number"], ["is_loyalty_flag", "phone_consent", "last_updated_date"]),
    "consent": (["member_key", "consent_type"], ["consent_date", "consent_history_id"]),
}


def _rekeyed(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Left join to the valid key changes; a key changes at most once."""
    m = mapping.filter("not is_invalid").select(F.col("old_member_key").alias("_old"), F.col("new_member_key").alias("_new"))
    return df.join(m, F.col("member_key") == F.col("_old"), "left")


def rekey_dimension(df: DataFrame, mapping: DataFrame, table: str, tiebreak: list[str]) -> DataFrame:
    """Replace old keys by new ones (action U, else NCD) and keep one row per natural key."""
    out = (_rekeyed(df, mapping)
           .withColumn("action_flag", F.when(F.col("_old").isNotNull(), "U").otherwise("NCD"))
           .withColumn("_was", F.col("member_key"))
           .withColumn("member_key", F.coalesce("_new", "member_key")))
    if table in REKEY_RULES:
        keys, order = REKEY_RULES[table]
        known = out.filter(F.col("member_key") != UNKNOWN_KEY)
        best = latest_per_key(known, keys, [F.col(c).desc_nulls_last() for c in order] + [F.col("_was")] + [F.col(c) for c in tiebreak])
        out = best.unionByName(out.filter(F.col("member_key") == UNKNOWN_KEY))
    return out.drop("_old", "_new", "_was")


def rekey_fact(df: DataFrame, mapping: DataFrame, date) -> DataFrame:
    """Replace old keys by new ones and stamp the changed rows; rows with key -1 pass through."""
    out = _rekeyed(df, mapping)
    if "last_updated_date" in df.columns:
        out = out.withColumn("last_updated_date", F.when(F.col("_old").isNotNull(), as_date(date)).otherwise(F.col("last_updated_date")))
    return out.withColumn("member_key", F.coalesce("_new", "member_key")).select(*df.columns)


def rekey_stored(spark, path: str, mapping: DataFrame, change, parts: int = 512) -> list[int]:
    """Re-key a table that `store_by_key` has written by member_key: only parts with an old or a
    new key of the mapping are read and written. `change` re-keys rows, as `rekey_fact` does."""
    valid = mapping.filter("not is_invalid")
    touched = stage(valid.select(F.explode(F.array("old_member_key", "new_member_key")).alias("member_key")).distinct())
    return rewrite_keys(spark, path, "member_key", touched, change, parts)


def rekey_card_history(df: DataFrame, mapping: DataFrame, tiebreak: list[str]) -> DataFrame:
    """Card history: members that took over other members' rows keep one row per card, the
    latest, with the smallest batch id; all other rows stay as they are."""
    touched = mapping.filter("not is_invalid").select(F.col("new_member_key").alias("member_key")).distinct()
    moved = _rekeyed(df, mapping).withColumn("member_key", F.coalesce("_new", "member_key")).drop("_old", "_new")
    keys = ["member_key", "tokenized_cc_nbr"]
    merged = moved.join(touched, "member_key", "left_semi")
    batch = merged.groupBy(*keys).agg(F.min("batch_id").alias("_batch"))
    best = latest_per_key(merged, keys, [F.col("last_updated_date").desc()] + [F.col(c) for c in tiebreak])
    best = best.join(batch, keys).withColumn("batch_id", F.col("_batch")).drop("_batch")
    return best.select(*df.columns).unionByName(moved.join(touched, "member_key", "left_anti").select(*df.columns))
