"""Duplicate groups, golden record and near-duplicate texts."""

import datetime as dt
import random
from itertools import combinations

from pyspark.sql import functions as F

from patronage.operators.components import connected_components
from patronage.plans import dedup as dd, fuzzy as fz, golden as gd

D = dt.date


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b):
            prev, row[j + 1] = row[j + 1], prev + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_ratio_by_hand():
    assert fz.ratio("ABCD", "ABCD") == 100 and fz.ratio("", "") == 100 and fz.ratio("AB", "CD") == 0
    # one letter more in 13: 2 * 13 / 27
    assert fz.ratio("ANNABARKELMON", "ANNABARKELMONA") == 96
    # a changed letter counts as one deletion and one insertion
    assert fz.ratio("ABCDEFGHIJ", "ABCDEFGHIX") == 90


def test_common_length_against_the_table():
    rnd = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rnd.choice("ABC") for _ in range(rnd.randint(0, 20))) for _ in "ab")
        assert fz.common_length(a, b) == longest_common(a, b)


def test_norm_sorts_words(spark):
    df = spark.createDataFrame([("Zed o'Ann  Bob-7",)], "a string")
    assert df.select(fz.norm(F.col("a"))).first()[0] == "BOB7 OANN ZED"


def test_similar_texts_equals_all_pairs(spark):
    rnd = random.Random(3)
    words = ["".join(rnd.choice("ABCDE") for _ in range(rnd.randint(3, 30))) for _ in range(40)]
    near = []
    for w in words:
        for _ in range(4):
            t = list(w)
            for _ in range(rnd.randint(1, 3)):
                at = rnd.randrange(len(t) + 1)
                t[at:at + rnd.randint(0, 1)] = rnd.choice(["", "A", "E", "X"])
            near.append("".join(t))
    texts = sorted({w for w in words + near if w})
    rows = [("hot", t) for t in texts] + [("small", t) for t in texts[:20]] + [("one", texts[0])]
    got = {(r.block, r.a, r.b, r.score) for r in fz.similar_texts(spark.createDataFrame(rows, "block string, text string")).collect()}
    want = set()
    for block in ("hot", "small", "one"):
        mine = sorted(t for b, t in rows if b == block)
        want |= {(block, a, b, fz.ratio(a, b)) for a, b in combinations(mine, 2) if fz.ratio(a, b) >= 94}
    assert got == want and len(want) > 50


def test_many_copies_are_one_node(spark):
    rows = [(i, "B", "SAME TEXT HERE") for i in range(500)] + [(900, "B", "SAME TEXT HERE X"), (901, "B", "OTHER")]
    df = spark.createDataFrame(rows, "member_key bigint, b string, t string")
    got = {r.member_key: r.identifier for r in fz.fuzzy_pairs(df, F.col("b"), F.col("t")).collect()}
    assert 901 not in got and len({got[i] for i in range(500)}) == 1 and len(got) >= 500


def test_columns_equal_the_plain_score(spark):
    rnd = random.Random(5)
    rows = [tuple("".join(rnd.choice("ABC ") for _ in range(rnd.randint(0, 25))) for _ in "ab") for _ in range(200)] + [("", ""), ("A" * 90, "A" * 88 + "B")]
    got = spark.createDataFrame(rows, "a string, b string").select("a", "b", fz.ratio_of(F.col("a"), F.col("b")).alias("s"), fz.common_length_of(F.col("a"), F.col("b")).alias("n")).collect()
    assert all(r.s == fz.ratio(r.a, r.b) and r.n == longest_common(r.a, r.b) for r in got)


def test_similar_texts_run_without_python(spark):
    nodes = spark.createDataFrame([("b", "ANNABARKELMON"), ("b", "ANNABARKELMONA")], "block string, text string")
    plan = fz.similar_texts(nodes)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan.replace("ArrowEvalPython", "Python")


def test_chain_of_near_copies_is_one_connected_group(spark):
    text = "ABCDEFGHIJKLMNOPQRSTUVWXY"
    chain = [text + "Z" * i for i in range(0, 10, 2)]  # two letters more each; the ends score under 94
    assert fz.ratio(chain[0], chain[1]) >= 94 > fz.ratio(chain[0], chain[4])
    rows = [(10 + i, "B", t) for i, t in enumerate(chain)] + [(7, "B", chain[2]), (50, "B", "SOMETHING ELSE"), (60, "C", chain[0])]
    rows += [(70, "D", "SAME"), (71, "D", "SAME")]
    df = spark.createDataFrame(rows, "member_key bigint, b string, t string")
    got = {r.member_key: r.identifier for r in fz.fuzzy_pairs(df, F.col("b"), F.col("t"), connected=True).collect()}
    assert got == {k: "7|14" for k in (7, 10, 11, 12, 13, 14)} | {70: "70|71", 71: "70|71"}
    pairs = {r.identifier for r in fz.fuzzy_pairs(df, F.col("b"), F.col("t")).collect()}
    assert len(pairs) > 2


def test_connected_components(spark):
    rnd = random.Random(11)
    edges = [(i, i + 1) for i in range(60)] + [(200 + i, 300 - i) for i in range(40)] + [(500, k) for k in range(501, 580)] + [(900, 900), (901, None)]
    edges += [(rnd.randrange(1000, 1200), rnd.randrange(1000, 1200)) for _ in range(120)]
    rnd.shuffle(edges)
    near = {}
    for a, b in edges:
        if b is not None and a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = {}
    for n in sorted(near):
        todo = [n] if n not in want else []
        while todo:
            x = todo.pop()
            if x not in want:
                want[x] = n
                todo += near[x]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    assert {r.node: r.root for r in connected_components(df).collect()} == want
    assert connected_components(df.limit(0)).count() == 0


COLS = ("member_key bigint, is_loyalty_member string, member_status string, customer_introduction_date date, trxn_date date, member_acct_enroll_date date, source_overlay_rank int, "
        "dpv_key int, last_updated_date date, first_name string, gender string, birth_date date, deceased string, direct_mail_consent string, direct_mail_consent_date date, "
        "first_trxn_date date, first_trxn_store_key bigint, last_store_purch_date date, last_web_purch_date date, current_source_key int, open_close_ind string, loyalty_id string, "
        "prospect_contact_count bigint, email_address string")
NAMES = [c.split()[0] for c in COLS.split(", ")]


def golden(spark, *rows):
    data = [(tuple(r.get(n) for n in NAMES)) + ("g",) for r in rows]
    df = spark.createDataFrame(data, COLS + ", grouping_id string")
    out = gd.golden_records(df, D(2001, 8, 1)).collect()
    coll = gd.collections(df).first()
    return coll, (out[0] if out else None)


def test_collections(spark):
    m = lambda k, loyal="NO", **x: {"member_key": k, "is_loyalty_member": loyal, **x}
    assert golden(spark, m(1))[0].collection_id == -1
    coll, rec = golden(spark, m(1, customer_introduction_date=D(2000, 2, 1)), m(2, customer_introduction_date=D(2000, 1, 1)))
    assert (coll.collection_id, coll.resolved_member, rec.member_key) == (1, 2, 2)
    coll, rec = golden(spark, m(1, "YES"), m(2, "YES"))
    assert coll.collection_id == 2 and not coll.is_resolved and rec is None
    coll, rec = golden(spark, m(1), m(2, "YES", loyalty_id="L"))
    assert (coll.collection_id, coll.resolved_member, rec.loyalty_id) == (3, 2, "L")
    coll, _ = golden(spark, m(1), m(2, "YES", member_status="CLOSED"), m(3, "YES", member_status="CLOSED"))
    assert coll.collection_id == 4 and not coll.is_resolved
    coll, rec = golden(spark, m(1, first_name="keep"), m(2, "YES", member_status="ACTIVE", trxn_date=D(2001, 1, 1), first_name="b"),
                       m(3, "YES", member_status="ACTIVE", trxn_date=D(2001, 2, 1), first_name="c", source_overlay_rank=1))
    assert coll.resolved_member == 3 and rec.first_name == "c"


def test_fields(spark):
    a = {"member_key": 1, "customer_introduction_date": D(2000, 1, 1), "source_overlay_rank": 0, "first_name": "zero", "last_updated_date": D(2001, 1, 1), "gender": "MALE",
         "birth_date": D(1960, 1, 1), "deceased": "NO", "direct_mail_consent": "NO", "direct_mail_consent_date": D(2001, 1, 1), "first_trxn_date": D(2000, 5, 5),
         "first_trxn_store_key": 9, "last_store_purch_date": D(2001, 3, 3), "current_source_key": 8, "open_close_ind": "C", "prospect_contact_count": 2, "email_address": "x"}
    b = {"member_key": 2, "customer_introduction_date": D(2000, 1, 1), "source_overlay_rank": 5, "dpv_key": 1, "first_name": "five", "last_updated_date": D(2001, 2, 1), "gender": "F",
         "birth_date": D(1950, 1, 1), "deceased": "YES", "direct_mail_consent": "YES", "direct_mail_consent_date": D(2001, 1, 1), "first_trxn_date": D(2000, 5, 5),
         "first_trxn_store_key": 4, "last_store_purch_date": D(2001, 2, 2), "current_source_key": 1, "open_close_ind": "O", "prospect_contact_count": None}
    c = {"member_key": 3, "source_overlay_rank": 5, "dpv_key": 2, "first_name": "dpv", "birth_date": D(1960, 1, 1)}
    coll, rec = golden(spark, a, b, c)
    assert coll.collection_id == 1 and rec.member_key == 1
    assert rec.first_name == "dpv" and rec.gender == "FEMALE" and rec.birth_date == D(1960, 1, 1) and rec.deceased == "YES"
    assert rec.direct_mail_consent == "YES" and rec.first_trxn_store_key == 4 and rec.last_store_purch_date == D(2001, 2, 2)
    assert rec.open_close_ind == "C" and rec.prospect_contact_count == 2 and rec.email_address is None and rec.last_updated_date == D(2001, 2, 1)


def test_birth_date_tie_takes_the_earliest(spark):
    rows = [{"member_key": i, "birth_date": d} for i, d in enumerate([D(1970, 1, 1), D(1960, 1, 1), D(1850, 1, 1), D(2050, 1, 1)])]
    assert golden(spark, *rows)[1].birth_date == D(1960, 1, 1)


def test_groups_by_value_and_by_pair(spark):
    text = "first_name string, last_name string, address1_scrubbed string, address2_scrubbed string, zip_code_scrubbed string"
    members = spark.createDataFrame([(k, *[None] * 5) for k in range(1, 9)], "member_key bigint, " + text)
    contacts = spark.createDataFrame(
        [(1, "card", "7"), (2, "card", "7"), (3, "email", "a"), (4, "email", "a"), (3, "phone", "1"), (4, "phone", "1"), (4, "email", "own"),
         (5, "email", "e"), (6, "email", "e"), (6, "email", "f"), (7, "phone", "9")], "member_key bigint, kind string, value string")
    trxn = spark.createDataFrame([(1, D(2001, 1, 1))], "member_key bigint, trxn_date date")
    tagged = dd.identify_groups(dd.dedup_inputs(members, trxn, contacts))
    assert {r.member_key: r.grouping_criteria_id for r in tagged.collect()} == {1: 3, 2: 3, 3: 7, 4: 7, 5: 5, 6: 5, 7: 4, 8: 0}
    groups = dd.group_rows(tagged, contacts)
    rows = groups.join(tagged.drop("grouping_criteria_id").withColumns({
        "is_loyalty_member": F.lit("NO"), "member_status": F.lit(None).cast("string"), "customer_introduction_date": F.lit(None).cast("date"),
        "member_acct_enroll_date": F.lit(None).cast("date")}), "member_key")
    got = {}
    for r in dd.resolve_groups(groups, rows).collect():
        got.setdefault(r.member_key, []).append((r.grouping_criteria_id, r.grouping_id, r.grouped_count, r.is_invalid))
    assert got[1] == [(3, "7", 2, False)] and got[7] == [(4, "9", 1, False)]
    # member 4 also forms a group of its own, so both its groups are invalid
    assert sorted(got[4]) == [(7, "a~1", 2, True), (7, "own~1", 1, True)] and got[3] == [(7, "a~1", 2, True)]
    assert sorted(got[6]) == [(5, "e", 2, True), (5, "f", 1, True)] and got[5] == [(5, "e", 2, True)]


def _pairs(spark, contacts):
    members = spark.createDataFrame([(k,) for k in sorted({c[0] for c in contacts})], "member_key bigint")
    df = spark.createDataFrame(contacts, "member_key bigint, kind string, value string")
    return dd._pair_groups(members, df)


def _kept(groups):
    """The smallest group of each member for every set of fellow members."""
    by, kept = {}, {}
    for m, g in groups:
        by.setdefault(g, set()).add(m)
    for g, members in by.items():
        for m in members:
            at = (m, frozenset(members))
            kept[at] = min(g, kept.get(at, g))
    return kept


def test_pairs_of_light_and_heavy_members_equal_all_pairs(spark, monkeypatch):
    """Everyone light, everyone heavy, and both kinds: the kept groups are those of all pairs."""
    rnd = random.Random(8)
    values = {("email", f"e{i}") for i in range(12)} | {("phone", f"{i}") for i in range(20, 32)}
    contacts = sorted({(m, *v) for m in range(24) for v in rnd.sample(sorted(values), rnd.choice([2, 4, 9]))}
                      | {(m, kind, f"own{m}") for m in range(0, 24, 5) for kind in ("email", "phone")}
                      | {(m, kind, f"{kind}-twin{i}") for m in (3, 4) for kind in ("email", "phone") for i in range(6)})
    naive = [(m, f"{e}~{p}") for m, k, e in contacts if k == "email" for n, q, p in contacts if n == m and q == "phone"]
    want = _kept(naive)
    for limit in (10_000, 0, 12):
        monkeypatch.setattr(dd, "PAIR_LIMIT", limit)
        got = {(r.member_key, r.grouping_id) for r in _pairs(spark, contacts).collect()}
        assert got <= set(naive) and _kept(got) == want, limit


def test_member_with_very_many_shared_values_forms_few_pairs(spark):
    """10,000 e-mails and 10,000 phones, shared with one member, and with one member each."""
    n = 10_000
    twins = [(m, k, f"{k}{i}") for m in (1, 2) for k in ("email", "phone") for i in range(n)]
    got = _pairs(spark, twins).collect()
    assert sorted((r.member_key, r.grouping_id) for r in got) == [(1, "email0~phone0"), (2, "email0~phone0")]
    # member 1 shares each value with another member; ten of those have a phone of it, too
    hub = [(1, k, f"{k}{i}") for k in ("email", "phone") for i in range(n)]
    others = [(10 + i, "email", f"email{i}") for i in range(n)] + [(10 + n + i, "phone", f"phone{i}") for i in range(n)] + [(10 + i, "phone", f"phone{i}") for i in range(10)]
    got = {(r.member_key, r.grouping_id) for r in _pairs(spark, hub + others).collect()}
    assert {g for m, g in got if m == 1} == {f"email{i}~phone{i}" for i in range(10)} | {"email0~phone1"}
    assert len(got) == 11 + 10
