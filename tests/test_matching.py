"""Matching criteria with the cases that each one has to keep."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from patronage.plans import feeds as fd, matching as mt
from patronage.queries import REGISTRY


@pytest.fixture(scope="module")
def lk(spark):
    d = dt.date
    member = spark.createDataFrame([
        (1, "Ann", "Moor", "L1", "IP1", "1 Oak St", None, "43000", "YES", "YES", "YES", d(2000, 1, 1), "current"),
        (2, "Bob", "Reed", None, None, "2 Elm St", "Apt 1", "43001", "YES", "NO", "NO", d(1999, 1, 1), "current"),
        (3, "ANN ", "moor", None, None, None, None, None, "YES", "NO", "NO", d(1998, 1, 1), "current"),
        (4, None, "Reed", "L4", None, None, None, None, "NO", "NO", "NO", d(1997, 1, 1), "current"),
        (5, "Eve", "Hart", " ", None, None, None, None, "NO", "NO", "NO", None, "history")],
        "member_key bigint, first_name string, last_name string, loyalty_id string, ip_code string, address1 string, address2 string, zip_code string, "
        "is_dm_marketable string, is_em_marketable string, is_sms_marketable string, customer_introduction_date date, status string")
    email = spark.createDataFrame([(1, "A@x.example", "YES", "current"), (2, "b@x.example", "NO", "current"), (3, "a@x.example ", "NO", "current")],
                                  "member_key bigint, email_address string, is_loyalty_email string, status string")
    phone = spark.createDataFrame([(1, 2125550001, "YES", "current"), (2, 2125550002, "NO", "current"), (3, 212555000, "NO", "current"), (4, 5555555555, "NO", "current")],
                                  "member_key bigint, phone_number bigint, is_loyalty_flag string, status string")
    cards = spark.createDataFrame([("000000000000000077", 1, 2, "YES"), ("000000000000000077", 1, 1, "NO"), ("000000000000000078", 1, 3, "NO"),
                                   ("000000000000000079", 2, 1, "NO"), ("000000000000000000", 1, 1, "NO")],
                                  "tokenized_cc_nbr string, card_type_key bigint, member_key bigint, is_primary_account_holder string")
    ctype = spark.createDataFrame([(1, "YES", "current"), (2, "NO", "current")], "card_type_key bigint, is_plcc string, status string")
    tender = spark.createDataFrame([(77, 1, 1), (88, 1, 2), (99, 2, 3)], "tokenized_cc_nbr bigint, tender_type_key bigint, member_key bigint")
    ttype = spark.createDataFrame([(1, "YES", "current"), (2, "NO", "current")], "tender_type_key bigint, is_bank_card string, status string")
    staff = spark.createDataFrame([("00000000012", 2, "current")], "employee_id string, member_key bigint, status string")
    trxn = spark.createDataFrame([(1, d(2001, 1, 1), 5), (2, d(2001, 2, 1), 5), (3, d(2001, 2, 1), 9)], "member_key bigint, trxn_date date, trxn_time_key int")
    return mt.lookups(member, email, phone, cards, ctype, tender, ttype, staff, trxn)


COLUMNS = ["etl_unique_id", "implied_loyalty_id", "employee_id", "ip_code", "tender_number", "email_address", "phone", "first_name", "last_name",
           "address_line_1", "address_line_2", "zip_code"]


def run(spark, lk, names, *rows):
    data = [tuple({"etl_unique_id": str(i), **r}.get(c) for c in COLUMNS) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, ", ".join(f"{c} string" for c in COLUMNS))
    got = {r.etl_unique_id: (r.match_key, r.member_key) for r in mt.match_waterfall(df, lk, names).collect()}
    assert len(got) == len(rows)
    return [got[str(i)] for i in range(len(rows))]


MISS = (92, -1)


def test_loyalty_id(spark, lk):
    got = run(spark, lk, ["loyalty_id"], {"implied_loyalty_id": "L1"}, {"implied_loyalty_id": "LX"}, {"implied_loyalty_id": " "}, {})
    assert got == [(4, 1), MISS, MISS, MISS]


def test_employee_and_ip(spark, lk):
    assert run(spark, lk, ["employee_id"], {"employee_id": "12"}, {"employee_id": "13"}) == [(20, 2), MISS]
    assert run(spark, lk, ["ip_code"], {"ip_code": "IP1"}, {"ip_code": "x"}) == [(22, 1), MISS]


def test_email_and_name(spark, lk):
    got = run(spark, lk, ["email"], {"email_address": " a@X.example"}, {"email_address": "c@x.example"}, {"email_address": " "})
    assert got == [(14, 1), MISS, MISS]  # of two members the better marketable one
    got = run(spark, lk, ["email_name"], {"email_address": "a@x.example", "first_name": "ann", "last_name": " MOOR"},
              {"email_address": "a@x.example", "first_name": "ann"}, {"email_address": "a@x.example"})
    assert got == [(13, 1), MISS, MISS]


def test_email_without_name(spark, lk):
    got = run(spark, lk, ["email_without_name"], {"email_address": "a@x.example", "first_name": "A", "last_name": "B"}, {"email_address": "a@x.example", "first_name": "A"})
    assert got == [MISS, (14, 1)]


def test_phone(spark, lk):
    got = run(spark, lk, ["phone"], {"phone": "2125550001"}, {"phone": "212555000"}, {"phone": "5555555555"}, {"phone": "(212) 555-0001"})
    assert got == [(12, 1), MISS, MISS, MISS]  # the plain phone criterion compares the raw text
    assert run(spark, lk, ["phone_name"], {"phone": "(212) 555-0001", "first_name": "Ann", "last_name": "Moor"}, {"phone": "2125550001", "first_name": "Bob", "last_name": "Moor"}) == [(11, 1), MISS]


def test_phone_and_email(spark, lk):
    both = {"phone": "2125550002", "email_address": "b@x.example"}
    assert run(spark, lk, ["phone_email"], both, {"phone": "2125550001", "email_address": "b@x.example"}) == [(10, 2), MISS]
    assert run(spark, lk, ["phone_email_loyalty"], both, {"phone": "2125550001", "email_address": "a@x.example"}) == [MISS, (24, 1)]
    assert run(spark, lk, ["phone_email_name"], {**both, "first_name": "bob", "last_name": "reed"}, {**both, "first_name": "bob"}) == [(9, 2), MISS]


def test_cards(spark, lk):
    card = {"tender_number": "000000000000000077"}
    # the primary holder wins the tie, but has no loyalty id
    assert run(spark, lk, ["plcc_loyalty"], card, {"tender_number": "000000000000000000"}, {"tender_number": "000000000000000079"}) == [MISS, MISS, MISS]
    assert run(spark, lk, ["plcc_name"], {**card, "first_name": "ann", "last_name": "moor"}, card) == [(1, 1), MISS]
    assert run(spark, lk, ["plcc_name_loyalty"], {**card, "first_name": "ann", "last_name": "moor"}, {"tender_number": "000000000000000078", "first_name": "ann", "last_name": "moor"}) == [(25, 1), MISS]
    assert run(spark, lk, ["bank_card"], {"tender_number": "0077", "first_name": "q", "last_name": "q"}, {"tender_number": "0077", "first_name": "q"}, {"tender_number": "99", "first_name": "q", "last_name": "q"}) == [(6, 1), MISS, MISS]
    assert run(spark, lk, ["bank_card_name"], {"tender_number": "88", "first_name": "bob", "last_name": "reed"}, {"tender_number": "88", "first_name": "ann", "last_name": "reed"}) == [(5, 2), MISS]


def test_name_and_address(spark, lk):
    good = {"first_name": "BOB", "last_name": "Reed", "address_line_1": "2 elm st ", "address_line_2": "APT 1", "zip_code": "43001"}
    assert run(spark, lk, ["name_address"], good, {**good, "address_line_2": None}, {**good, "first_name": None}) == [(7, 2), MISS, MISS]


def test_waterfall_order_and_whole_result(spark, lk):
    rows = [{"implied_loyalty_id": "L1", "email_address": "b@x.example"}, {"email_address": "b@x.example"}, {"phone": "2125550001"}, {}]
    assert run(spark, lk, ["loyalty_id", "email", "phone"], *rows) == [(4, 1), (14, 2), (12, 1), MISS]
    assert run(spark, lk, ["email", "loyalty_id"], rows[0]) == [(14, 2)]


def test_history_members_are_not_found(spark, lk):
    assert 5 not in [r.member_key for r in lk.member.collect()]


def test_new_keys_are_shared_within_a_group(spark):
    cols = "etl_unique_id string, implied_loyalty_id string, email_address string, first_name string, last_name string, address_line_1 string, zip_code string, " \
           "non_usa_postal_code string, phone string, tender_number string, match_status boolean, match_key int, member_key bigint, mcd_criteria string"
    base = (False, 92, -1, "matched")
    rows = [("a", "L9", *[None] * 8, *base), ("b", "L9", *[None] * 8, *base), ("c", None, "x@y.example", *[None] * 7, *base),
            ("d", None, "x@y.example", "Q", *[None] * 6, *base), ("e", None, None, "A", "B", "1 St", "43000", None, None, None, *base),
            ("f", None, None, "A", "B", "1 St", None, "K1A", None, None, *base), ("g", *[None] * 7, "5555555555", None, *base), ("h", *[None] * 7, "2125550001", "0", *base)]
    df = spark.createDataFrame(rows, cols)
    got = {r.etl_unique_id: (r.mcd_criteria, r.member_key) for r in mt.new_member_keys(df, None, max_key=10).collect()}
    assert {k: v[0] for k, v in got.items()} == {
        "a": "mcd_loyaltyid", "b": "mcd_loyaltyid", "c": "mcd_email", "d": "mcd_email", "e": "mcd_name_address_us", "f": "mcd_name_address_canada",
        "g": "mcd_failed", "h": "mcd_phone"}
    assert got["a"][1] == got["b"][1] and got["c"][1] != got["d"][1] and got["g"][1] == -1
    keys = {v[1] for v in got.values() if v[1] != -1}
    assert keys == set(range(11, 11 + len(keys)))


def test_statement_feed_keeps_the_largest_key(spark, lk):
    primary = spark.createDataFrame([("s1", "x1", "2125550001", "2125550002"), ("s2", "x2", "999", None)], "etl_unique_id string, tender_number string, home_phone string, mobile_phone string")
    users = spark.createDataFrame([("u1", "x1", "2125550001"), ("u3", "x3", "2125550001")], "etl_unique_id string, tender_number string, phone string")
    info = spark.createDataFrame([(1, *["YES"] * 9)], "record_info_key bigint, " + ", ".join(f"{c} string" for c in mt.RECORD_INFO_COLUMNS))
    rows = fd.merge_statement(primary, users)
    assert sorted({r.etl_unique_id for r in rows.collect()}) == ["s1", "s2", "u3"]
    got = {r.etl_unique_id: (r.match_key, r.member_key) for r in fd.card_statement(primary, users, lk, info, None).collect()}
    assert got["s1"] == (12, 2) and got["u3"] == (12, 1) and got["s2"][0] == 92


# ---------------------------------------------------------------- kill lists

def test_kill_lists(spark):
    frame = lambda *keys: spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "transaction_id string, nr int")
    customers, lines = mt.kill_lists(frame("a", "b", "c", "d", None, "d"), [frame("a", "a", None), frame("b")], [frame("a", "x", "x", None), frame("b", "y"), frame("c", "z")])
    assert sorted(r.nr for r in customers.collect()) == [2, 3, 4, 5]  # an admin line alone (c) makes no transaction
    assert [sorted(r.nr for r in d.collect()) for d in lines] == [[1, 2, 3], [1], [1]]


def test_kill_list_texts_keep_their_width(spark):
    rows = spark.createDataFrame([(n, 12, "é", 7, 99, "L" * 30) for n in mt.LINE_LAYOUTS], "line_type string, store_id long, record_type string, sku int, employee_id int, filler_footer string")
    got = {r.line_type: r.line for r in rows.select("line_type", mt.line_text(rows).alias("line")).collect()}
    assert set(got) == {"sale", "non_merchandise", "discount", "admin", "tender"} and {len(x) for x in got.values()} == {182}
    assert all(x.startswith("é 000000012000") and x.endswith("00000000L") for x in got.values())
    assert got["sale"][57:77] == "7".rjust(20) and got["admin"][63:70] == "0000099"
    one = spark.createDataFrame([("x@y", None, 5, "C" * 40)], "email_address string, city string, transaction_nbr int, customer_number string")
    text = one.select(mt.customer_text(one).alias("t")).first().t
    assert len(text) == 647 and text[45:55] == "0000000005" and text[76:116] == "x@y".rjust(40) and "C" * 21 in text and "C" * 22 not in text


def as_text(layout, **values):
    return "".join(str(values.pop(c, "")).rjust(n, pad)[:n] for c, n, pad in layout) if values.keys() <= {c for c, _, _ in layout} else None


def test_kill_list_query_gives_the_lines_of_all_types(spark, tmp_path):
    """Orders 5 and 100010 have customer records of another number; order 3 has a tender, but no item; item 9 has no order."""
    day = dt.datetime(2001, 5, 2)
    orders = [(n, 40 + n, "O", 1234.0, day, "2-HIGH") for n in (1, 3, 5, 100010)]
    item = lambda order, number: (order, 8, 3, number, 2.0, 5000.0, 0.1, 0.0, "R" if number == 1 else "N", "F", day)
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([item(1, 1), item(1, 5), item(5, 1), item(5, 2), item(5, 5), item(5, None), item(9, 1)],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                          "l_returnflag string, l_linestatus string, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    at = mt.LINE_LAYOUTS
    five, far = {"transaction_number": 5, "transaction_date_iso": "20010502"}, {"register_id": 1, "transaction_number": 10, "transaction_date_iso": "20010502"}
    line = five | {"store_id": 4, "transaction_time": 500, "item_number": 8}
    other = line | {"non_merchandise_number": 9, "non_merchandise_quantity": 2, "non_merchandise_amount": 5000}
    lines = [as_text(at["sale"], **line, transaction_sequence_number=1, sku=9, retail_quantity=2, retail_amount_sign="-", retail_amount=5000, retail_sales_discount_amount=500),
             as_text(at["non_merchandise"], **other, transaction_sequence_number=2), as_text(at["non_merchandise"], **other),
             as_text(at["discount"], **line, transaction_sequence_number=5, discount_amount=500, ring_code="0500"),
             as_text(at["admin"], **five, employee_id=45), as_text(at["admin"], **far, employee_id=100050),
             as_text(at["tender"], **five, tender_type=2, tender_amount=1234, tender_number=51000045),
             as_text(at["tender"], **far, tender_type=2, tender_amount=1234, tender_number=51100049)]
    customers = [as_text(mt.CUSTOMER_LAYOUT, transaction_date="20010502", transaction_register=9000, transaction_nbr=5, customer_number="C45"),
                 as_text(mt.CUSTOMER_LAYOUT, transaction_date="20010502", transaction_register=9001, transaction_nbr=10, customer_number="C100050")]
    got = REGISTRY["kill_list"].run(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted([("line", x, 8) for x in lines] + [("customer", x, 2) for x in customers])
