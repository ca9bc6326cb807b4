"""Scalar functions on small inline rows."""

import datetime as dt

from pyspark.sql import functions as F

from patronage.functions import dates, geo, text


def col(spark, expr, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_empty_texts(spark):
    rows = [(None,), ("",), ("  ",), (" x ",)]
    assert col(spark, text.is_empty(F.col("a")), rows, "a string") == [True, True, True, False]
    assert col(spark, text.norm_text(F.col("a")), rows, "a string") == [None, None, None, "x"]


def test_phone(spark):
    rows = [("2125550001",), ("12125550001",), ("22125550001",), ("5555555555",), ("1234567890",), ("(614) 555-0001",), ("212555000",), (None,)]
    assert col(spark, text.valid_phone(F.col("a")), rows, "a string") == [True, True, False, False, False, True, False, False]


def test_email_characters(spark):
    rows = [("a@b.example",), ("a+b@c.example",), (None,), ("o'neil@d.example",)]
    assert col(spark, text.email_has_bad_chars(F.col("a")), rows, "a string") == [False, True, False, True]


def test_key_lists_and_brackets(spark):
    assert col(spark, text.sort_key_list(F.col("a")), [("10,9,100",)], "a string") == ["9,10,100"]
    assert col(spark, text.strip_brackets(F.col("a")), [("[1,2] ",)], "a string") == ["1,2"]


def test_hash_tells_nulls_apart(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("A ", None)], "x string, y string")
    h = [r[0] for r in df.select(text.null_safe_hash([F.col("x"), F.col("y")])).collect()]
    assert h[0] != h[1] and h[1] == h[2]


def test_amounts_are_exact(spark):
    df = spark.createDataFrame([(1999, "+"), (5, "-")], "c int, s string")
    got = [str(r[0]) for r in df.select(text.amount_from_cents(F.col("c"), F.col("s"))).collect()]
    assert got == ["19.99", "-0.05"]


def test_file_date(spark):
    rows = [("x-20010203",), ("x",), ("x-20019999",), (None,)]
    got = col(spark, dates.file_date(F.col("a")), rows, "a string")
    assert got == [dt.date(2001, 2, 3)] + [dt.date(1970, 1, 1)] * 3


def test_trxn_id(spark):
    df = spark.createDataFrame([(dt.date(2001, 2, 3), 12, 4, 99)], "d date, s int, r int, n int")
    assert df.select(text.trxn_id(*[F.col(c) for c in "dsrn"])).first()[0] == "200102030001200400099"


def test_distance_and_coordinates(spark):
    df = spark.createDataFrame([(40.0, -83.0, 41.0, -83.0)], "a double, b double, c double, d double")
    miles = df.select(geo.haversine_miles(*[F.col(c) for c in "abcd"])).first()[0]
    assert abs(miles - 69.09) < 0.05
    assert col(spark, geo.coordinate(F.col("a")), [("40000000N",), ("83000000W",)], "a string") == [40.0, -83.0]


def test_flags(spark):
    rows = [("y",), ("NO",), ("Unknown",), (" ",), ("maybe",)]
    assert col(spark, text.normalize_flag(F.col("a")), rows, "a string") == ["YES", "NO", "UNKNOWN", None, "maybe"]
